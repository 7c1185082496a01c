"""Token ids by the tokenizers library, with each distinct chunk of text encoded once.

The library's pre-tokenizers never join what stands on two sides of white space, nor a letter
and the punctuation after it, so a text's ids are its chunks' ids one after another. Most chunks
of a corpus repeat. Chunks are found and hashed many at a time; a bounded table in each Python worker
keeps the bytes and ids of those seen (when full, of those seen again), and new ones go to the library
together, a special token between them. A hash only says where to look: a chunk gets the ids
of another only if their bytes are equal, and of two chunks with one hash the second is
encoded each time. Texts with special tokens or rare white space go to the library as they are.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from martloom.llm.common import byte_view, ragged, slices
from martloom.llm.spans import hash_spans, lanes, same_spans


#: Of these a second character makes a chunk white space; "" makes it a single space.
_ASCII_SPACE = ("", " ", "\t", "\n", "\v", "\f", "\r")


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file and what of white space it keeps.

    ``separator`` is one of its special tokens. ``keeps_space``: a space belongs to the word after
    it, other white space to itself; else all white space is dropped and letters are lowered.
    ``word_end`` is what tokens that end a word have after their bytes.
    """

    name: str
    separator: str
    specials: tuple[str, ...]
    keeps_space: bool
    word_end: str = ""
    path: str | None = None

    @property
    def file(self) -> str:
        """Where the file is on this machine: ``path`` if one was given."""
        return self.path or public_tokenizers.path(self.name)


def byte_bpe(path: str | None = None) -> Vocabulary:
    """Byte-level BPE."""
    return Vocabulary("byte_bpe_50k.json", "<|endoftext|>", ("<|endoftext|>",), True, path=path)


def word_bpe(path: str | None = None) -> Vocabulary:
    """BPE with word ends, in lower case."""
    specials = ("<|startoftext|>", "<|endoftext|>")
    return Vocabulary("word_bpe_49k.json", "<|startoftext|>", specials, False, "</w>", path)


def _rare_space(data: np.ndarray) -> np.ndarray:
    """Where white space outside ASCII begins (Unicode's White_Space in UTF-8)."""
    found = []
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    two = np.flatnonzero(data == 0xC2)
    found.append(two[np.isin(padded[two + 1], (0x85, 0xA0))])
    three = np.flatnonzero((data >= 0xE1) & (data <= 0xE3))
    code = padded[three].astype(int) << 16 | padded[three + 1].astype(int) << 8 | padded[three + 2]
    rare = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
    found.append(three[np.isin(code, rare)])
    return np.concatenate(found)


class ChunkFinder:
    """Begins and ends of the chunks of texts without rare white space."""

    def __init__(self, keeps_space: bool) -> None:
        self.keeps_space = keeps_space
        #: 1: white space; 2: ASCII letter; 4: plain punctuation.
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(b" \t\n\v\f\r")] = 1
        self.kind[[*range(65, 91), *range(97, 123)]] = 2
        self.kind[list(b".,;:!?")] = 4

    def find(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = self.kind[data]
        space = (kind & 1).view(bool)
        edge = np.zeros(n + 1, bool)
        edge[starts] = True
        # A chunk begins where white space and other text meet ...
        cut = np.ones(n, bool)
        np.not_equal(space[1:], space[:-1], out=cut[1:])
        cut |= edge[:-1]
        # ... and between a letter (ASCII or Latin-1) and plain punctuation.
        cut[1:] |= ((kind[:-1] << 1) & kind[1:] & 4) != 0
        wide = np.flatnonzero(data[:-2] == 0xC3)
        wide = wide[(data[wide + 1] != 0x97) & (data[wide + 1] != 0xB7)] + 2
        cut[wide[kind[wide] == 4]] = True
        if self.keeps_space:
            # The last white space before a word is a chunk of its own, joined to the word if a space.
            last = np.zeros(n, bool)
            last[:-1] = space[:-1] & ~space[1:]
            last &= ~edge[1:]
            cut |= last
            joined = np.flatnonzero(last & (data == 32)) + 1
            cut[joined] = False
        begins = np.flatnonzero(cut)
        ends = np.append(begins[1:], n)
        if not self.keeps_space:
            word = ~space[begins]
            begins, ends = begins[word], ends[word]
        return begins, ends


class ChunkEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does."""

    #: Bytes of text worked on at a time, new chunks after which the table is sorted anew, and
    #: chunks encoded at a time.
    GROUP, FRESH, TOGETHER = 1_000_000, 50_000, 2_000
    #: Longer chunks are not kept; the table is emptied when its chunks have so many ids.
    LONGEST, MOST_IDS = 1 << 12, 1 << 24

    def __init__(self, vocabulary: Vocabulary, most: int = 700_000) -> None:
        self.vocabulary, self.most = vocabulary, most
        self._open()
        self.finder = ChunkFinder(vocabulary.keeps_space)
        self.specials = [x.encode() for x in vocabulary.specials]
        self._clear()

    def _open(self) -> None:
        self.tokenizer = Tokenizer.from_file(self.vocabulary.file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.separator_id = self.tokenizer.token_to_id(self.vocabulary.separator)
        self.vocabulary_size = self.tokenizer.get_vocab_size()
        self.token_bytes = np.zeros(self.vocabulary_size, np.int64)
        for token, k in self.tokenizer.get_vocab().items():
            # A byte-level vocabulary writes one character for each byte.
            self.token_bytes[k] = len(token.removesuffix(self.vocabulary.word_end))

    def _clear(self) -> None:
        #: Sorted hashes, and the entry of each: the large table and the fresh one.
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]
        self.begins = np.zeros(1 << 16, np.int32)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.again = np.zeros(1 << 16, bool)  # entries that were looked up since they were made
        #: Bytes of the entries one after another, with room for a lane; none of entries not in a table.
        self.bytes = np.zeros(1 << 20, np.uint8)
        self.byte_begins = np.zeros(1 << 16, np.int64)
        self.byte_lengths = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint16 if self.vocabulary_size <= 1 << 16 else np.uint32)
        self.entries = self.used = self.bytes_used = 0

    def _shrink(self) -> None:
        """Keep the entries that were looked up again; if those are too many, none."""
        keep = self.again[: self.entries].copy()
        if 2 * keep.sum() > self.most or 2 * self.lengths[: self.entries][keep].sum() > self.MOST_IDS:
            self._clear()
            return
        number = (np.cumsum(keep) - 1).astype(np.int32)
        tables = [(h[keep[e]], number[e[keep[e]]]) for h, e in self.tables]
        lengths = self.lengths[: self.entries][keep].astype(np.int64)
        ids = self.ids[ragged(self.begins[: self.entries][keep].astype(np.int64), lengths)]
        sizes = self.byte_lengths[: self.entries][keep].astype(np.int64)
        held = self.bytes[ragged(self.byte_begins[: self.entries][keep], sizes)]
        self.entries, self.used, self.bytes_used = len(lengths), len(ids), len(held)
        self.bytes[: len(held)] = held
        self.byte_begins[: self.entries] = np.cumsum(sizes) - sizes
        self.byte_lengths[: self.entries] = sizes
        self.begins[: self.entries] = np.cumsum(lengths) - lengths
        self.lengths[: self.entries] = lengths
        self.again[:] = False
        self.ids[: self.used] = ids
        self.tables = [_merged(*tables), (tables[1][0][:0], tables[1][1][:0])]

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, and how many each has.

        Most chunks are words that the library keeps apart by itself; in their joint ids the
        tokens' bytes tell where each ends. The others are joined by the separator.
        """
        if self.vocabulary.keeps_space:
            joint = [c[0] == " " and c[1:2] not in _ASCII_SPACE for c in chunks]
            ids, counts = self._joint_ids([c for c, j in zip(chunks, joint, strict=True) if j], "")
        else:
            joint = [c.isascii() for c in chunks]
            ids, counts = self._joint_ids([c for c, j in zip(chunks, joint, strict=True) if j], " ")
        apart = [c for c, j in zip(chunks, joint, strict=True) if not j]
        if not apart:
            return ids, counts
        more, more_counts = self._apart_ids(apart)
        order = np.argsort(~np.array(joint), kind="stable")  # of the chunks in the two results
        place = np.empty(len(chunks), np.int64)
        place[order] = np.arange(len(chunks))
        both = np.concatenate([counts, more_counts])
        begins = (np.cumsum(both) - both)[place]
        return np.concatenate([ids, more])[ragged(begins, both[place])], both[place]

    def _apart_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(self.vocabulary.separator.join(chunks))
        ends = np.append(np.flatnonzero(ids == self.separator_id), len(ids))
        return ids[ids != self.separator_id], np.diff(ends, prepend=-1) - 1

    def _joint_ids(self, chunks: list[str], between: str) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids = self._ids(between.join(chunks))
        wanted = np.cumsum([len(c.encode()) for c in chunks])
        ends = np.cumsum(self.token_bytes[ids])
        last = np.searchsorted(ends, wanted)
        if last[-1] != len(ids) - 1 or (ends[last] != wanted).any():
            return self._apart_ids(chunks)
        return ids, np.diff(last, prepend=-1)

    def _entry(self, hashes: np.ndarray) -> np.ndarray:
        """Entries of sorted hashes, -1 where unknown."""
        out = np.full(len(hashes), -1, np.int32)
        for known, entry in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                out[hit] = entry[at[hit]]
        return out

    def _known(
        self, hashes: np.ndarray, data: np.ndarray, lane: np.ndarray, at: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the chunks with these sorted hashes, -1 where unknown, and where an entry with the
        hash is another chunk's."""
        entry = self._entry(hashes)
        found = np.flatnonzero(entry >= 0)
        held = entry[found]
        equal = self.byte_lengths[held] == sizes[found]
        found_equal, held = found[equal], held[equal]
        view = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        equal[equal] = same_spans(
            (data, lane), at[found_equal], (self.bytes, view), self.byte_begins[held], sizes[found_equal]
        )
        other = np.zeros(len(hashes), bool)
        other[found[~equal]] = True
        return entry, other

    def _encoded(self, chunks: list[str]) -> np.ndarray:
        """Encode chunks and keep their ids; their entries."""
        first = self.entries
        for at in range(0, len(chunks), self.TOGETHER):
            some = chunks[at : at + self.TOGETHER]
            ids, lengths = self._chunk_ids(some)
            n = self.entries
            while n + len(some) > len(self.begins):
                for name in ("begins", "lengths", "again", "byte_begins", "byte_lengths"):
                    setattr(self, name, _doubled(getattr(self, name)))
            while self.used + len(ids) > len(self.ids):
                self.ids = _doubled(self.ids)
            self.ids[self.used : self.used + len(ids)] = ids
            self.begins[n : n + len(some)] = self.used + np.cumsum(lengths) - lengths
            self.lengths[n : n + len(some)] = lengths
            # Entries that are not in a table are not looked up.
            self.byte_lengths[n : n + len(some)] = 0
            self.entries += len(some)
            self.used += len(ids)
        return np.arange(first, self.entries, dtype=np.int32)

    def _learn(
        self, hashes: np.ndarray, chunks: list[str], data: np.ndarray, at: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """Encode new chunks and put them in the table, given with sorted hashes; their entries."""
        entries = self._encoded(chunks)
        size = int(sizes.sum())
        while self.bytes_used + size + 8 > len(self.bytes):
            self.bytes = _doubled(self.bytes)
        self.bytes[self.bytes_used : self.bytes_used + size] = data[ragged(at, sizes)]
        self.byte_begins[entries] = self.bytes_used + np.cumsum(sizes) - sizes
        self.byte_lengths[entries] = sizes
        self.bytes_used += size
        large, fresh = self.tables
        fresh = _merged(fresh, (hashes, entries))
        if len(fresh[0]) > self.FRESH:
            large, fresh = _merged(large, fresh), (fresh[0][:0], fresh[1][:0])
        self.tables = [large, fresh]
        return entries

    def _hashes(
        self, data: np.ndarray, lane: np.ndarray, begins: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        return hash_spans(data, lane, begins, sizes)

    def _entries_of(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The entry of every chunk."""
        lane = lanes(data)
        hashes = self._hashes(data, lane, begins, sizes)
        # Sorted by the high bits of the hash, whose low bits make room for the chunk's number.
        low = np.uint64((1 << len(hashes).bit_length()) - 1)
        ranked = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))
        order = (ranked & low).astype(np.int64)
        ranked &= ~low
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        example = order[new]
        distinct = hashes[example]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        first = example[group]
        odd = sizes != sizes[first]
        again = np.flatnonzero(~odd & (first != np.arange(len(first))))
        whole = (data, lane)
        odd[again] = ~same_spans(whole, begins[again], whole, begins[first[again]], sizes[again])
        at, lengths = begins[example], sizes[example]
        entry, other = self._known(distinct, data, lane, at, lengths)
        self.again[entry[(entry >= 0) & ~other]] = True
        unknown = entry < 0
        if self.entries + unknown.sum() > self.most or self.used > self.MOST_IDS:
            self._shrink()
            entry, other = self._known(distinct, data, lane, at, lengths)
            unknown = entry < 0
        raw = data.tobytes()

        def texts(some: np.ndarray) -> list[str]:
            spans = zip(begins[some].tolist(), (begins + sizes)[some].tolist(), strict=True)
            return [raw[a:b].decode("utf-8", "replace") for a, b in spans]

        kept = np.flatnonzero(unknown & (lengths <= self.LONGEST))
        entry[kept] = self._learn(distinct[kept], texts(example[kept]), data, at[kept], lengths[kept])
        apart = np.flatnonzero(other | (unknown & (lengths > self.LONGEST)))
        entry[apart] = self._encoded(texts(example[apart]))
        places = entry[group]
        if odd.any():
            places[odd] = self._encoded(texts(np.flatnonzero(odd)))
        return places

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return self.encode_bytes(*byte_view(pa.array(texts, pa.large_string())))

    def encode_bytes(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a byte view; a long text is encoded part by part."""
        parts, owner = self._parts(data, starts)
        found: list[np.ndarray] = []
        for first, last in slices(parts, self.GROUP):
            a = int(parts[first])
            found += self._encode_some(data[a : int(parts[last])], parts[first : last + 1] - a)
        if len(parts) == len(starts):
            return found
        ends = np.searchsorted(owner, np.arange(len(starts)))
        return [
            found[a] if b == a + 1 else np.concatenate(found[a:b])
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]

    def _parts(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where parts of texts begin, each of at most ``GROUP`` bytes if it can be, and their texts.

        A text is cut ahead of a space between two plain ASCII characters: nothing that a
        vocabulary does to a text, normal forms and special tokens included, reaches across.
        """
        owner = np.arange(len(starts) - 1)
        cuts: list[int] = []
        for k in np.flatnonzero(np.diff(starts) > self.GROUP).tolist():
            at, end, size = int(starts[k]), int(starts[k + 1]), self.GROUP
            while at + size < end:
                some = data[at : at + size]
                plain = (some > 32) & (some < 127)
                places = np.flatnonzero((some[1:-1] == 32) & plain[:-2] & plain[2:])
                if not len(places):
                    size *= 2
                    continue
                at += int(places[-1]) + 1
                cuts.append(at)
                size = self.GROUP
        if not cuts:
            return starts, owner
        place = np.searchsorted(starts, cuts, "right")
        return np.insert(starts, place, cuts), np.insert(owner, place, owner[place - 1])

    def _as_they_are(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Texts with special tokens, and with rare white space where white space counts."""
        places = [_rare_space(data)] if self.vocabulary.keeps_space else []
        raw = data.tobytes()
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                places.append(np.array([at]))
                at = raw.find(special, at + 1)
        places = np.concatenate(places) if places else np.zeros(0, np.int64)
        return np.unique(np.searchsorted(starts, places, "right") - 1)

    def _encode_some(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        whole = {
            int(k): self._ids(data[starts[k] : starts[k + 1]].tobytes().decode())
            for k in self._as_they_are(data, starts)
        }
        if not self.vocabulary.keeps_space:
            data = _lowered(data, starts)
        begins, ends = self.finder.find(data, starts)
        if whole:
            done = np.isin(np.searchsorted(starts, begins, "right") - 1, list(whole))
            begins, ends = begins[~done], ends[~done]
        places = self._entries_of(data, begins, ends - begins)
        lengths = self.lengths[places].astype(np.int64)
        ids = self.ids[ragged(self.begins[places].astype(np.int64), lengths)].astype(np.uint32)
        after = np.concatenate([[0], np.cumsum(lengths)])
        bounds = after[np.searchsorted(begins, starts)]
        return [
            whole[k] if k in whole else ids[bounds[k] : bounds[k + 1]]
            for k in range(len(starts) - 1)
        ]


def _doubled(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values, np.zeros_like(values)])


def _merged(a, b):
    hashes, entries = (np.concatenate(x) for x in zip(a, b, strict=True))
    order = np.argsort(hashes, kind="stable")
    return hashes[order], entries[order]


def _lowered(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters, ahead of a tokenizer that lowers anyway.

    Only in texts without characters beyond Latin-1, which are in normal form.
    """
    plain = np.ones(len(data), bool)
    if (high := np.flatnonzero(data >= 0xC4)).size:
        texts = np.unique(np.searchsorted(starts, high, "right") - 1)
        plain[ragged(starts[texts], starts[texts + 1] - starts[texts])] = False
    capital = (data >= 65) & (data <= 90)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return np.where(capital & plain, data + 32, data).astype(np.uint8)


def worker_encoder(vocabulary: Vocabulary, kind: type[ChunkEncoder] = ChunkEncoder) -> ChunkEncoder:
    """This Python process's encoder, kept between tasks."""
    kept = sys.modules.setdefault("_chunk_encoders", ModuleType("_chunk_encoders"))
    name = f"{kind.__name__}_{vocabulary.file}"
    if not hasattr(kept, name):
        setattr(kept, name, kind(vocabulary))
    return getattr(kept, name)
