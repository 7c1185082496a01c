"""BPE encoding with a deterministic automaton over tokens, and decoding by its arc labels.

The automaton reads tokens and accepts exactly the sequences that BPE makes. It starts with one
state and an arc for every byte, and each merge (u, v), in order of rank, adds one gadget:

* an arc uv wherever an arc u is followed by v; the state after uv takes the arcs of the state
  after v;
* the state after u becomes one of its own and loses its arc v.

So the state depends on the last token only. A state's arcs are those of the state it was split
from, as of that merge, without the arcs removed since; an arc uv is there if the arc u was, as
of that merge. The compiled tables keep these links and the removed arcs; an arc that has been
looked up is kept in a transition table.

Every prefix of a word has one accepted path. Encoding goes through the bytes of many words at
once: a byte trie with failure links gives the tokens that end here, longest first, and the one
whose arc leaves the state at its beginning is taken. Words of some thousand bytes, of which there
are few, are gone through one at a time, with the same tables.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.chunk_encoder import ChunkEncoder, Vocabulary, worker_encoder
from martloom.llm.common import byte_view, ragged, with_id

#: How byte-level BPE splits text ahead of the merges. A fixed value of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEVER = np.iinfo(np.int32).max
#: Longer words are not worth a step over arrays for each byte.
LONG_WORD = 2048


def byte_characters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte, as {character: byte}."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ArcLabels:
    """The bytes of every token."""

    def __init__(self, labels: dict[int, bytes]) -> None:
        n = max(labels, default=-1) + 1
        self.lengths = np.array([len(labels.get(t, b"")) for t in range(n)], np.int32)
        self.begins = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.bytes = np.frombuffer(b"".join(labels.get(t, b"") for t in range(n)), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the arcs of a path, one after another."""
        out = []
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)].astype(np.int64)
            places = ragged(self.begins[some], self.lengths[some].astype(np.int64))
            out.append(self.bytes[places].tobytes())
        return b"".join(out)

    def text(self, ids: np.ndarray) -> str:
        return self.decode(ids).decode("utf-8", "replace")


class TokenAutomaton:
    """Compiled from merges over byte strings; token ids are the vocabulary's."""

    def __init__(
        self,
        labels: dict[int, bytes],
        merges: list[tuple[int, int, int]],
        special: frozenset[int] = frozenset(),
    ) -> None:
        """``labels``: the bytes of each token; ``merges``: (u, v, uv) in order of rank.

        ``special`` tokens have labels to decode, but no merges make them from text.
        """
        n = max(labels, default=-1) + 1
        self.label_lengths = np.array([len(labels.get(t, b"")) for t in range(n)], np.int32)
        there = self._compile(n, merges)
        self._index({t: x for t, x in labels.items() if x and there[t] and t not in special})
        self._remember(21)

    def _compile(self, n: int, merges: list[tuple[int, int, int]]) -> list[bool]:
        """The tables, and which tokens have any arc: a merge adds none where u is not followed by v."""
        self.made = np.full(n, -1, np.int32)  # rank of the merge that made a token; -1: a byte
        self.from_arc = np.arange(n, dtype=np.int32)  # the arc that an arc was added along
        self.from_state = np.arange(n, dtype=np.int32)  # whose state a state was split from
        removed = {}
        for rank, (u, v, uv) in enumerate(merges):
            self.made[uv] = rank
            self.from_arc[uv] = u
            self.from_state[uv] = v
            removed[u << 32 | v] = rank
        keys = np.array(list(removed), np.int64)
        order = np.argsort(keys)
        self.removed = keys[order]
        self.removed_at = np.array(list(removed.values()), np.int32)[order]
        there = [True] * n
        u, v, _ = np.array(merges, np.int64).reshape(-1, 3).T
        followed = self._looked_up(u, v, np.arange(len(merges)))
        for (u, v, uv), path in zip(merges, followed.tolist(), strict=True):
            there[uv] = there[u] and there[v] and path
        return there

    def _index(self, labels: dict[int, bytes]) -> None:
        """Byte trie of the labels with failure links worked into its transitions."""
        children: list[dict[int, int]] = [{}]
        token, depth = [-1], [0]
        for t, label in labels.items():
            node = 0
            for byte in label:
                following = children[node].get(byte)
                if following is None:
                    following = len(children)
                    children[node][byte] = following
                    children.append({})
                    token.append(-1)
                    depth.append(depth[node] + 1)
                node = following
            token[node] = t
        size = len(children)
        rows = [(a, byte, b) for a, kids in enumerate(children) for byte, b in kids.items()]
        parent, byte, child = np.array(rows, np.int64).reshape(-1, 3).T
        level = np.array(depth)[child] if size > 1 else np.zeros(0, int)
        # A node without children moves as its failure link does, so it has that one's row.
        inner = np.unique(np.append(parent, 0))
        self.goto = np.zeros((len(inner), 256), np.int32)
        self.row = np.zeros(size, np.int32)
        self.row[inner] = np.arange(len(inner))
        is_inner = np.zeros(size, bool)
        is_inner[inner] = True
        failure = np.zeros(size, np.int64)
        ends = np.array(token)  # the longest token that ends at a node
        self.shorter = np.full(len(self.label_lengths), -1, np.int32)
        for d in range(1, int(level.max(initial=0)) + 1):
            some = np.flatnonzero(level == d)
            p, b, c = parent[some], byte[some], child[some]
            failure[c] = self.goto[self.row[failure[p]], b] if d > 1 else 0
            self.goto[self.row[p], b] = c
            own = ends[c] >= 0
            self.shorter[ends[c][own]] = ends[failure[c][own]]
            ends[c[~own]] = ends[failure[c[~own]]]
            # The next level's transitions, until its own children are put in.
            deep = c[is_inner[c]]
            self.goto[self.row[deep]] = self.goto[self.row[failure[deep]]]
            leaf = c[~is_inner[c]]
            self.row[leaf] = self.row[failure[leaf]]
        self.longest = ends.astype(np.int32)

    def _remember(self, bits: int) -> None:
        self._bits = bits
        self._long_arcs: dict[int, bool] = {}
        self._lists = [x.tolist() for x in (self.made, self.from_arc, self.from_state)]
        self._removed = dict(zip(self.removed.tolist(), self.removed_at.tolist(), strict=True))
        self._known = np.full(1 << bits, _EMPTY, np.uint64)
        self._there = np.zeros(1 << bits, bool)

    def _looked_up(
        self, state: np.ndarray, token: np.ndarray, as_of: np.ndarray | None = None
    ) -> np.ndarray:
        """Whether the arc is there, or was ahead of a merge, by following what both were made from.

        Going back in time, the younger of the two is undone first. The arc is missing if,
        while both of them stood, the arc between them was removed.
        """
        there = np.ones(len(state), bool)
        at = np.arange(len(state))
        a, t = state.astype(np.int64), token.astype(np.int64)
        limit = np.full(len(state), _NEVER, np.int64) if as_of is None else as_of
        if not len(self.removed):
            return there
        while len(at):
            key = a << 32 | t
            place = np.minimum(np.searchsorted(self.removed, key), len(self.removed) - 1)
            rank = np.where(self.removed[place] == key, self.removed_at[place], _NEVER)
            missing = rank < limit
            there[at[missing]] = False
            undo_state = self.made[a] > self.made[t]
            # A merge takes the leftmost pair first: one of the same rank to the left was ahead.
            limit = np.where(undo_state, self.made[a], self.made[t] + 1)
            done = missing | ((self.made[a] < 0) & (self.made[t] < 0))
            a = np.where(undo_state, self.from_state[a], a)
            t = np.where(undo_state, t, self.from_arc[t])
            go = ~done
            at, a, t, limit = at[go], a[go], t[go], limit[go]
        return there

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token's arc leaves each state; state -1 is the start, which has all arcs."""
        out = state < 0
        at = np.flatnonzero(~out)
        key = state[at].astype(np.uint64) << np.uint64(32) | token[at].astype(np.uint64)
        slot = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)
        new = self._known[slot] != key
        if new.any():
            fresh, first = np.unique(key[new], return_index=True)
            slots = slot[new][first]
            found = self._looked_up(fresh >> np.uint64(32), fresh & np.uint64(0xFFFFFFFF))
            self._known[slots] = fresh
            self._there[slots] = found
            # Two new arcs may share a slot, so answers come from what was just found.
            out[at[new]] = found[np.searchsorted(fresh, key[new])]
            old = ~new
            out[at[old]] = self._there_of(slot[old], key[old])
        else:
            out[at] = self._there[slot]
        return out

    def _there_of(self, slot: np.ndarray, key: np.ndarray) -> np.ndarray:
        there = self._there[slot]
        lost = self._known[slot] != key  # its slot was just taken by a new arc
        if lost.any():
            there[lost] = self._looked_up(
                key[lost] >> np.uint64(32), key[lost] & np.uint64(0xFFFFFFFF)
            )
        return there

    def encode(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """The ids of the words data[begins:ends], and how many each has."""
        lengths = (ends - begins).astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        counts = np.zeros(len(order), np.int64)
        found: list[np.ndarray] = []
        first = 0
        while first < len(order) and lengths[order[first]] > LONG_WORD:
            k = order[first]
            found.append(self._encode_long(data[begins[k] : ends[k]]))
            counts[k] = len(found[-1])
            first += 1
        while first < len(order):
            # Words of like length, so that their table has at most some million places.
            longest = max(1, int(lengths[order[first]]))
            some = order[first : first + max(1, 4_000_000 // (longest + 1))]
            ids, n = self._encode_some(data, begins[some].astype(np.int64), lengths[some])
            found.append(ids)
            counts[some] = n
            first += len(some)
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        by_length = counts[order]
        starts = np.empty(len(order), np.int64)
        starts[order] = np.cumsum(by_length) - by_length
        return ids[ragged(starts, counts)].astype(np.uint32), counts

    def _encode_some(self, data, begins, lengths):
        """Words from long to short. ``last[i, k]``: the last token of the first i bytes of word k."""
        words, most = len(lengths), int(lengths[0])
        last = np.full((most + 1, words), -1, np.int32)
        node = np.zeros(words, np.int64)
        for i in range(1, most + 1):
            n = int(np.searchsorted(-lengths, -i, "right"))  # words that are long enough
            node = self.goto[self.row[node[:n]], data[begins[:n] + (i - 1)]]
            open_ = np.arange(n)
            token = self.longest[node]
            while len(open_):
                state = last[i - self.label_lengths[token], open_]
                taken = self.arcs(state, token)
                last[i, open_[taken]] = token[taken]
                open_, token = open_[~taken], self.shorter[token[~taken]]
        # Back along the one path of each word.
        out: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        place, open_ = lengths.copy(), np.flatnonzero(lengths > 0)
        while len(open_):
            token = last[place[open_], open_]
            out.append(token)
            owners.append(open_)
            place[open_] -= self.label_lengths[token]
            open_ = open_[place[open_] > 0]
        counts = np.zeros(words, np.int64)
        for some in owners:
            counts[some] += 1
        ids = np.zeros(int(counts.sum()), np.int32)
        end = np.cumsum(counts) - 1
        for step, (token, some) in enumerate(zip(out, owners, strict=True)):
            ids[end[some] - step] = token
        return ids, counts

    def _encode_long(self, word: np.ndarray) -> np.ndarray:
        """The ids of one word, byte by byte."""
        goto, row, longest, shorter, sizes = (
            self.goto, self.row, self.longest, self.shorter, self.label_lengths
        )
        arcs = self._arcs_by_state()
        last = array("i", [-1]) * (len(word) + 1)
        node = 0
        for i, byte in enumerate(word.tobytes(), 1):
            node = goto[row[node], byte]
            token = int(longest[node])
            while True:
                state = last[i - int(sizes[token])]
                if state < 0:
                    break  # the start has all arcs
                key = state << 32 | token
                there = arcs.get(key)
                if there is None:
                    there = arcs[key] = self._arc(state, token)
                if there:
                    break
                token = int(shorter[token])
            last[i] = token
        out = []
        i = len(word)
        while i:
            out.append(last[i])
            i -= int(sizes[last[i]])
        return np.array(out[::-1], np.int32)

    def _arcs_by_state(self) -> dict[int, bool]:
        """Arcs that long words have looked up, as many as there are slots for others."""
        if len(self._long_arcs) > 1 << self._bits:
            self._long_arcs.clear()
        return self._long_arcs

    def _arc(self, a: int, t: int) -> bool:
        """``_looked_up`` for one arc."""
        made, from_arc, from_state = self._lists
        limit = _NEVER
        while True:
            if self._removed.get(a << 32 | t, _NEVER) < limit:
                return False
            if made[a] < 0 and made[t] < 0:
                return True
            if made[a] > made[t]:
                limit, a = made[a], from_state[a]
            else:
                limit, t = made[t] + 1, from_arc[t]


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _read(path: str) -> tuple[dict, dict[int, bytes], dict[str, int]]:
    """A byte-level BPE file, the bytes of its tokens, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = byte_characters()
    labels = {t: bytes(byte_of[c] for c in x) for x, t in spec["model"]["vocab"].items()}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    return spec, labels | {t: x.encode() for x, t in special.items()}, special


def load_labels(path: str) -> ArcLabels:
    return ArcLabels(_read(path)[1])


def load_automaton(path: str) -> tuple[TokenAutomaton, ArcLabels, dict[str, int]]:
    """The automaton of a byte-level BPE file, its labels, and its special tokens."""
    spec, labels, special = _read(path)
    ids = spec["model"]["vocab"]
    merges = []
    for merge in spec["model"]["merges"]:
        u, v = merge.split(" ") if isinstance(merge, str) else merge
        merges.append((ids[u], ids[v], ids[u + v]))
    automaton = TokenAutomaton(labels, merges, frozenset(special.values()))
    return automaton, ArcLabels(labels), special


class AutomatonEncoder(ChunkEncoder):
    """The chunk table with the automaton in place of the library."""

    TOGETHER = 50_000

    def _open(self) -> None:
        self.automaton, self.labels, self.special_ids = load_automaton(self.vocabulary.file)
        self.vocabulary_size = len(self.automaton.label_lengths)
        self.split = regex.compile(PATTERN).findall
        either = "|".join(regex.escape(x) for x in self.special_ids)
        self.split_special = regex.compile(f"({either})").split if either else lambda x: [x]

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        ends = np.zeros(len(chunks), np.int64)
        for k, chunk in enumerate(chunks):
            words += self.split(chunk)
            ends[k] = len(words)
        data, starts = byte_view(pa.array(words, pa.large_string()))
        ids, counts = self.automaton.encode(data, starts[:-1], starts[1:])
        after = np.concatenate([[0], np.cumsum(counts)])[ends]
        return ids, np.diff(after, prepend=0)

    def _ids(self, text: str) -> np.ndarray:
        out = []
        for part in self.split_special(text):
            if part in self.special_ids:
                out.append(np.array([self.special_ids[part]], np.uint32))
            else:
                out.append(self._chunk_ids([part])[0])
        return np.concatenate(out)


def _encode(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, decoded: bool
) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(vocabulary, AutomatonEncoder)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            found = encoder.encode_bytes(*byte_view(batch.column(1).slice(at, 512)))
            raw = [pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())]
            if decoded:
                raw.append(pa.array([encoder.labels.text(x) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, 512), *raw], names=["id", "ids", "decoded"][: 1 + len(raw)]
            )


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    labels = load_labels(vocabulary.file)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            some = batch.slice(at, 1024)
            raw = (np.frombuffer(x or b"", "<u4") for x in some.column("ids").to_pylist())
            texts = [labels.text(x) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )


def encode_with_automaton(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    decoded: bool = False,
) -> DataFrame:
    """id and ids (binary: little-endian unsigned 32-bit integers) of every whole text, and, if
    asked for, the text that the ids decode to.

    NULL and empty texts have no ids. The strings of special tokens become their ids. Repeated rows
    give repeated results, NULL ids stay, no rows give no rows, and columns besides id and text
    are not looked at.
    """
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(
            partial(_encode, vocabulary=vocabulary, decoded=decoded),
            with_id(docs, id_col, "ids binary" + ", decoded string" * decoded),
        )
        .withColumnRenamed("id", id_col)
    )


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id") -> DataFrame:
    """id, ids and the decoded text of rows of id and ids; NULL ids decode to an empty text.

    Bytes that are not UTF-8 become replacement characters, as the vocabulary's library does.
    """
    return (
        encoded.select(F.col(id_col).alias("id"), "ids")
        .mapInArrow(
            partial(_decode, vocabulary=vocabulary),
            with_id(encoded, id_col, "ids binary, decoded string"),
        )
        .withColumnRenamed("id", id_col)
    )
