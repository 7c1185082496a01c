"""Many byte spans of an array at once: their hashes, whether they are equal, and a table of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from martloom.llm.common import ragged

#: Primes of XXH64. Fixed values of the hash.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)
#: The low 0 to 8 bytes of a lane.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are hashed and compared one by one.
_STRIPE = 32


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on, as little-endian integers; zeros follow it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def hash_spans(
    data: np.ndarray, lane: np.ndarray, begins: np.ndarray, lengths: np.ndarray, seed: int = 0
) -> np.ndarray:
    """XXH64 of every span; ``lane`` is ``lanes(data)``."""
    out = np.empty(len(begins), np.uint64)
    # Small numbers are sorted by counting.
    by_length = np.minimum(lengths, _STRIPE).astype(np.uint8)
    order = np.argsort(by_length, kind="stable")
    short = int(np.searchsorted(by_length[order], _STRIPE))
    at, left = (x[order[:short]].astype(np.int64) for x in (begins, by_length))
    h = left.astype(np.uint64) + (np.uint64(seed) + _P5)
    for k in range(0, _STRIPE - 8, 8):
        # Spans are sorted by length: those with another whole lane are the last ones.
        some = int(np.searchsorted(left, k + 8))
        if some == short:
            break
        mixed = _turned(lane[at[some:] + k] * _P2, 31) * _P1
        h[some:] = _turned(h[some:] ^ mixed, 27) * _P1 + _P4
    tail = at + (left & -8)
    some = np.flatnonzero(left & 4)
    half = lane[tail[some]] & _LOW[4]
    h[some] = _turned(h[some] ^ (half * _P1), 23) * _P2 + _P3
    tail[some] += 4
    for k in range(3):
        some = np.flatnonzero((left & 3) > k)
        byte = data[tail[some] + k].astype(np.uint64)
        h[some] = _turned(h[some] ^ (byte * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    out[order[:short]] = h ^ (h >> np.uint64(32))
    for k in order[short:].tolist():
        a = int(begins[k])
        out[k] = xxhash.xxh64_intdigest(data[a : a + int(lengths[k])], seed)
    return out


def same_spans(
    one: tuple[np.ndarray, np.ndarray],
    a: np.ndarray,
    two: tuple[np.ndarray, np.ndarray],
    b: np.ndarray,
    lengths: np.ndarray,
) -> np.ndarray:
    """Whether the bytes from ``a`` on in one array are those from ``b`` on in another.

    ``one`` and ``two`` are an array and its lanes; the spans of a pair are of one length.
    """
    first, second = one[1], two[1]
    same = ((first[a] ^ second[b]) & _LOW[np.minimum(lengths, 8)]) == 0
    for k in range(8, _STRIPE, 8):
        at = np.flatnonzero(lengths > k)
        if not len(at):
            return same
        rest = np.minimum(lengths[at] - k, 8)
        same[at] &= ((first[a[at] + k] ^ second[b[at] + k]) & _LOW[rest]) == 0
    for k in np.flatnonzero(same & (lengths > _STRIPE)).tolist():
        x, y, n = int(a[k]), int(b[k]), int(lengths[k])
        same[k] = np.array_equal(one[0][x : x + n], two[0][y : y + n])
    return same


class SpanTable:
    """The distinct spans of an array, in an open-addressed table keyed by their XXH64.

    A slot holds a key and the number of a distinct span. A span whose key is there is compared with
    the slot's span byte by byte; where the bytes differ the search goes on at the next slot, so
    two spans with one hash are still two spans.
    """

    def __init__(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> None:
        """``found``: the number of each span's distinct span; ``first``: an example of each of these."""
        self.data, self.begins, self.lengths = data, begins, lengths
        self.found, self.first = self._intern()

    def _hashes(self, lane: np.ndarray) -> np.ndarray:
        return hash_spans(self.data, lane, self.begins, self.lengths)

    def _intern(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.begins)
        lane = lanes(self.data)
        whole = (self.data, lane)
        keys = self._hashes(lane)
        bits = max(4, (2 * n).bit_length())
        mask = np.int64((1 << bits) - 1)
        slots = np.full(1 << bits, -1, np.int64)  # an example's place among the spans
        # The low bits of the key say where a span's search begins.
        at = keys.astype(np.int64) & mask
        example = np.empty(n, np.int64)
        open_ = np.arange(n)
        while len(open_):
            place = at[open_]
            free = slots[place] < 0
            # Of those that want one free slot, the last written has it.
            slots[place[free]] = open_[free]
            held = slots[place]
            same = keys[held] == keys[open_]
            same &= self.lengths[held] == self.lengths[open_]
            alike = np.flatnonzero(same)
            same[alike] = same_spans(
                whole,
                self.begins[held[alike]],
                whole,
                self.begins[open_[alike]],
                self.lengths[open_[alike]],
            )
            example[open_[same]] = held[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & mask
        heads = np.zeros(n, bool)
        heads[example] = True
        first = np.flatnonzero(heads)
        number = np.cumsum(heads) - 1
        return number[example], first

    def __len__(self) -> int:
        return len(self.first)

    def values(self) -> Iterator[bytes]:
        """The bytes of every distinct span."""
        raw = self.data.tobytes()
        begins = self.begins[self.first]
        ends = begins + self.lengths[self.first]
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            yield raw[a:b]

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all distinct spans one after another, and where each begins (one entry more)."""
        lengths = self.lengths[self.first].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.data[ragged(self.begins[self.first].astype(np.int64), lengths)], ends
