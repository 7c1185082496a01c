"""Re-Pair grammar compression of token ids.

A shard's ids are one sequence. Again and again the frequent pairs of neighbours are replaced by
new symbols; each rule keeps the two symbols it stands for and how many ids it expands to, so
any stretch of the sequence can be decoded without the rest.

Pairs are replaced many at a time: the chosen pairs' first symbols and second symbols are
disjoint sets, so no two chosen pairs can overlap and the outcome does not depend on an order.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from martloom.llm.common import ragged

MAGIC = b"RPG1"
#: An entry of the place index for so many symbols.
STRIDE = 256


@dataclass(frozen=True)
class Grammar:
    """Symbols below ``base`` are ids; symbol ``base + k`` is rule k."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # ids that each rule expands to
    sequence: np.ndarray

    @property
    def n_ids(self) -> int:
        return int(self._sizes(self.sequence).sum())

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        is_rule = symbols >= self.base
        sizes = np.ones(len(symbols), np.int64)
        sizes[is_rule] = self.lengths[symbols[is_rule].astype(np.int64) - self.base]
        return sizes

    def expand(self) -> np.ndarray:
        """All ids."""
        return _unfold(self, self.sequence)


def _unfold(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids of any symbols. The rules' own expansions are laid out once, then copied."""
    begins = np.cumsum(grammar.lengths, dtype=np.int64) - grammar.lengths
    flat = np.zeros(int(grammar.lengths.sum()), np.uint32)
    base = grammar.base
    for first, last in _layers(grammar):
        for part, shift in ((grammar.left, None), (grammar.right, grammar.left)):
            child = part[first:last].astype(np.int64)
            at = begins[first:last].copy()
            if shift is not None:
                at += grammar._sizes(shift[first:last])
            leaf = child < base
            flat[at[leaf]] = child[leaf]
            sizes = grammar._sizes(child[~leaf])
            flat[ragged(at[~leaf], sizes)] = flat[ragged(begins[child[~leaf] - base], sizes)]
    symbols = symbols.astype(np.int64)
    sizes = grammar._sizes(symbols)
    is_rule = symbols >= base
    # A place of its own in the layout for each id that stands alone.
    alone = np.flatnonzero(~is_rule)
    source = np.concatenate([flat, symbols[alone].astype(np.uint32)])
    begin = np.empty(len(symbols), np.int64)
    begin[alone] = len(flat) + np.arange(len(alone))
    begin[is_rule] = begins[symbols[is_rule] - base]
    return source[ragged(begin, sizes)]


def _layers(grammar: Grammar):
    """Runs of rules that use only rules of earlier runs."""
    first, n = 0, len(grammar.left)
    newest = np.maximum(grammar.left, grammar.right).astype(np.int64) - grammar.base
    while first < n:
        late = np.flatnonzero(newest[first:] >= first)
        last = first + int(late[0]) if len(late) else n
        yield first, last
        first = last


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[begins], np.diff(begins, append=len(keys))


def _pairs_at(sequence: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The pairs of neighbours that begin at some places, each place once."""
    marked = np.zeros(len(sequence) + 1, bool)
    marked[places] = True
    at = np.flatnonzero(marked[: len(sequence) - 1])
    return sequence[at].astype(np.uint64) << np.uint64(32) | sequence[at + 1]


def _frequent(
    keys: np.ndarray, counts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that occur at least ``least`` times, most frequent first."""
    often = counts >= least
    keys, counts = keys[often], counts[often]
    order = np.lexsort((keys, -counts))
    return keys[order], counts[order]


def _recounted(
    keys: np.ndarray, counts: np.ndarray, lost: np.ndarray, new: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs once some occurrences are gone and others are there.

    Pairs without a new symbol only get rarer, so those that were not frequent need no count.
    """
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    gone, times = _counted(lost)
    at = np.minimum(np.searchsorted(keys, gone), max(0, len(keys) - 1))
    known = keys[at] == gone
    counts[at[known]] -= times[known]
    more, more_counts = _counted(new)
    return _frequent(np.concatenate([keys, more]), np.concatenate([counts, more_counts]), least)


def _disjoint(keys: np.ndarray) -> np.ndarray:
    """The pairs that can be replaced together, taken greedily from the most frequent on.

    No chosen pair begins with what another one ends with. A pair of one symbol has that
    symbol to itself.
    """
    firsts: set[int] = set()
    seconds: set[int] = set()
    chosen = []
    lefts, rights = (keys >> np.uint64(32)).tolist(), (keys & np.uint64(0xFFFFFFFF)).tolist()
    for k, (a, b) in enumerate(zip(lefts, rights, strict=True)):
        if a in seconds or b in firsts or (a == b and (a in firsts or a in seconds)):
            continue
        firsts.add(a)
        seconds.add(b)
        chosen.append(k)
    return keys[chosen]


def _places(sequence: np.ndarray, chosen: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a chosen pair is to be replaced, and which."""
    is_first, is_second = np.zeros(top, bool), np.zeros(top, bool)
    is_first[(chosen >> np.uint64(32)).astype(np.int64)] = True
    is_second[(chosen & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(is_first.take(sequence[:-1]) & is_second.take(sequence[1:]))
    left, right = sequence[at], sequence[at + 1]
    key = left.astype(np.uint64) << np.uint64(32) | right
    rule = np.searchsorted(chosen, key)
    hit = chosen[np.minimum(rule, len(chosen) - 1)] == key
    double = hit & (left == right)
    if double.any():  # of a run of one symbol, every other place
        places = at[double]
        begins = places[np.concatenate([[True], np.diff(places) > 1])]
        odd = (places - begins[np.searchsorted(begins, places, "right") - 1]) % 2 == 1
        hit[np.flatnonzero(double)[odd]] = False
    return at[hit], rule[hit]


def compress(
    ids: np.ndarray, base: int, least: int = 16, share: float = 0.005, worth: float = 0.0
) -> Grammar:
    """Replace pairs until none occurs ``least`` times or a round saves less than ``worth``.

    Each round takes the pairs at least ``share`` times as frequent as the most frequent one. All
    pairs are counted once; then only those beside replaced ones.
    """
    sequence = ids.astype(np.uint32)
    lefts, rights = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    lengths = np.ones(base, np.int64)
    top = base
    keys, counts = _frequent(*_counted(_pairs_at(sequence, np.arange(len(sequence)))), least)
    while len(keys):
        chosen = np.sort(_disjoint(keys[counts >= max(least, int(counts[0] * share))]))
        at, rule = _places(sequence, chosen, top)
        left = (chosen >> np.uint64(32)).astype(np.uint32)
        right = (chosen & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        # A place ahead of the first symbol is the last one of ``_pairs_at``, where no pair begins.
        lost = _pairs_at(sequence, np.concatenate([at - 1, at, at + 1]))
        sequence[at] = (top + rule).astype(np.uint32)
        stay = np.ones(len(sequence), bool)
        stay[at + 1] = False
        sequence = sequence[stay]
        made = at - np.arange(len(at))  # as many symbols ahead are gone
        new = _pairs_at(sequence, np.concatenate([made - 1, made]))
        lefts.append(left)
        rights.append(right)
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
        top += len(chosen)
        if len(at) < worth * len(sequence):
            break
        keys, counts = _recounted(keys, counts, lost, new, least)
    return Grammar(
        base, np.concatenate(lefts), np.concatenate(rights), lengths[base:], sequence
    )


def pack(grammar: Grammar) -> bytes:
    """Header, rules, rule lengths, symbols in as few bytes each as they need, place index."""
    top = grammar.base + len(grammar.left)
    width = max(1, (top.bit_length() + 7) // 8)
    places = np.cumsum(grammar._sizes(grammar.sequence))

    def narrow(symbols: np.ndarray) -> bytes:
        raw = np.ascontiguousarray(symbols.astype("<u4")).view(np.uint8).reshape(-1, 4)
        return raw[:, :width].tobytes()

    index = np.concatenate([[0], places[STRIDE - 1 :: STRIDE]]).astype("<u8")
    counts = (grammar.base, len(grammar.left), len(grammar.sequence), len(index), width)
    return b"".join(
        [
            MAGIC,
            struct.pack("<5Q", *counts),
            narrow(grammar.left),
            narrow(grammar.right),
            grammar.lengths.astype("<u4").tobytes(),
            narrow(grammar.sequence),
            index.tobytes(),
        ]
    )


@dataclass(frozen=True)
class Shard:
    grammar: Grammar
    index: np.ndarray  # ids before every STRIDE-th symbol

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids [start, stop), expanding only the symbols that hold them."""
        stop = min(stop, self.grammar.n_ids) if stop > start else start
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = max(0, int(np.searchsorted(self.index, start, "right")) - 1)
        last = int(np.searchsorted(self.index, stop, "left"))
        symbols = self.grammar.sequence[first * STRIDE : last * STRIDE]
        before = int(self.index[first])
        out: list[int] = []
        for symbol, size in zip(symbols.tolist(), self.grammar._sizes(symbols).tolist(), strict=True):
            if before < stop and before + size > start:
                self._descend(symbol, before, start, stop, out)
            before += size
        return np.array(out, np.uint32)

    def _descend(self, symbol: int, before: int, start: int, stop: int, out: list[int]) -> None:
        """Add the ids of a symbol that lie in [start, stop); lengths tell which half to enter."""
        g, open_ = self.grammar, [(symbol, before)]
        while open_:
            symbol, before = open_.pop()
            if symbol < g.base:
                out.append(symbol)
                continue
            rule = symbol - g.base
            left, right = int(g.left[rule]), int(g.right[rule])
            middle = before + (1 if left < g.base else int(g.lengths[left - g.base]))
            if middle < stop and before + int(g.lengths[rule]) > start:
                open_.append((right, middle))
            if middle > start:
                open_.append((left, before))


def unpack(payload: bytes) -> Shard:
    if payload[:4] != MAGIC:
        raise ValueError("not a grammar shard")
    base, n_rules, n_symbols, n_index, width = struct.unpack_from("<5Q", payload, 4)
    at = 44

    def wide(n: int) -> np.ndarray:
        nonlocal at
        raw = np.zeros((n, 4), np.uint8)
        raw[:, :width] = np.frombuffer(payload, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        return raw.reshape(-1).view("<u4")

    left, right = wide(n_rules), wide(n_rules)
    lengths = np.frombuffer(payload, "<u4", n_rules, at).astype(np.int64)
    at += 4 * n_rules
    sequence = wide(n_symbols)
    index = np.frombuffer(payload, "<u8", n_index, at).astype(np.int64)
    return Shard(Grammar(base, left, right, lengths, sequence), index)
