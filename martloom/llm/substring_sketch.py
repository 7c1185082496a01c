"""Removal of repeated passages with a count-min prefilter.

A window is so many consecutive words of one document. Words covered by a window that also
starts anywhere else are removed.

First, every task sketches its windows. A window is entered by its anchor, the run of ``GRAM`` words in
it with the smallest hash, and each place of an anchor once: equal windows have equal anchors
at different places, so an anchor's count is never below the count of any of its windows, and
far fewer entries are made than there are windows. The sketch is cut into segments, each a count-min
sketch of the anchors whose hashes fall into it; the tasks' sketches are merged segment by segment.

What the merged sketch says is a bit a cell: counted more than once. As long as all bits are a bounded
broadcast, tasks look anchors up in it. Of more text the segments stay where they were merged, and
say which anchors are counted more than once; documents are joined with those of their own.

Second, windows whose anchor is estimated repeated, and no others, are grouped exactly by a
128-bit hash of their words, two hashes that share nothing. Those that turn out to stand alone were false alarms; they
are the few rows that go back to their documents. Every other window so estimated is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import (
    SLICE,
    SpanHasher,
    byte_view,
    fields,
    ragged,
    runs,
    stored,
    word_slices,
)
from martloom.llm.spans import hash_spans, lanes

GRAM = 8
DEPTH = 3
#: A segment has so many cells in each row of its sketch, some four for each anchor.
SEGMENT_BITS = 18
#: So many segments have 96 MB of bits and are broadcast; more are not.
MOST_BROADCAST = 1 << 10
#: Of the hash of a word that windows are grouped by besides the one that anchors are made of.
SECOND_SEED = 0xA0761D6478BD642F
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _sliding(values: np.ndarray, length: int, pick: np.ufunc) -> np.ndarray:
    """The smallest or largest of every ``length`` neighbours."""
    out, have = values, 1
    while have < length:
        step = min(have, length - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


@dataclass
class Windows:
    """Words of some texts, and their windows by number of the first word."""

    data: np.ndarray
    begins: np.ndarray  # of words
    ends: np.ndarray
    first: np.ndarray  # first word of each text, one entry more
    hashes: np.ndarray  # of words
    grams: np.ndarray
    anchors: np.ndarray  # of each window, its smallest gram
    valid: np.ndarray  # whether a window lies in one text
    text_ends: np.ndarray  # where the bytes of each text end

    def until(self, n: int) -> Windows:
        """The first n words of one text; what follows them up to the next word is theirs."""
        end = self.begins[n : n + 1] if n < len(self.begins) else self.text_ends
        return replace(
            self, begins=self.begins[:n], ends=self.ends[:n], first=np.array([0, n]), text_ends=end
        )


class WindowFinder:
    def __init__(self, window: int) -> None:
        self.window, self.gram = window, min(GRAM, window)
        self.words, self.seconds = SpanHasher(), SpanHasher(0xC2B2AE3D27D4EB4F)

    def find(self, data: np.ndarray, starts: np.ndarray) -> Windows:
        begins, ends = runs(~_SPACE[data], starts)
        hashes = hash_spans(data, lanes(data), begins, ends - begins)
        first = np.searchsorted(begins, starts)
        grams = self.words.windows(self.words.sums(hashes), self.gram)
        n = max(0, len(begins) - self.window + 1)
        anchors = _sliding(grams, self.window - self.gram + 1, np.minimum)[:n]
        text = np.repeat(np.arange(len(starts) - 1), np.diff(first))
        valid = text[:n] == text[self.window - 1 :]
        return Windows(data, begins, ends, first, hashes, grams, anchors, valid, starts[1:])

    def anchor_places(self, w: Windows) -> np.ndarray:
        """The hash of every gram that is the anchor of a window, once for each place."""
        n, span = len(w.anchors), self.window - self.gram + 1
        if not n:
            return w.anchors
        held = np.where(w.valid, w.anchors, 0)
        padding = np.zeros(span - 1, np.uint64)
        # No window's anchor is above a gram of it, so one equals it if the largest does.
        largest = _sliding(np.concatenate([padding, held, padding]), span, np.maximum)
        return w.grams[(largest == w.grams) & (largest > 0)]

    def keys(self, w: Windows, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of windows as two arrays: of both, words have a hash of their own."""
        ends = places + self.window
        one = self.words.spans(self.words.sums(w.hashes), places, ends)
        held = np.zeros(len(w.begins) + 1, np.int64)
        np.add.at(held, places, 1)
        np.add.at(held, ends, -1)
        some = np.flatnonzero(np.cumsum(held[:-1]))
        second = np.zeros(len(w.begins), np.uint64)
        second[some] = hash_spans(
            w.data, lanes(w.data), w.begins[some], (w.ends - w.begins)[some], SECOND_SEED
        )
        return one, self.seconds.spans(self.seconds.sums(second), places, ends)


def cells(anchors: np.ndarray) -> Iterator[np.ndarray]:
    """The cell of each anchor in each row of its segment."""
    for row in range(DEPTH):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * row + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
        mixed = (anchors ^ (anchors >> np.uint64(29))) * odd
        yield (mixed >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64)


def segments_of(anchors: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each anchor: so many, a power of two."""
    mixed = (anchors ^ (anchors >> np.uint64(32))) * np.uint64(0xD1342543DE82EF95)
    return (mixed >> np.uint64(20)).astype(np.int64) & (segments - 1)


def _stretches(data: np.ndarray, starts: np.ndarray, window: int):
    """Stretches of texts that hold every window of them once."""
    return word_slices(data, starts, ~_SPACE, window - 1, SLICE)


def _sketch(
    batches: Iterator[pa.RecordBatch], window: int, segments: int
) -> Iterator[pa.RecordBatch]:
    """This task's sketch: for each segment, the anchors counted once and those counted more."""
    finder = WindowFinder(window)
    held: list[np.ndarray] = []

    def packed() -> pa.RecordBatch:
        anchors, count = np.unique(np.concatenate(held), return_counts=True)
        segment = segments_of(anchors, segments)
        order = np.argsort(segment, kind="stable")
        anchors, count, segment = anchors[order], count[order], segment[order]
        edges = np.flatnonzero(np.diff(segment, prepend=-1, append=-2))
        once, more = [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            some, single = anchors[a:b], count[a:b] == 1
            once.append(some[single].tobytes())
            more.append(some[~single].tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(segment[edges[:-1]], pa.int64()),
                pa.array(once, pa.binary()),
                pa.array(more, pa.binary()),
            ],
            names=["segment", "once", "more"],
        )

    for batch in batches:
        data, starts = byte_view(batch.column(0))
        for _, edges, _ in _stretches(data, starts, window):
            a = int(edges[0])
            found = finder.find(data[a : int(edges[-1])], edges - a)
            held.append(finder.anchor_places(found))
        if sum(map(len, held)) > 4_000_000:
            yield packed()
            held.clear()
    if held and sum(map(len, held)):
        yield packed()


def _counted(lists: pa.Table) -> np.ndarray:
    """A segment's rows of bits: counted more than once by all tasks together."""
    out = np.zeros((DEPTH, 1 << SEGMENT_BITS), np.uint8)
    for once, more in zip(lists["once"], lists["more"], strict=True):
        for weight, raw in ((1, once), (2, more)):
            anchors = np.frombuffer(raw.as_buffer(), np.uint64)
            for row, cell in zip(out, cells(anchors), strict=True):
                cell, times = np.unique(cell, return_counts=True)
                row[cell] = np.minimum(row[cell] + np.minimum(times * weight, 2), 2)
    return out > 1


def _bits(key: tuple, lists: pa.Table) -> pa.Table:
    packed = np.packbits(_counted(lists), axis=1, bitorder="little").tobytes()
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([packed], pa.binary())})


def _often(key: tuple, lists: pa.Table) -> pa.Table:
    """The anchors of a segment that are counted more than once."""
    bits = _counted(lists)
    raw = [x.as_buffer() for name in ("once", "more") for x in lists[name]]
    anchors = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in raw]))
    marked = np.ones(len(anchors), bool)
    for row, cell in zip(bits, cells(anchors), strict=True):
        marked &= row[cell]
    return pa.table({"anchor": pa.array(anchors[marked].view(np.int64))})


def _sketches(docs: DataFrame, window: int, segments: int) -> GroupedData:
    return (
        docs.select("text")
        .mapInArrow(
            partial(_sketch, window=window, segments=segments),
            "segment long, once binary, more binary",
        )
        .groupBy("segment")
    )


def merged_sketch(docs: DataFrame, window: int, segments: int) -> np.ndarray:
    """Segments x rows x bytes; at most MOST_BROADCAST segments."""
    out = np.zeros((segments, DEPTH, (1 << SEGMENT_BITS) // 8), np.uint8)
    merged = _sketches(docs, window, segments).applyInArrow(_bits, "segment long, bits binary")
    for r in merged.toLocalIterator():
        out[r.segment] = np.frombuffer(r.bits, np.uint8).reshape(DEPTH, -1)
    return out


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of every document."""
    finder = WindowFinder(window)
    for batch in batches:
        data, starts = byte_view(batch.column(2))
        for first, edges, _ in _stretches(data, starts, window):
            a = int(edges[0])
            w = finder.find(data[a : int(edges[-1])], edges - a)
            places = np.flatnonzero(w.valid)
            text = np.searchsorted(w.first, places, "right") - 1
            anchors = w.anchors[places]
            # Neighbours mostly share an anchor.
            new = np.ones(len(places), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
            index = pa.array(first + text[new])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(index),
                    batch.column(1).take(index),
                    pa.array(anchors[new].view(np.int64)),
                ],
                names=["id", "mark", "anchor"],
            )


def repeated_anchors(docs: DataFrame, window: int, segments: int) -> DataFrame:
    """id, mark and anchors: those of each document that are counted more than once."""
    often = _sketches(docs, window, segments).applyInArrow(_often, "anchor long")
    often = stored(often, "repeated-anchors")
    own = docs.select("id", "mark", "text").mapInArrow(
        partial(_anchors, window=window),
        T.StructType([docs.schema["id"], *fields("mark long, anchor long")]),
    )
    return stored(
        own.join(often, "anchor", "left_semi")
        .groupBy("id", "mark")
        .agg(F.collect_set("anchor").alias("anchors")),
        "anchors-by-document",
    )


def sketch_segments(docs: DataFrame) -> int:
    """By the amount of text: an anchor comes about every 80 bytes, and has some four cells."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    return 1 << max(0, (size // 20 >> SEGMENT_BITS).bit_length())


class Sketch:
    """Looks anchors up in a broadcast sketch."""

    def __init__(self, sketch: Broadcast) -> None:
        self.sketch = sketch

    def among(self, batch: pa.RecordBatch) -> Sketch:
        return self

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        bits = self.sketch.value
        segment, out = segments_of(anchors, len(bits)), np.ones(len(anchors), bool)
        for row, cell in enumerate(cells(anchors)):
            out &= (bits[segment, row, cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return out


class Listed:
    """Looks anchors up among those that came with the documents at hand, in the last column."""

    def __init__(self, anchors: np.ndarray | None = None) -> None:
        self.anchors = anchors

    def among(self, batch: pa.RecordBatch) -> Listed:
        flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
        return Listed(np.unique(flat.astype(np.int64)))

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        if not len(self.anchors):
            return np.zeros(len(anchors), bool)
        wanted = anchors.view(np.int64)
        at = np.minimum(np.searchsorted(self.anchors, wanted), len(self.anchors) - 1)
        return self.anchors[at] == wanted


def _estimated(w: Windows, marks: Sketch | Listed) -> np.ndarray:
    """Whether each window is estimated to occur more than once."""
    n = len(w.anchors)
    if not n:
        return np.zeros(0, bool)
    change = np.flatnonzero(np.concatenate([[True], w.anchors[1:] != w.anchors[:-1]]))
    repeated = marks.repeated(w.anchors[change])
    return np.repeat(repeated, np.diff(change, append=n)) & w.valid


def _suspects(
    batches: Iterator[pa.RecordBatch], window: int, marks: Sketch | Listed
) -> Iterator[pa.RecordBatch]:
    """A row for each distinct suspect window of some texts: its hash, count up to 2, a place."""
    finder = WindowFinder(window)
    for batch in batches:
        ids, mark = batch.column(0), batch.column(1).to_numpy()
        data, starts = byte_view(batch.column(2))
        here = marks.among(batch)
        found: list[tuple[np.ndarray, ...]] = []
        ahead = 0  # words of a long text before the stretch
        for first, edges, seen in _stretches(data, starts, window):
            a = int(edges[0])
            w = finder.find(data[a : int(edges[-1])], edges - a)
            ahead = ahead - seen if seen else 0
            places = np.flatnonzero(_estimated(w, here))
            text = np.searchsorted(w.first, places, "right") - 1
            found.append((*finder.keys(w, places), first + text, ahead + places - w.first[text]))
            ahead += len(w.begins)
            if sum(len(x[0]) for x in found) > 1 << 20:
                yield _distinct(ids, mark, found)
                found = []
        if found:
            yield _distinct(ids, mark, found)


def _distinct(
    ids: pa.Array, mark: np.ndarray, found: list[tuple[np.ndarray, ...]]
) -> pa.RecordBatch:
    one, two, text, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    head = np.flatnonzero(new)
    count = np.minimum(np.diff(head, append=len(order)), 2)
    text, place = text[order[head]], place[order[head]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(one[head].view(np.int64)),
            pa.array(two[head].view(np.int64)),
            pa.array(count.astype(np.int8)),
            ids.take(pa.array(text)),
            pa.array(mark[text]),
            pa.array(place.astype(np.int32)),
        ],
        names=["one", "two", "n", "id", "mark", "place"],
    )


def covered(w: Windows, repeated: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    steps = np.zeros(len(w.begins) + 1, np.int32)
    at = np.flatnonzero(repeated)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _removal(
    batches: Iterator[pa.RecordBatch], window: int, marks: Sketch | Listed, keep_space: bool
) -> Iterator[pa.RecordBatch]:
    finder = WindowFinder(window)
    for batch in batches:
        data, starts = byte_view(batch.column(1))
        alone, here = batch.column(2), marks.among(batch)
        long: LongText | None = None
        for first, edges, seen in _stretches(data, starts, window):
            a, n = int(edges[0]), len(edges) - 1
            w = finder.find(data[a : int(edges[-1])], edges - a)
            repeated = _estimated(w, here)
            whole = edges[0] == starts[first] and edges[-1] == starts[first + n]
            ahead = 0 if whole or not seen else long.ahead
            for k in np.flatnonzero(alone.slice(first, n).is_valid().to_numpy(False)):
                lone = alone[first + int(k)].values.to_numpy() - ahead
                repeated[w.first[k] + lone[(lone >= 0) & (lone < len(repeated) - w.first[k])]] = False
            gone = covered(w, repeated, window)
            doc = batch.column(0).slice(first, n)
            if whole:
                yield _rows(doc, *_kept(w, gone, keep_space))
                continue
            if not seen:
                long = LongText()
            last = bool(edges[-1] == starts[first + 1])
            long.add(w, repeated, gone, window, last, keep_space)
            if last:
                yield _rows(doc, *long.whole(keep_space))


class LongText:
    """The kept words of a text that is gone through in stretches, whose last words come again."""

    def __init__(self) -> None:
        self.ahead = self.n_words = self.n_removed = self.pending = 0
        self.kept: list[bytes] = []
        self.last_gone = False

    def add(
        self, w: Windows, repeated: np.ndarray, gone: np.ndarray, window: int, last: bool, keep_space: bool
    ) -> None:
        # Words that come again are settled by the next stretch, but for those a window covers here.
        n = len(w.begins) if last else len(w.begins) - (window - 1)
        gone[: self.pending] = True
        starts = np.flatnonzero(repeated)
        reach = max(int(starts[-1]) + window if len(starts) else 0, self.pending)
        self.pending = max(0, reach - n)
        kept, words, removed = _kept(w.until(n), gone[:n], keep_space, whole=False)
        self.last_gone = bool(gone[n - 1]) if n else self.last_gone
        self.kept.append(kept[0].as_buffer().to_pybytes())
        self.n_words += int(words[0])
        self.n_removed += int(removed[0])
        self.ahead += n

    def whole(self, keep_space: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        text = b"".join(self.kept) if keep_space else b" ".join(x for x in self.kept if x)
        if self.last_gone:
            text = text.rstrip(b" \t\n\v\f\r")
        counts = np.array([self.n_words]), np.array([self.n_removed])
        return pa.array([text.decode()], pa.large_string()), *counts


def _kept(
    w: Windows, gone: np.ndarray, keep_space: bool, whole: bool = True
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words that stay, how many there were, and how many go, of every text or part of one.

    Words are joined by one space or, if ``keep_space``, each has the white space that follows it.
    """
    n_words = np.diff(w.first)
    total = np.concatenate([[0], np.cumsum(gone)])
    n_removed = np.diff(total[w.first])
    left = n_words - n_removed
    if keep_space:
        # Up to the next word of the text, or its end.
        until = np.append(w.begins[1:], len(w.data))
        last = w.first[1:][n_words > 0] - 1
        until[last] = w.text_ends[n_words > 0]
        if whole:
            # Nothing follows the last word that stays if those after it go.
            stay = np.flatnonzero(~gone)[np.cumsum(left)[left > 0] - 1]
            cut = gone[(w.first[1:] - 1)[left > 0]]
            until[stay[cut]] = w.ends[stay[cut]]
        begins, lengths = w.begins[~gone], (until - w.begins)[~gone]
        joined = w.data[ragged(begins, lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
    else:
        begins, lengths = w.begins[~gone], (w.ends - w.begins)[~gone]
        # Each word with a space after it, but for the last of its text.
        source = np.append(w.data, np.uint8(32))
        last = np.cumsum(left)[left > 0] - 1
        pads = np.ones(len(begins), np.int64)
        pads[last] = 0
        spots = np.empty(2 * len(begins), np.int64)
        sizes = np.empty(2 * len(begins), np.int64)
        spots[0::2], spots[1::2] = begins, len(w.data)
        sizes[0::2], sizes[1::2] = lengths, pads
        joined = source[ragged(spots, sizes)]
        ends = np.concatenate([[0], np.cumsum(lengths + pads)])
    offsets = ends[np.concatenate([[0], np.cumsum(left)])].astype(np.int64)
    kept = pa.Array.from_buffers(
        pa.large_string(), len(left), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    )
    return kept, n_words, n_removed


def _rows(docs: pa.Array, kept: pa.Array, n_words: np.ndarray, n_removed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            docs,
            kept.cast(pa.string()),
            pa.array(n_words.astype(np.int64)),
            pa.array(n_removed.astype(np.int64)),
        ],
        names=["doc", "kept", "n_words", "n_removed"],
    )


def remove_repeated_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = 35,
    keep_space: bool = False,
) -> DataFrame:
    """doc (a struct of all columns but the text), kept (text), n_words and n_removed of each row.

    Words are what stands between ASCII white space, unchanged; kept words are joined by one
    space or, if ``keep_space``, have the white space that follows them in the text, but for the last one
    if words after it go. Whole texts are read. NULL and empty texts have no words. Repeated rows are copies of each other, so all their
    windows are repeated and go. NULL ids are ids like any other, an empty table gives no rows,
    and other columns come back untouched in ``doc`` whatever their names.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*others).alias("doc"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("mark"),
        F.col(text_col).alias("text"),
    )
    segments = sketch_segments(rows)
    if segments <= MOST_BROADCAST:
        sketch = merged_sketch(rows, window, segments)
        marks, marked, extra = Sketch(docs.sparkSession.sparkContext.broadcast(sketch)), rows, []
    else:
        own = repeated_anchors(rows, window, segments)
        marks, extra = Listed(), ["anchors"]
        marked = _with_own(rows, own, "anchors")
    suspects = marked.select("id", "mark", "text", *extra).mapInArrow(
        partial(_suspects, window=window, marks=marks),
        T.StructType(
            [
                *fields("one long, two long, n tinyint"),
                rows.schema["id"],
                *fields("mark long, place int"),
            ]
        ),
    )
    # A window counted once in all stands alone: its one row says where. Id and text hash name its
    # document, for two rows equal in both would have had all their windows twice.
    alone = (
        suspects.groupBy("one", "two")
        .agg(F.sum("n").alias("n"), F.min(F.struct("id", "mark", "place")).alias("at"))
        .where("n = 1")
        .groupBy(F.col("at.id").alias("id"), F.col("at.mark").alias("mark"))
        .agg(F.collect_list("at.place").alias("alone"))
    )
    alone = stored(alone, "lone-windows")
    matched = _with_own(marked, alone, "alone")
    return matched.select("doc", "text", "alone", *extra).mapInArrow(
        partial(_removal, window=window, marks=marks, keep_space=keep_space),
        T.StructType([rows.schema["doc"], *fields("kept string, n_words long, n_removed long")]),
    )


def _with_own(rows: DataFrame, by_document: DataFrame, name: str) -> DataFrame:
    """Rows with what a table has for their id and mark, NULL if nothing."""
    return (
        rows.alias("d")
        .join(
            by_document.alias("a"),
            F.col("d.id").eqNullSafe(F.col("a.id")) & (F.col("d.mark") == F.col("a.mark")),
            "left",
        )
        .select("d.*", f"a.{name}")
    )
