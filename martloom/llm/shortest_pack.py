"""Packing documents shortest pack first, over the histogram of piece lengths.

Documents are cut into full pieces and a last one. The plan is made from the histogram of lengths alone,
which has at most ``capacity`` entries. Packs with equal room are one entry with a count: a packing
pattern. Lengths go from long to short, each into the packs with the most room, whose patterns'
counts change by as many pieces as go there at once. There are as many packs as all ids fill, so
where even the emptiest pack is too full, a piece is cut: it fills that pack, and its rest is a length
that is placed when its turn comes. What does not fill a whole pack goes to packs of the powers of two
that it is the sum of. So no pack needs padding, if a pack that is filled to a power of two needs none.

The plan says for runs of pieces of one length, by number, where they go, in one or several parts. A
piece's number among those of its length comes from a count for each task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.chunk_encoder import Vocabulary, worker_encoder
from martloom.llm.common import byte_view, fields, ragged, stored, with_id

_NUMBER_BITS = 40


@dataclass(frozen=True)
class Run:
    """So many pieces of one length, from number ``first`` on: ``size`` ids of each, from place
    ``start`` in it on, go to consecutive sequences at one offset."""

    length: int
    first: int
    count: int
    start: int
    size: int
    sequence: int
    offset: int


@dataclass
class Plan:
    capacity: int
    runs: list[Run] = field(default_factory=list)
    sequences: int = 0

    def table(self) -> PlanTable:
        """For each stretch of numbers that goes the same ways: its key, and its runs."""
        by_length: dict[int, list[Run]] = defaultdict(list)
        for run in self.runs:
            by_length[run.length].append(run)
        keys, ends, order = [], [0], []
        for length in sorted(by_length):
            runs = sorted(by_length[length], key=lambda r: r.first)
            edges = sorted({r.first for r in runs} | {r.first + r.count for r in runs})
            held: list[Run] = []
            coming = iter([*runs, None])
            following = next(coming)
            for edge in edges[:-1]:
                held = [r for r in held if r.first + r.count > edge]
                while following is not None and following.first == edge:
                    held.append(following)
                    following = next(coming)
                keys.append(length << _NUMBER_BITS | edge)
                order += sorted(held, key=lambda r: r.start)
                ends.append(len(order))
        rows = [(r.first, r.start, r.size, r.sequence, r.offset) for r in order]
        return PlanTable(
            np.array(keys, np.int64), np.array(ends, np.int64), np.array(rows, np.int64).reshape(-1, 5)
        )


@dataclass(frozen=True)
class PlanTable:
    keys: np.ndarray
    ends: np.ndarray  # of each key's rows
    rows: np.ndarray  # first, start, size, sequence, offset

    def places(
        self, lengths: np.ndarray, numbers: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which piece each part is of, its place in it, its size, its sequence and offset."""
        wanted = lengths.astype(np.int64) << _NUMBER_BITS | numbers
        at = np.searchsorted(self.keys, wanted, "right") - 1
        many = self.ends[at + 1] - self.ends[at]
        piece = np.repeat(np.arange(len(at)), many)
        first, start, size, sequence, offset = self.rows[ragged(self.ends[at], many)].T
        return piece, start, size, sequence + numbers[piece] - first, offset


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """A place for every id of the pieces of the histogram (length: how many)."""
    plan = Plan(capacity)
    #: By length of what is to be placed: length of the whole piece, place in it, first number, count.
    waiting: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for length, n in histogram.items():
        if n > 0:
            waiting[length].append((length, 0, 0, n))
    packs, rest = divmod(sum(length * n for length, n in histogram.items()), capacity)
    #: By room: first sequence, count and capacity of packs that have the same room.
    patterns: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    if packs:
        patterns[capacity].append((0, packs, capacity))
    plan.sequences = packs
    for bit in range(rest.bit_length()):
        if rest >> bit & 1:
            patterns[1 << bit].append((plan.sequences, 1, 1 << bit))
            plan.sequences += 1
    room = capacity
    for size in range(capacity, 0, -1):
        while waiting[size]:
            length, start, first, left = waiting[size].pop()
            while left:
                while not patterns[room]:
                    room -= 1
                sequence, count, whole = patterns[room].pop()
                placed, some = min(size, room), min(left, count)
                plan.runs.append(Run(length, first, some, start, placed, sequence, whole - room))
                if some < count:
                    patterns[room].append((sequence + some, count - some, whole))
                if room > placed:
                    patterns[room - placed].append((sequence, some, whole))
                if size > placed:
                    waiting[size - placed].append((length, start + placed, first, some))
                first, left = first + some, left - some
    return plan


def _pieces(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end_id: int, capacity: int
) -> Iterator[pa.RecordBatch]:
    """Pieces of every document, each with its number among this task's pieces of its length."""
    encoder = worker_encoder(vocabulary)
    kind = _stored_type(encoder.vocabulary_size, end_id)
    part = TaskContext.get().partitionId()
    seen: dict[int, int] = defaultdict(int)
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for at in range(0, len(texts), 1024):
            rows: list[tuple] = []
            for k, ids in enumerate(encoder.encode_bytes(*byte_view(texts.slice(at, 1024))), at):
                ids = np.append(ids, end_id).astype(kind)
                for start in range(0, len(ids), capacity):
                    some = ids[start : start + capacity]
                    n = len(some)
                    rows.append((k, len(ids), start, n, seen[n], part, some.tobytes()))
                    seen[n] += 1
            index, *columns, parts, raw = (list(x) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(index)),
                    *(pa.array(x, pa.int64()) for x in columns),
                    pa.array(parts, pa.int32()),
                    pa.array(raw, pa.binary()),
                ],
                names=["id", "doc_tokens", "at", "piece", "number", "part", "ids"],
            )


def _stored_type(vocabulary_size: int, end_id: int) -> str:
    """Ids are kept in two bytes where all fit."""
    return "<u2" if max(vocabulary_size, end_id + 1) <= 1 << 16 else "<u4"


def _placed(batches: Iterator[pa.RecordBatch], table: PlanTable) -> Iterator[pa.RecordBatch]:
    """A row for each part that a piece was cut into."""
    for batch in batches:
        lengths, numbers, at = (batch.column(c).to_numpy() for c in ("piece", "number", "at"))
        piece, start, size, sequence, offset = table.places(lengths, numbers)
        raw = batch.column("ids").to_pylist()
        wide = [len(x) // max(1, n) for x, n in zip(raw, lengths.tolist(), strict=True)]
        ids = [
            np.frombuffer(raw[k], f"<u{wide[k]}", n, a * wide[k]).astype("<u4").tobytes()
            for k, a, n in zip(piece.tolist(), start.tolist(), size.tolist(), strict=True)
        ]
        index = pa.array(piece)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(index),
                pa.array(at[piece] + start),
                pa.array(size),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                batch.column("doc_tokens").take(index),
                pa.array(sequence),
                pa.array(offset),
                pa.array(ids, pa.binary()),
            ],
            names=["id", *_PLACED],
        )


_PIECE = "doc_tokens long, at long, piece long, number long, part int, ids binary"
_PLACED = {
    "start": "long",
    "length": "long",
    "ids_crc32": "long",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
    "ids": "binary",
}


def pack_shortest_first(
    docs: DataFrame,
    vocabulary: Vocabulary,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = 1024,
) -> DataFrame:
    """A row for each piece: id, start (its document's ids before it), length, ids_crc32, doc_tokens,
    sequence_id, offset in the sequence, and ids (little-endian unsigned 32-bit integers).

    Whole texts are encoded and end with ``end_id``. A sequence has ``capacity`` ids, but for at most
    one of each smaller power of two. NULL text is empty: the end id alone. Repeated rows are packed each,
    NULL ids stay, no rows give no rows, and columns besides id and text are not kept.
    """
    pieces = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            partial(_pieces, vocabulary=vocabulary, end_id=end_id, capacity=capacity),
            with_id(docs, id_col, _PIECE),
        ),
        "pieces",
    )
    counts = pieces.groupBy("part", "piece").agg(F.count("*").alias("n"))
    # At most ``capacity`` lengths.
    lengths = counts.groupBy("piece").agg(F.sum("n").alias("n")).collect()
    plan = make_plan({r.piece: r.n for r in lengths}, capacity)
    before = Window.partitionBy("piece").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = pieces.join(ahead, ["part", "piece"]).select(
        "id",
        "doc_tokens",
        "at",
        "piece",
        (F.col("ahead") + F.col("number")).alias("number"),
        "ids",
    )
    return numbered.mapInArrow(
        partial(_placed, table=plan.table()),
        T.StructType(
            [numbered.schema["id"], *fields(", ".join(f"{c} {t}" for c, t in _PLACED.items()))]
        ),
    ).withColumnRenamed("id", id_col)
