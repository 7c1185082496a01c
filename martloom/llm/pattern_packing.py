"""Packing documents into fixed-length sequences by patterns fitted to the length histogram.

The histogram of piece lengths is all that the plan is made from; it has at most ``capacity``
entries however many documents there are. Patterns of a few lengths that fill a sequence are
enumerated over coarse length classes, and non-negative least squares says how often to use each
so that together they use up the histogram. Rounded down, these patterns are laid out with true
lengths, the last of each sequence as long as fits; what is left is packed by best fit, longest
first, into the gaps and new sequences.

The plan says, for each length, which sequence and offset its first, second, ... piece gets, as
runs. A piece's number among those of its length comes from a count for each task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
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
from martloom.llm.common import byte_view, fields, stored, with_id

#: Length classes that a sequence is divided into, and documents in a pattern.
CLASSES = 256
PATTERN_DOCUMENTS = 3
_RANK_BITS = 40


def patterns(classes: int = CLASSES, most: int = PATTERN_DOCUMENTS) -> np.ndarray:
    """All ways to fill a sequence with at most ``most`` classes, as counts: classes x patterns."""
    found: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int, largest: int) -> None:
        if not left:
            found.append(chosen)
        elif len(chosen) < most:
            slots = most - len(chosen)
            for size in range(min(left, largest), (left + slots - 1) // slots - 1, -1):
                extend((*chosen, size), left - size, size)

    extend((), classes, classes)
    out = np.zeros((classes + 1, len(found)))
    for k, chosen in enumerate(found):
        for size in chosen:
            out[size, k] += 1
    return out[1:]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative x with least ``|a x - b|``, by the active-set method."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        enter = int(slope.argmax())
        if slope[enter] <= tolerance:
            break
        active[enter] = True
        while True:
            at = np.flatnonzero(active)
            best = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (best > 0).all():
                x[:] = 0
                x[at] = best
                break
            down = best <= 0
            step = (x[at][down] / np.maximum(x[at][down] - best[down], 1e-300)).min()
            x[at] += step * (best - x[at])
            gone = at[(x[at] <= tolerance) & down]
            active[gone] = False
            x[gone] = 0
            if not len(gone):
                break
    return x


@dataclass
class Plan:
    """For runs of pieces of one length: the first one's number, sequence, and the offset of all."""

    capacity: int
    runs: dict[int, list[tuple[int, int, int]]] = field(default_factory=lambda: defaultdict(list))
    placed: dict[int, int] = field(default_factory=lambda: defaultdict(int))
    sequences: int = 0

    def place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs[length].append((self.placed[length], sequence, offset))
        self.placed[length] += n

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (length and number), sequences and offsets."""
        rows = [
            (length << _RANK_BITS | first, sequence, offset)
            for length in sorted(self.runs)
            for first, sequence, offset in self.runs[length]
        ]
        out = np.array(rows, np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def make_plan(histogram: dict[int, int], capacity: int, classes: int = CLASSES) -> Plan:
    """A place for every piece of the histogram (length: how many)."""
    plan = Plan(capacity)
    left = {length: n for length, n in histogram.items() if n > 0}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, how many)
    sizes: list[int] = []  # the gaps there are, in order

    def add_gap(gap: int, first: int, n: int) -> None:
        if gap > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    if n := left.pop(capacity, 0):
        plan.place(capacity, n, plan.open(n), 0)
    _lay_patterns(plan, left, min(classes, capacity), add_gap)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = min(n, capacity // length)
                many = n // each
                first = plan.open(many)
                for k in range(each):
                    plan.place(length, many, first, k * length)
                add_gap(capacity - each * length, first, many)
                n -= many * each
                continue
            gap = sizes[at]
            first, many = gaps[gap].pop()
            used = min(n, many)
            if used < many:
                gaps[gap].append((first + used, many - used))
            elif not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            plan.place(length, used, first, capacity - gap)
            add_gap(gap - length, first, used)
            n -= used
    return plan


def _lay_patterns(plan: Plan, left: dict[int, int], classes: int, add_gap) -> None:
    """Use up lengths by fitted patterns; a class is a length rounded up, so patterns always fit."""
    width = -(-plan.capacity // classes)
    classes = plan.capacity // width  # whole classes only, so that a pattern cannot be too long
    pools: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left):
        pools[-(-length // width)].append(length)
    counts = np.array([sum(left[x] for x in pools[k]) for k in range(1, classes + 1)], float)
    ways = patterns(classes)
    repeats = np.floor(nnls(ways, counts) + 1e-9).astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        slots = [int(c) + 1 for c in np.flatnonzero(ways[:, k]) for _ in range(int(ways[c, k]))]
        fits = (sum(left[x] for x in pools[c]) // slots.count(c) for c in set(slots))
        n = min(int(repeats[k]), *fits)
        *slots, last = slots
        if n <= 0:
            continue
        taken = [_take(pools[c], left, n) for c in slots]
        first = plan.open(n)
        done = 0
        while done < n:
            many = min((run[-1][1] for run in taken), default=n)
            offset = 0
            for run in taken:
                length, had = run.pop()
                plan.place(length, many, first + done, offset)
                offset += length
                if had > many:
                    run.append((length, had - many))
            _fill(plan, pools, left, width, last, offset, first + done, many, add_gap)
            done += many


def _fill(plan, pools, left, width, last, offset, first, n, add_gap) -> None:
    """End n equal sequences with the longest pieces that fit, of about the pattern's last class."""
    room = plan.capacity - offset
    for c in range(min(room // width + 1, plan.capacity // width), last - 2, -1):
        pool = pools[c]
        at = bisect_left(pool, room + 1) - 1
        while n and at >= 0:
            length = pool[at]
            used = min(n, left[length])
            plan.place(length, used, first, offset)
            add_gap(room - length, first, used)
            first, n = first + used, n - used
            left[length] -= used
            if not left[length]:
                del left[length]
                pool.pop(at)
            at -= 1
    if n:
        add_gap(room, first, n)


def _take(pool: list[int], left: dict[int, int], n: int) -> list[tuple[int, int]]:
    """n pieces of a class, longest first, as (length, how many); the last is to be used first."""
    out = []
    while n:
        length = pool[-1]
        used = min(n, left[length])
        out.append((length, used))
        left[length] -= used
        n -= used
        if not left[length]:
            del left[length]
            pool.pop()
    return out[::-1]


def _pieces(
    batches: Iterator[pa.RecordBatch],
    vocabulary: Vocabulary,
    end_id: int,
    capacity: int,
    keep_ids: bool,
) -> Iterator[pa.RecordBatch]:
    """Pieces of every document, each with its number among this task's pieces of its length."""
    encoder = worker_encoder(vocabulary)
    part = TaskContext.get().partitionId()
    seen: dict[int, int] = defaultdict(int)
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for at in range(0, len(texts), 1024):
            rows: list[tuple] = []
            raw: list[bytes] = []
            some = encoder.encode_bytes(*byte_view(texts.slice(at, 1024)))
            for k, ids in enumerate(some, at):
                data = ids.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
                for piece, start in enumerate(range(0, len(ids) + 1, capacity)):
                    some = data[4 * start : 4 * (start + capacity)]
                    n = len(some) // 4
                    rows.append((k, piece, start, n, zlib.crc32(some), seen[n]))
                    seen[n] += 1
                    raw.append(some)
            columns = [list(x) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(columns[0])),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(x, pa.int64()) for x in columns[2:]),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(raw if keep_ids else [None] * len(raw), pa.binary()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "number", "part", "ids"],
            )


def _assign(
    batches: Iterator[pa.RecordBatch], table: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    keys, sequences, offsets = table
    for batch in batches:
        *kept, numbers = batch.columns
        lengths, numbers = batch.column("length").to_numpy(), numbers.to_numpy()
        wanted = lengths.astype(np.int64) << _RANK_BITS | numbers
        run = np.searchsorted(keys, wanted, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                *kept,
                pa.array(sequences[run] + wanted - keys[run], pa.int64()),
                pa.array(offsets[run], pa.int64()),
            ],
            names=[*batch.schema.names[:-1], "sequence_id", "offset"],
        )


PIECE = (
    "piece int, start long, length long, ids_crc32 long, number long, part int, ids binary"
)


def pack_documents(
    docs: DataFrame,
    vocabulary: Vocabulary,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = 4096,
    keep_ids: bool = False,
) -> DataFrame:
    """A row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset, and its ids
    (little-endian unsigned 32-bit integers) if ``keep_ids``.

    Whole texts are encoded and end with ``end_id``; documents longer than ``capacity`` are cut into
    full pieces and a last one. NULL text is empty: the end id alone. Repeated rows are packed
    each, NULL ids stay, no rows give no rows, and columns besides id and text are not kept.
    """
    pieces = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            partial(
                _pieces,
                vocabulary=vocabulary,
                end_id=end_id,
                capacity=capacity,
                keep_ids=keep_ids,
            ),
            with_id(docs, id_col, PIECE),
        ),
        "pieces",
    )
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # At most ``capacity`` lengths.
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = make_plan({r.length: r.n for r in lengths}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = pieces.join(ahead, ["part", "length"]).select(
        "id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        *(["ids"] if keep_ids else []),
        (F.col("ahead") + F.col("number")).alias("number"),
    )
    placed = fields("sequence_id long, offset long")
    return numbered.mapInArrow(
        partial(_assign, table=plan.table()), T.StructType([*numbered.schema.fields[:-1], *placed])
    ).withColumnRenamed("id", id_col)
