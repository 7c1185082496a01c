"""What the operators of this package share: folds, byte views of text, shared tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.sinks import scratch_dir

#: Bytes of text that one numpy step works on; bounds a task's memory whatever a text's length.
SLICE = 1 << 19

#: Rows go to a Python worker in batches of some 4 MB. Spark's own limit is 64 MB, several times over
#: for each task: as it is written and read in the JVM, and as it is read and cut in the worker.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound_batches(spark: SparkSession) -> bool:
    """Whether batches to Python get ``BATCH_BYTES`` here: not if the deployer or caller set a size."""
    key, size = BATCH_BYTES
    if spark.conf.get(key, None) is not None:
        return False
    spark.conf.set(key, size)
    return True


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; NULL for a NULL id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % folds


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def with_id(df: DataFrame, id_col: str, ddl: str) -> T.StructType:
    """``id`` of the type of ``id_col``, which may be a struct of any names, and the fields of ``ddl``."""
    return T.StructType([T.StructField("id", df.schema[id_col].dataType), *fields(ddl)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    The table ends the lineage, so a lost executor costs a re-read and not a recomputation.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rarely(id_col: str, wanted: int, n: Column | int) -> Column:
    """Whether a hash of the id is among the smallest: true for some 2 * wanted of n rows.

    Ahead of a sort for the smallest hashes it bounds what the sort gets, however many tasks
    there are; the hash is the same one, so no row is lost that the sort would take.
    """
    share = (2.0 * wanted + 100) / (n if isinstance(n, Column) else F.lit(max(n, 1)))
    return hash_place(id_col) < share


def hash_place(id_col: str) -> Column:
    """A hash of the id as a number from 0 to 1."""
    return F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) / float(1 << 40)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, and where each text begins (one entry more).

    NULL counts as the empty text.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, np.int64, n + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[k] .. starts[k] + lengths[k] - 1`` of every k, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def slices(starts: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of whole texts, [first, last), of at most ``most`` bytes, or of one longer text."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of marked bytes begins and ends; a run ends where its text does."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    begins = np.flatnonzero(inside & (~before | edge[:-1]))
    return begins, np.flatnonzero(inside & (~after | edge[1:])) + 1


def word_slices(
    data: np.ndarray, starts: np.ndarray, inside: np.ndarray, carry: int, most: int = 1 << 20
) -> Iterator[tuple[int, np.ndarray, int]]:
    """Stretches of texts to work on, as (number of the first text, starts, words seen before).

    A stretch is some whole texts, or a part of one that is longer than ``most`` bytes. A part ends with
    a word, and the next one begins with the last ``carry`` words of it, which were seen then. ``inside``
    says of each byte value whether it belongs to a word. Only one word longer than
    ``most`` makes a longer stretch.
    """
    for first, last in slices(starts, most):
        at, end = int(starts[first]), int(starts[last])
        if end - at <= most:
            yield first, starts[first : last + 1], 0
            continue
        seen, size = 0, most
        while at + size < end:
            begins, ends = runs(inside[data[at : at + size]], np.zeros(1, np.int64))
            whole = int(np.searchsorted(ends, size))  # words that end before the part does
            if whole <= carry:
                size *= 2
                continue
            yield first, np.array([at, at + ends[whole - 1]]), seen
            at += int(begins[whole - carry]) if carry else int(ends[whole - 1])
            seen, size = carry, most
        yield first, np.array([at, end]), seen


class SpanHasher:
    """64-bit hashes of spans of an array, all spans at once.

    The sum of ``(value + 1) * B**place`` up to every place gives any span's polynomial by one
    subtraction; multiplying by ``B**-begin`` makes it independent of the span's place.
    """

    def __init__(self, base: int = 0x9E3779B97F4A7C15) -> None:
        self.base = base  # odd
        self._powers = self._inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self._powers):
            for name, base in (("_powers", self.base), ("_inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(
            (values.astype(np.uint64) + np.uint64(1)) * self._powers[: len(values)], out=out[1:]
        )
        return out

    def spans(self, sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((sums[ends] - sums[begins]) * self._inverse[begins])

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all spans of one length."""
        n = max(0, len(sums) - length)
        return _mixed((sums[length:] - sums[:n]) * self._inverse[:n])


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))
