"""Token ids of a corpus in grammar-compressed shards.

A table of shards is a Parquet folder. A row is a shard: the documents in it, how many ids each
has, and one binary value in the format of ``repair_grammar.pack``. Shards lie in ascending
order of document id; ``part`` and ``shard`` number them and ``start`` counts the ids ahead of a
shard in its part, so a part's first id is known once the parts' sizes are. A document longer than a
shard is cut: ``more`` says that the last document of a shard goes on in the next one, and ``ahead`` how
many ids of the first one are in earlier shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.chunk_encoder import Vocabulary, worker_encoder
from martloom.llm.common import byte_view, fields
from martloom.llm.repair_grammar import compress, pack, unpack

#: Ids after which a shard is closed; it has fewer than twice as many.
SHARD_IDS = 1 << 19


def _shards(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end_id: int
) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(vocabulary)
    base = max(encoder.vocabulary_size, end_id + 1)
    part, shard, start = TaskContext.get().partitionId(), 0, 0
    held_keys: list[pa.Array] = []
    held: list[np.ndarray] = []
    size = ahead = 0

    def close(more: bool) -> pa.RecordBatch:
        ids = np.concatenate(held)
        keys = pa.concat_arrays(held_keys)
        offsets = pa.array([0, len(keys)], pa.int32())
        counts = pa.array([len(x) for x in held], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([shard], pa.int64()),
                pa.array([start], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.ListArray.from_arrays(offsets, keys),
                pa.ListArray.from_arrays(offsets, counts),
                pa.array([pack(compress(ids, base))], pa.binary()),
                pa.array([ahead], pa.int64()),
                pa.array([more]),
            ],
            names=["part", "shard", "start", "n_ids", "keys", "counts", "grammar", "ahead", "more"],
        )

    end = np.array([end_id], np.uint32)
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for at in range(0, len(texts), 1024):
            some = encoder.encode_bytes(*byte_view(texts.slice(at, 1024)))
            for k, ids in enumerate(some, at):
                ids = np.concatenate([ids, end])
                for first in range(0, len(ids), SHARD_IDS):
                    piece = ids[first : first + SHARD_IDS]
                    if first:
                        ahead = first
                    held_keys.append(keys.slice(k, 1))
                    held.append(piece)
                    size += len(piece)
                    more = first + len(piece) < len(ids)
                    if more or size >= SHARD_IDS:
                        yield close(more)
                        shard, start, size, ahead = shard + 1, start + size, 0, 0
                        held_keys.clear()
                        held.clear()
    if held:
        yield close(False)


def write_token_shards(
    docs: DataFrame,
    path: str,
    vocabulary: Vocabulary,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, and write shards in ascending order of id.

    NULL text is empty: the end id alone. NULL ids come first, and rows that share an id follow
    each other by their text's hash. No rows make an empty table. Other columns are not kept.
    """
    # Rows that are alike differ in the number they were read with, so that many tasks can share them.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("read")]
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("read"),
    )
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    dealt.mapInArrow(
        partial(_shards, vocabulary=vocabulary, end_id=end_id),
        T.StructType(
            [
                *fields("part int, shard long, start long, n_ids long"),
                T.StructField("keys", T.ArrayType(docs.schema[id_col].dataType)),
                *fields("counts array<long>, grammar binary, ahead long, more boolean"),
            ]
        ),
    ).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[pa.RecordBatch]:
    """The ids of every document as little-endian unsigned 32-bit integers.

    If ``cut``, of those that are in several shards the parts, with the ids ahead of each; else of the
    others.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            first, keys, counts, grammar, ahead, more = (c[row] for c in batch.columns)
            keys, counts = keys.values, counts.values.to_numpy()
            in_parts = np.zeros(len(counts), bool)
            places = np.zeros(len(counts), np.int64)
            places[0] = ahead.as_py()
            in_parts[0] = places[0] > 0
            in_parts[-1] |= more.as_py()
            ids = unpack(grammar.as_py()).grammar.expand().astype("<u4")
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            )
            begins = first.as_py() + ends - counts - places
            wanted = pa.array(in_parts == cut)
            columns = [keys, pa.array(begins, pa.int64()), raw.cast(pa.binary()), pa.array(places)]
            yield pa.RecordBatch.from_arrays(
                [c.filter(wanted) for c in columns], names=["id", "start", "ids", "place"]
            )


def _joined(parts: pa.Table) -> pa.Table:
    """One document from its parts."""
    parts = parts.sort_by("place")
    ids = b"".join(parts["ids"].to_pylist())
    return parts.slice(0, 1).set_column(2, "ids", pa.array([ids], pa.binary()))


def _with_first_ids(spark: SparkSession, path: str) -> DataFrame:
    """The shards, each with the number of ids ahead of it in the whole corpus."""
    shards = spark.read.parquet(path)
    # A row for each task that wrote.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    ends = np.cumsum([p.n for p in parts]).tolist()
    before = spark.createDataFrame(
        [(p.part, end - p.n) for p, end in zip(parts, ends, strict=True)], "part int, before long"
    )
    return shards.join(F.broadcast(before), "part").withColumn("first_id", F.expr("before + start"))


def read_token_shards(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it) and ids (binary) of every document."""
    shards = _with_first_ids(spark, path).select(
        "first_id", "keys", "counts", "grammar", "ahead", "more"
    )
    kind = shards.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("id", kind), *fields("start long, ids binary, place long")])
    found = shards.mapInArrow(partial(_documents, cut=False), schema)
    if not spark.read.parquet(path).where("more").isEmpty():
        parts = shards.where("more OR ahead > 0").mapInArrow(partial(_documents, cut=True), schema)
        found = found.unionAll(parts.groupBy("start").applyInArrow(_joined, schema))
    return found.drop("place").withColumnRenamed("id", id_col)


def _stretch(batches: Iterator[pa.RecordBatch], start: int, stop: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            first = batch.column(0)[row].as_py()
            shard = unpack(batch.column(1)[row].as_py())
            ids = shard.ids(max(0, start - first), max(0, stop - first))
            places = np.arange(len(ids)) + max(start, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(ids.astype(np.int64), pa.int64())],
                names=["place", "token_id"],
            )


def read_stretch(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The ids at places [start, stop) of the whole corpus, opening only the shards that hold them."""
    shards = _with_first_ids(spark, path)
    held = (F.col("first_id") < stop) & (F.col("first_id") + F.col("n_ids") > start)
    return (
        shards.where(held)
        .select("first_id", "grammar")
        .mapInArrow(partial(_stretch, start=start, stop=stop), "place long, token_id long")
    )
