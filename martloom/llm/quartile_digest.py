"""A locality-sensitive digest of a document: quartiles of hashed byte triplets.

Three triplets of every four neighbouring bytes are hashed into 256 buckets. The digest has, for
each bucket, the quartile its count falls in (two bits), and ahead of them the length on a
log scale, how the quartiles relate, and a checksum. Two digests are compared by a difference score that is
bounded and turned into a likeness of 0 to 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import SLICE, byte_view, slices, stored, with_id

BUCKETS = 256
HEADER = 3
#: Fixed odd multipliers, one row for each triplet of a window of four bytes.
TRIPLETS = ((0, 1, 2, 40503), (0, 1, 3, 30011), (0, 2, 3, 25717))
#: The difference from which two digests count as unlike.
FARTHEST = 640


def bucket_counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many triplets of each text fall into each bucket; all bytes of all texts count."""
    n = len(starts) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    for first, last in slices(starts):
        for at in range(int(starts[first]), int(starts[last]), SLICE):
            end = min(int(starts[last]), at + SLICE)
            x = data[at : min(int(starts[last]), end + 3)].astype(np.uint32)
            if len(x) < 4:
                continue
            windows = min(end - at, len(x) - 3)
            text = np.repeat(
                np.arange(last - first),
                np.diff(np.clip(starts[first : last + 1] - at, 0, windows)),
            )
            # The last three places of a text begin no window of its own.
            inside = np.arange(at, at + windows) < starts[first + 1 + text] - 3
            base = (text * BUCKETS)[inside]
            for a, b, c, odd in TRIPLETS:
                key = x[a : a + windows] << 16 | x[b : b + windows] << 8 | x[c : c + windows]
                key = (key * np.uint32(odd * 65537 + 2)) >> np.uint32(24)
                found = np.bincount(base + key[inside], minlength=(last - first) * BUCKETS)
                counts[first * BUCKETS : last * BUCKETS] += found
    return counts.reshape(n, BUCKETS)


def digests(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of bytes for each text: checksum, length, quartile ratios, and two bits a bucket."""
    counts = bucket_counts(data, starts)
    n = len(counts)
    out = np.zeros((n, HEADER + BUCKETS // 4), np.uint8)
    if not n:
        return out
    lengths = np.diff(starts)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    quartile = sum((counts > q[:, None]).astype(np.uint8) for q in (q1, q2, q3))
    for k in range(4):
        out[:, HEADER:] |= quartile[:, k::4] << np.uint8(2 * k)
    mix = (counts * np.arange(1, BUCKETS + 1)).sum(1) + 31 * lengths
    out[:, 0] = mix % 251
    out[:, 1] = np.minimum(255, np.floor(12 * np.log2(1 + lengths)))
    top = np.maximum(q3, 1)
    out[:, 2] = (q1 * 15 // top) << 4 | (q2 * 15 // top)
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: 0 for equal digests, at most ``FARTHEST``.

    Neighbouring quartiles differ by 1, opposite ones by 6; length and ratios
    cost only beyond a small tolerance; a different checksum costs 1.
    """
    total = np.zeros(len(a), np.int64)
    for k in range(4):
        x, y = ((d[:, HEADER:] >> np.uint8(2 * k) & 3).astype(np.int64) for d in (a, b))
        apart = np.abs(x - y)
        total += np.where(apart == 3, 6, apart).sum(1)
    total += (a[:, 0] != b[:, 0]).astype(np.int64)
    total += 2 * np.maximum(0, np.abs(a[:, 1].astype(int) - b[:, 1]) - 1)
    for shift in (0, 4):
        x, y = ((d[:, 2] >> np.uint8(shift) & 15).astype(np.int64) for d in (a, b))
        total += 4 * np.maximum(0, np.abs(x - y) - 1)
    return np.minimum(total, FARTHEST)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - difference(a, b) / FARTHEST


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def _views(texts: list[str]) -> np.ndarray:
    return digests(*byte_view(pa.array(texts, pa.large_string())))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: pa.Array, texts: list[str], next_texts: list[str]) -> dict[str, pa.Array]:
    edits = [_edited(a, b) for a, b in zip(texts, next_texts, strict=True)]
    own, edited = _views(texts), _views(edits)
    following = np.concatenate([own[1:], _views(next_texts[-1:])]) if len(own) else own
    return {
        "id": ids,
        "n_chars": pa.array([len(x) for x in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits], pa.string()),
        "fingerprint": pa.array(_hex(own), pa.string()),
        "edited_fingerprint": pa.array(_hex(edited), pa.string()),
        "near_edited": pa.array(likeness(own, edited), pa.float64()),
        "near_next": pa.array(likeness(own, following), pa.float64()),
    }


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but a partition's last; that one's text, and the first one's, as they are."""
    part = TaskContext.get().partitionId()
    held: tuple[pa.Array, str] | None = None

    def rows(fields: dict[str, pa.Array], edge: str | None, text: str | None) -> pa.RecordBatch:
        n = len(fields["id"])
        extra = {"part": [part] * n, "edge": [edge] * n, "text": [text] * n}
        kinds = {"part": pa.int32(), "edge": pa.string(), "text": pa.string()}
        fields = fields | {k: pa.array(v, kinds[k]) for k, v in extra.items()}
        return pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))

    def bare(ids: pa.Array) -> dict[str, pa.Array]:
        empty = _compared(ids.slice(0, 0), [], [])
        return {"id": ids} | {k: pa.nulls(1, v.type) for k, v in empty.items() if k != "id"}

    for batch in batches:
        ids, texts = batch.column(0), pc.fill_null(batch.column(1), "").to_pylist()
        if not texts:
            continue
        if held is None:
            yield rows(bare(ids.slice(0, 1)), "first", texts[0])
        else:
            ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
        if len(texts) > 1:
            yield rows(_compared(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:]), None, None)
        held = ids.slice(len(texts) - 1), texts[-1]
    if held:
        yield rows(bare(held[0]), "last", held[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            fields = _compared(
                batch.column(0).slice(k, 1),
                batch.column(1).slice(k, 1).to_pylist(),
                batch.column(2).slice(k, 1).to_pylist(),
            )
            yield pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))


def digest_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of every text and of its edit with the next document, and their likeness.

    The next document is the one with the next smaller id (after the smallest: the largest); rows
    that share an id follow each other by their text's hash, NULL ids come last. The edit
    replaces the last floor(n/2) code points by the first as many of the next text. NULL text is
    empty; the digest of an empty text is all zeros but for its header. A single row is its own
    next document; no rows give no rows. Columns besides id and text are not looked at.

    One range shuffle orders the texts. Each task passes its first and last text on; these, at
    most two a task, are joined to finish the rows where tasks meet.
    """
    spark = docs.sparkSession
    # Rows that are alike differ in the number they were read with, so that many tasks can share them.
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("read")]
    walked = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(text_col).alias("text"),
            F.monotonically_increasing_id().alias("read"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
        .mapInArrow(_walk, with_id(docs, id_col, f"{RESULT}, part int, edge string, text string")),
        "digests",
    )
    done = walked.where("edge IS NULL").drop("part", "edge", "text")
    # One number for each task that had rows.
    parts = sorted(r.part for r in walked.where("edge = 'first'").select("part").collect())
    after = spark.createDataFrame(
        [(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, next_part int"
    )
    firsts = walked.where("edge = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text")
    )
    met = (
        walked.where("edge = 'last'")
        .select("id", "text", "part")
        .join(after, "part")
        .join(firsts, "next_part")
        .select("id", "text", "next_text")
        .mapInArrow(_pairs, with_id(docs, id_col, RESULT))
    )
    return done.unionByName(met).withColumnRenamed("id", id_col)
