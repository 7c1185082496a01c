"""Drawing documents that look like a target collection, by importance weights of hashed n-grams.

Features are runs of words; a feature's bucket is a checksum of its bytes. A bucket's gain is the
logarithm of how much more frequent it is in the target than in the documents; a document's weight is
its mean gain. Gumbel noise, made from the id, turns weights into scores whose highest are a draw
without replacement.

Inside a task, the n-grams of a batch are interned in an open-addressed table (``spans.SpanTable``):
its slots store each distinct n-gram's bucket and count, so that checksums are made and counts added
once for each of them, and an occurrence is a slot's number, by which gains are gathered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import byte_view, lower_ascii, runs, stored, with_id, word_slices
from martloom.llm.spans import SpanTable

#: Bytes of words once A-Z are lowered: digits, letters and all of other characters.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: Bits of a row's number within its task in ``monotonically_increasing_id``.
_PLACE_BITS = 33


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``longest`` words, and how many buckets they are dealt into."""

    longest: int = 2
    buckets: int = 10_000


class Slots:
    """The n-grams of a stretch of texts: a slot for each distinct one, and each occurrence's slot."""

    def __init__(
        self, data: np.ndarray, starts: np.ndarray, seen: int, features: Features
    ) -> None:
        """``seen`` words at the beginning belong to an earlier stretch: runs of them alone are left out."""
        a = int(starts[0])
        data = lower_ascii(data[a : int(starts[-1])])
        starts = starts - a
        inside = WORD[data]
        begins, ends = runs(inside, starts)
        text = np.searchsorted(starts, begins, "right") - 1
        # Words and the one byte after each, a space, so that a run of words is a run of bytes.
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        words = np.where(inside, data, 32).astype(np.uint8)[kept]
        place = np.concatenate([[0], np.cumsum(kept)])
        first, sizes = place[begins], ends - begins
        spans, owners = [], []
        for n in range(1, features.longest + 1):
            head = np.arange(max(0, len(begins) - n + 1))
            head = head[(text[head] == text[head + n - 1]) & (head + n > seen)]
            last = head + n - 1
            spans.append((first[head], first[last] + sizes[last] - first[head]))
            owners.append(text[head])
        at, lengths = (np.concatenate(x) for x in zip(*spans, strict=True))
        #: The text of every occurrence, and how many words each text has here.
        self.text = np.concatenate(owners)
        self.n_words = np.bincount(text[seen:], minlength=len(starts) - 1)
        table = SpanTable(words, at, lengths)
        self.slot = table.found
        self.bucket = np.array([zlib.crc32(x) for x in table.values()], np.int64) % features.buckets
        self.count = np.bincount(self.slot, minlength=len(table))

    def by_bucket(self, buckets: int) -> np.ndarray:
        # Counts of one stretch: whole numbers that a double holds exactly.
        return np.bincount(self.bucket, self.count, buckets).astype(np.int64)

    def gains(self, gain: np.ndarray) -> np.ndarray:
        """The sum of gains over each text's occurrences."""
        found = gain[self.bucket][self.slot]
        return np.bincount(self.text, found, len(self.n_words)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch], features: Features) -> Iterator[pa.RecordBatch]:
    """How many occurrences this task has in each bucket."""
    total = np.zeros(features.buckets, np.int64)
    for batch in batches:
        data, starts = byte_view(batch.column(0))
        for _, some, seen in word_slices(data, starts, _ANY_WORD, features.longest - 1):
            total += Slots(data, some, seen, features).by_bucket(features.buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"]
    )


#: Bytes of words before A-Z are lowered.
_ANY_WORD = WORD.copy()
_ANY_WORD[65:91] = True


def bucket_counts(texts: DataFrame, features: Features, text_col: str = "text") -> np.ndarray:
    """Occurrences in each bucket; tasks add up their own first, ``features.buckets`` rows at most."""
    counted = (
        texts.select(F.col(text_col).alias("text"))
        .mapInArrow(partial(_counts, features=features), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    out = np.zeros(features.buckets, np.int64)
    for r in counted.collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed frequency in the target over that in the documents)."""
    n = len(documents)
    all_documents, all_target = int(documents.sum()), int(target.sum())
    return np.array(
        [
            math.floor(
                1000
                * math.log(
                    float(t + 1) * float(all_documents + n) / (float(s + 1) * float(all_target + n))
                )
            )
            for s, t in zip(documents.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _weights(
    batches: Iterator[pa.RecordBatch], features: Features, gain: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = byte_view(batch.column(1))
        n_words, n_features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for first, some, seen in word_slices(data, starts, _ANY_WORD, features.longest - 1):
            slots = Slots(data, some, seen, features)
            here = slice(first, first + len(some) - 1)
            n_words[here] += slots.n_words
            n_features[here] += np.bincount(slots.text, minlength=len(some) - 1)
            total[here] += slots.gains(gain)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words),
                pa.array(n_features),
                pa.array(total // np.maximum(n_features, 1)),
            ],
            names=["id", "n_words", "n_features", "weight"],
        )


def importance_weights(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    features: Features = Features(),
) -> DataFrame:
    """id, n_words, n_features and weight of every row; the counts behind the gains cover all rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    gain = bucket_gains(bucket_counts(rows, features), bucket_counts(target, features, text_col))
    return rows.mapInArrow(
        partial(_weights, features=features, gain=gain),
        with_id(docs, id_col, "n_words long, n_features long, weight long"),
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    features: Features = Features(),
) -> DataFrame:
    """id, n_features, weight, score and rank of every row; rank is NULL for rows not drawn.

    Of the rows with ``least_words`` words, the ``percent`` with the highest scores are drawn; ties go
    to the smaller id, then to the fewer features, and rows equal in both are alike. Whole texts
    are read, A-Z lowered; NULL and empty texts have no words, weight 0 and are not drawn
    unless ``least_words`` is 0. A NULL id counts as an empty one for the noise and comes last among ties.
    Repeated rows are rows of their own. No rows give no rows; an empty target has no
    occurrences. Columns besides id and text are not kept.
    """
    noise = F.conv(
        F.substring(
            F.sha2(
                F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256
            ),
            1,
            8,
        ),
        16,
        10,
    ).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    weighted = importance_weights(docs, target, id_col, text_col, features=features)
    scored = stored(weighted.withColumn("score", F.col("weight") + gumbel), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    # Scores lie between the extreme gains plus the noise's range: some 100,000 values at most.
    tally = eligible.groupBy("score").agg(F.count("*").alias("n")).collect()
    drawn = percent * sum(r.n for r in tally) // 100
    lowest, above = math.inf, 0
    for r in sorted(tally, key=lambda r: -r.score):
        if above >= drawn:
            break
        lowest, above = r.score, above + r.n
    if not drawn:
        return _result(scored, id_col, F.lit(None))
    hopeful = (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    ranked = _ranked(scored.where(hopeful), drawn)
    return _result(scored.where(~hopeful), id_col, F.lit(None)).unionAll(
        _result(ranked, id_col, F.col("rank"))
    )


def _result(rows: DataFrame, id_col: str, rank) -> DataFrame:
    return rows.select(
        F.col("id").alias(id_col), "n_features", "weight", "score", rank.cast("long").alias("rank")
    )


def _ranked(rows: DataFrame, most: int) -> DataFrame:
    """Rows with their rank, up to ``most``: numbered within tasks of a range shuffle.

    Rows that are alike differ in the number they were read with, so that they can be dealt to
    several tasks too.
    """
    order = [
        F.col("score").desc(),
        F.col("id").asc_nulls_last(),
        F.col("n_features").asc(),
        F.col("read").asc(),
    ]
    dealt = (
        rows.withColumn("read", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
    )
    dealt = stored(dealt, "ranked")
    # A row for each task.
    part = F.shiftright("place", _PLACE_BITS)
    parts = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    ahead, rows_before = [], 0
    for p in parts:
        ahead.append((p.part, rows_before))
        rows_before += p.n
    table = dealt.sparkSession.createDataFrame(ahead, "part long, ahead long")
    number = F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    rank = F.col("ahead") + number + 1
    return (
        dealt.withColumn("part", part)
        .join(F.broadcast(table), "part")
        .withColumn("rank", F.when(rank <= most, rank))
    )
