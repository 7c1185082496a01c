"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and texts of unknown kind are all that is learned from. A linear classifier
over hashed words and word beginnings minimises the class-prior-corrected risk

    prior * R(positive as toxic) + max(0, R(unlabelled as clean) - prior * R(positive as clean))

whose second term, the risk on the clean texts, is kept from going below zero.

Features that say a text is clean are left to the bias: weights are kept from going below zero
too. With the few features that pass the screen a text is toxic for what is in it, never clean
for what is in it besides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import (
    SLICE,
    SpanHasher,
    byte_view,
    hash_place,
    lower_ascii,
    rarely,
    runs,
    stored,
    with_id,
    word_slices,
)

BUCKET_BITS = 22
#: A word's first so many bytes are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
#: Bytes of words: ASCII letters and all of other characters.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass(frozen=True)
class ToxicityModel:
    buckets: np.ndarray  # sorted
    weights: np.ndarray  # of the buckets
    bias: float
    prior: float


def text_features(
    data: np.ndarray, starts: np.ndarray, hasher: SpanHasher
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, bucket, word hash or 0) of every word and word beginning, some words at a time."""
    shift = np.uint64(64 - BUCKET_BITS)
    for first, edges, _ in word_slices(data, starts, _LETTER, 0, SLICE):
        a = int(edges[0])
        x = lower_ascii(data[a : int(edges[-1])])
        begins, ends = runs(_LETTER[x], edges - a)
        text = first + np.searchsorted(edges - a, begins, "right") - 1
        sums = hasher.sums(x)
        whole = hasher.spans(sums, begins, ends)
        yield text, (whole >> shift).astype(np.int64), whole
        for n in BEGINNINGS:
            longer = ends - begins > n
            part = hasher.spans(sums, begins[longer], begins[longer] + n)
            part = (part + np.uint64(n)) * np.uint64(0x9FB21C651E98DF25)
            yield text[longer], (part >> shift).astype(np.int64), np.zeros(len(part), np.uint64)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct buckets, and a min-hash of its word pairs, which copies share."""
    hasher = SpanHasher()
    for batch in batches:
        data, starts = byte_view(batch.column(1))
        packed, likeness = [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            buckets, least = [np.zeros(0, np.int64)], 0
            for _, bucket, word in text_features(data[a:b], np.array([0, b - a]), hasher):
                buckets.append(bucket)
                if len(word) > 1 and word[0]:
                    pairs = (word[:-1] * np.uint64(3) + word[1:]) * np.uint64(0x9E3779B97F4A7C15)
                    low = int(pairs.min() >> np.uint64(1))
                    least = min(least, low) if least else low
            packed.append(np.unique(np.concatenate(buckets)).astype("<i4").tobytes())
            likeness.append(least)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(packed, pa.binary()),
                pa.array(likeness, pa.int64()),
            ],
            names=["id", "buckets", "likeness"],
        )


def _rows(sample: list, wanted: set) -> list[np.ndarray]:
    """Bucket arrays of the wanted rows, one for each group of texts that share a min-hash.

    Copies of a text would count as so many independent witnesses of its words.
    """
    seen, out = set(), []
    for r in sample:
        key = r.likeness or r.buckets
        if r.id in wanted and r.buckets and key not in seen:
            seen.add(key)
            out.append(np.frombuffer(r.buckets, "<i4"))
    return out


def _first_of(sizes: list, wanted: set, most: int) -> set:
    """Of the wanted ids the first that have ``most`` features in all, and one at least."""
    out, total = set(), 0
    for r in sizes:
        if r.id in wanted:
            total += r.n
            if out and total > most:
                break
            out.add(r.id)
    return out


def train_toxicity(
    docs: DataFrame,
    positives: DataFrame,
    prior: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    most_positive: int = 4000,
    most_unlabelled: int = 8000,
    most_features: int = 1 << 25,
    rounds: int = 500,
) -> ToxicityModel:
    """Fit on at most ``most_positive`` toxic texts and ``most_unlabelled`` texts of any kind.

    Of long texts it is fewer: of either sample the first whose distinct features, four bytes each, are
    together ``most_features`` at most, and one text at least. Of texts in a sample that share the
    smallest hash of their pairs of neighbouring words, as copies do, only one is learned from.

    ``positives`` has the ids (column ``id_col``) of confirmed toxic texts; ``prior`` is the share of
    toxic texts among all. Both samples are the rows with the smallest hashes of their ids, so
    they do not depend on partitions; of a repeated id's texts the first in order is taken. Without
    positives the model calls nothing toxic.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL"
    )

    def smallest(ids: DataFrame, most: int) -> set:
        n = ids.agg(F.approx_count_distinct(F.xxhash64("id")).alias("n")).first().n
        few = ids.where(rarely("id", most, n)).distinct()
        return {r.id for r in few.orderBy(hash_place("id"), "id").limit(most).collect()}

    toxic = positives.select(F.col(id_col).alias("id")).join(rows.select("id"), "id", "left_semi")
    p, u = smallest(toxic, most_positive), smallest(rows.select("id"), most_unlabelled)
    # p and u have at most most_positive + most_unlabelled ids, whatever the corpus is.
    chosen = docs.sparkSession.createDataFrame(
        [(x,) for x in sorted(p | u)], T.StructType([rows.schema["id"]])
    )
    packed = stored(
        rows.join(F.broadcast(chosen), "id", "left_semi")
        .groupBy("id")
        .agg(F.min("text").alias("text"))
        .mapInArrow(_sample, with_id(rows, "id", "buckets binary, likeness long")),
        "sample",
    )
    sizes = packed.select("id", (F.octet_length("buckets") / 4).cast("long").alias("n"), hash_place("id").alias("h"))
    sizes = sorted(sizes.collect(), key=lambda r: (r.h, r.id))
    p, u = (_first_of(sizes, some, most_features) for some in (p, u))
    wanted = docs.sparkSession.createDataFrame(
        [(x,) for x in sorted(p | u)], T.StructType([rows.schema["id"]])
    )
    sample = packed.join(F.broadcast(wanted), "id", "left_semi").collect()
    sample.sort(key=lambda r: (r.id, r.buckets))
    return fit(_rows(sample, p), _rows(sample, u), prior, rounds)


def nn_gradient(
    w: np.ndarray,
    bias: float,
    positive: tuple[np.ndarray, np.ndarray],
    unlabelled: tuple[np.ndarray, np.ndarray],
    n_p: int,
    n_u: int,
    prior: float,
) -> tuple[np.ndarray, float, float]:
    """The step's direction for weights and bias, and the risk on clean texts.

    ``positive`` and ``unlabelled`` are (text, feature) pairs. While the risk on clean texts is not below
    zero the direction is the gradient of the whole risk, else that of this part, uphill.
    """
    (row_p, col_p), (row_u, col_u) = positive, unlabelled
    out_p = np.bincount(row_p, w[col_p], n_p) + bias
    out_u = np.bincount(row_u, w[col_u], n_u) + bias
    s_p, s_u = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (out_p, out_u))
    clean_risk = np.logaddexp(0, out_u).mean() - prior * np.logaddexp(0, out_p).mean()
    g_up = prior * (s_p - 1) / n_p
    g_neg_p, g_neg_u = -prior * s_p / n_p, s_u / n_u
    if clean_risk >= 0:
        g_p, g_u = g_up + g_neg_p, g_neg_u
    else:
        g_p, g_u = -g_neg_p, -g_neg_u
    slope = np.bincount(col_p, g_p[row_p], len(w)) + np.bincount(col_u, g_u[row_u], len(w))
    return slope, float(g_p.sum() + g_u.sum()), float(clean_risk)


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 500
) -> ToxicityModel:
    """Full-batch non-negative PU learning over the buckets that positives have more often."""
    empty = np.zeros(0, np.int64)
    if not positive or not unlabelled:
        return ToxicityModel(empty, np.zeros(0), -4.0, prior)
    prior = min(max(prior, 0.001), 0.9)
    size = 1 << BUCKET_BITS

    def texts_with(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(size, np.int32)
        for r in rows:  # a row's buckets differ
            out[r] += 1
        return out

    n_p, n_u = texts_with(positive), texts_with(unlabelled)
    # Far more often than in unlabelled text, by more than chance.
    expected = (n_u + 0.5) / len(unlabelled) * len(positive)
    screened = (n_p >= 4) & (n_p > max(1.5, 0.5 / prior) * expected)
    screened &= n_p - expected > 4 * np.sqrt(expected)
    buckets = np.flatnonzero(screened)
    place = np.full(size, -1, np.int32)
    place[buckets] = np.arange(len(buckets))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        cols = [place[r] for r in rows]
        cols = [c[c >= 0] for c in cols]
        return np.repeat(np.arange(len(rows)), [len(c) for c in cols]), np.concatenate(cols)

    (row_p, col_p), (row_u, col_u) = matrix(positive), matrix(unlabelled)
    w, bias = np.zeros(len(buckets)), float(np.log(prior / (1 - prior)))
    speed, speed_bias = np.zeros(len(buckets)), 0.0

    for _ in range(rounds):
        slope, slope_bias, _ = nn_gradient(
            w, bias, (row_p, col_p), (row_u, col_u), len(positive), len(unlabelled), prior
        )
        speed = 0.9 * speed - 6.0 * (slope + 2e-5 * w)
        speed_bias = 0.9 * speed_bias - 0.2 * slope_bias
        w, bias = np.maximum(w + speed, 0), bias + speed_bias
    return ToxicityModel(buckets, w, bias, prior)


def scores(
    data: np.ndarray, starts: np.ndarray, model: ToxicityModel, hasher: SpanHasher
) -> np.ndarray:
    """The chance that each text is toxic; each feature counts once a text."""
    n = len(starts) - 1
    known = np.zeros(1 << BUCKET_BITS, bool)
    known[model.buckets] = True
    found = [np.zeros(0, np.int64)]
    for text, bucket, _ in text_features(data, starts, hasher):
        hit = known[bucket]
        found.append(np.unique(text[hit] << BUCKET_BITS | bucket[hit]))
    pairs = np.unique(np.concatenate(found))
    weight = model.weights[np.searchsorted(model.buckets, pairs & ((1 << BUCKET_BITS) - 1))]
    total = model.bias + np.bincount(pairs >> BUCKET_BITS, weight, n)
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _score(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        found = scores(*byte_view(batch.column(batch.num_columns - 1)), model, hasher)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, pa.float64())],
            names=[*batch.schema.names[:-1], "score"],
        )


def toxicity_of(text: Column, model: ToxicityModel) -> Column:
    """The score of a text column, for a frame whose other columns need not go to Python."""

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = SpanHasher()
        for some in texts:
            yield pa.array(scores(*byte_view(some), model, hasher), pa.float64())

    return F.arrow_udf(score, "double")(text)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and score (0 to 1) of every row of ``docs``; a text is toxic from 0.5 on.

    Whole texts are read. NULL and empty texts get the score of a text without any known
    feature. Repeated rows give repeated results, NULL ids stay, no rows give no rows,
    and columns besides id and text are not looked at.
    """
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(partial(_score, model=model), with_id(docs, id_col, "score double"))
        .withColumnRenamed("id", id_col)
    )


def learn_from_labels(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    *,
    prior: float | None = None,
) -> ToxicityModel:
    """A model from the label rows that ``training`` (over the id) admits.

    An id with several labels is toxic if any says so. The unlabelled texts come from admitted
    documents, their labels unused. ``prior``, if not given, is the share of toxic ids among the
    admitted labels; give it where only toxic texts are labelled.
    """
    known = (
        labels.where(training)
        .where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.max("toxic").alias("toxic"))
    )
    if prior is None:
        prior = known.agg(F.avg((F.col("toxic") > 0).cast("double")).alias("p")).first().p
    return train_toxicity(
        docs.where(training), known.where("toxic > 0"), prior or 0.0, id_col=id_col
    )
