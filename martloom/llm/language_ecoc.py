"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary classifier per bit, over hashed byte trigrams of the
whole text, predicts that bit; the language whose codeword has the smallest loss, each bit
weighted by how well its classifier does on that language, is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import (
    SLICE,
    byte_view,
    hash_place,
    lower_ascii,
    rarely,
    stored,
    with_id,
)

BUCKET_BITS = 14
#: Texts that are laid out as a table of all their buckets at once.
BLOCK_TEXTS = 512
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits, -1 or 1
    trust: np.ndarray  # languages x bits, each row sums to 1
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray  # bits
    margin: float


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """A bucket for each place where three bytes of lower-cased text begin."""
    x = lower_ascii(data).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    mixed = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of -1 and 1: all splits of few languages, for many the best of seeded random codes."""
    if n <= 5:
        bits = max(1, 2 ** (n - 1) - 1)
        splits = np.arange(1, bits + 1)
        rows = [(splits >> k) & 1 if k < n - 1 else 0 * splits for k in range(n)]
        return np.where(np.array(rows), 1, -1).astype(np.int8)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code[:, np.abs(code.sum(0)) == n] = rng.permutation(np.resize([-1, 1], n))[:, None]
        nearest = (bits - _most_alike(code)) // 2
        if nearest > apart:
            best, apart = code, nearest
    return best


def _most_alike(code: np.ndarray, block: int = 1024) -> int:
    """The largest product of two different codewords, without a table of all pairs."""
    code, most = code.astype(np.float32), -code.shape[1]
    for a in range(0, len(code), block):
        gram = code[a : a + block] @ code.T
        gram[np.arange(len(gram)), np.arange(a, a + len(gram))] = most
        most = max(most, int(gram.max()))
    return most


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket shares of each sampled text as two packed arrays, and how many buckets it has."""
    for batch in batches:
        data, starts = byte_view(batch.column(2))
        ids, shares = [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            n = np.zeros(1 << BUCKET_BITS, np.int64)
            for at in range(int(a), int(b), SLICE):
                some = trigram_buckets(data[at : min(at + SLICE + 2, int(b))])
                n += np.bincount(some, minlength=len(n))
            found = np.flatnonzero(n)
            n = n[found]
            ids.append(found.astype("<i4").tobytes())
            shares.append((n / max(1, n.sum())).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array(ids, pa.binary()),
                pa.array(shares, pa.binary()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
            ],
            names=["place", "lang", "ids", "shares", "n"],
        )


def train_language_model(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    per_language: int = 400,
    most_texts: int = 80_000,
    most_buckets: int = 1 << 24,
    rounds: int = 80,
    margin: float = 0.05,
) -> LanguageModel:
    """Fit the bit classifiers on every value of ``lang``.

    Each gets at most ``per_language`` texts, or, of many languages, an equal part of
    ``most_texts`` and one text at least. Of long texts it gets fewer: the first whose buckets, eight
    bytes each, are together an equal part of ``most_buckets``, and one at least. The sample is the rows
    with the smallest hashes of their id, so it does not depend on how the table is partitioned; of
    an id's several texts in a language the first in order is taken. Rows without text, language or
    id are not used. No usable row: a model of no language, which calls every text undetermined.

    The classifiers are fitted on the driver, in time that goes with the sample's buckets, the bits
    (ten times the logarithm of the number of languages) and ``rounds``, not with the corpus.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    distinct_ids = F.approx_count_distinct(F.xxhash64("id"))
    counts = rows.groupBy("lang").agg(distinct_ids.alias("n")).collect()
    per_language = min(per_language, max(1, most_texts // max(1, len(counts))))
    counts = labelled.sparkSession.createDataFrame(counts, "lang string, n long")
    by_hash = Window.partitionBy("lang").orderBy(hash_place("id"), "id")
    chosen = (
        rows.select("id", "lang")
        .join(F.broadcast(counts), "lang")  # a row for each language
        .where(rarely("id", per_language, F.col("n")))
        .select("id", "lang")
        .distinct()
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= per_language)
    )
    # At most per_language rows for each language, and most_texts or one for each in all.
    packed = stored(
        rows.join(F.broadcast(chosen), ["id", "lang"])
        .groupBy("id", "lang", "place")
        .agg(F.min("text").alias("text"))
        .select("place", "lang", "text")
        .mapInArrow(_sparse, "place int, lang string, ids binary, shares binary, n long"),
        "sample",
    )
    each = most_buckets // max(1, counts.count())
    so_far = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    few = (
        packed.select("lang", "place", F.sum("n").over(so_far).alias("so_far"))
        .where((F.col("so_far") <= each) | (F.col("place") == 1))
        .select("lang", "place")
    )
    sample = packed.join(F.broadcast(few), ["lang", "place"]).select("lang", "ids", "shares").collect()
    sample.sort(key=lambda r: (r.lang, r.ids, r.shares))
    languages = tuple(sorted({r.lang for r in sample}))
    code = codewords(len(languages)) if languages else np.zeros((0, 1), np.int8)
    number = {lang: k for k, lang in enumerate(languages)}
    which = np.array([number[r.lang] for r in sample], np.int64)
    ids = [np.frombuffer(r.ids, "<i4") for r in sample]
    shares = [np.frombuffer(r.shares, "<f4") for r in sample]
    weights, bias = _fit(ids, shares, code[which].astype(np.float64), rounds)
    outputs = np.array(
        [v.astype(np.float64) @ weights[i] + bias for i, v in zip(ids, shares, strict=True)]
    )
    trust = np.ones(code.shape)
    for k in range(len(languages)):
        right = (np.sign(outputs[which == k]) == code[k]).mean(0)
        trust[k] = np.maximum(right - 0.5, 0.01)
    trust /= trust.sum(1, keepdims=True) if languages else 1
    return LanguageModel(languages, code, trust, weights.astype(np.float32), bias, margin)


def _fit(
    ids: list[np.ndarray], shares: list[np.ndarray], target: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of every bit at once by accelerated gradient steps.

    Texts are laid out block by block as rows over all used buckets, so that a step is two products
    of matrices whatever the number of bits.
    """
    weights = np.zeros((1 << BUCKET_BITS, target.shape[1]))
    bias = np.zeros(target.shape[1])
    if not len(ids):
        return weights, bias
    lengths = np.array([len(i) for i in ids])
    flat, value = np.concatenate(ids), np.concatenate(shares)
    idf = np.sqrt(len(ids) / (1 + np.bincount(flat, minlength=len(weights))))
    value = (value * (idf[flat] * 10)).astype(np.float32)
    used, flat = np.unique(flat, return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    table = np.zeros((min(BLOCK_TEXTS, len(ids)), len(used)), np.float32)
    w = np.zeros((len(used), target.shape[1]), np.float32)
    ahead, ahead_bias, step = w, bias, 4.0
    for k in range(rounds):
        slope, slope_bias = 1e-5 * ahead, np.zeros(len(bias))
        for at in range(0, len(ids), BLOCK_TEXTS):
            texts = slice(at, min(at + BLOCK_TEXTS, len(ids)))
            some = slice(ends[texts.start], ends[texts.stop])
            spots = np.repeat(np.arange(texts.stop - at), lengths[texts]), flat[some]
            table[spots] = value[some]
            rows, wanted = table[: texts.stop - at], target[texts]
            out = rows @ ahead + ahead_bias
            miss = -wanted / (1 + np.exp(np.clip(wanted * out, -30, 30))) / len(ids)
            slope += rows.T @ miss.astype(np.float32)
            slope_bias += miss.sum(0)
            table[spots] = 0
        new, new_bias = ahead - np.float32(step) * slope, ahead_bias - step * slope_bias
        push = k / (k + 3)
        ahead = new + np.float32(push) * (new - w)
        ahead_bias = new_bias + push * (new_bias - bias)
        w, bias = new, new_bias
    weights[used] = w * (idf[used] * 10)[:, None]
    return weights, bias


def bit_outputs(data: np.ndarray, starts: np.ndarray, model: LanguageModel) -> np.ndarray:
    """What every bit's classifier says of every text, all bytes counted."""
    n, bits = len(starts) - 1, model.weights.shape[1]
    sums, counts = np.zeros((n, bits)), np.maximum(np.diff(starts) - 2, 0)
    step = max(1, SLICE * 8 // max(8, bits))  # the more bits, the fewer bytes at a time
    for at in range(0, len(data), step):
        buckets = trigram_buckets(data[at : at + step + 2])
        if not len(buckets):
            continue
        # A trigram counts for the text it begins and ends in.
        place = np.arange(at, at + len(buckets))
        text = np.searchsorted(starts, place[[0, -1]], "right") - 1
        edges = np.clip(starts[text[0] : text[1] + 2] - at, 0, len(buckets))
        inside = np.ones(len(buckets), bool)
        for back in (1, 2):
            ends = starts[text[0] + 1 : text[1] + 3] - at - back
            inside[ends[(ends >= 0) & (ends < len(buckets))]] = False
        ends = None
        found = model.weights[buckets] * inside[:, None]
        full = np.flatnonzero(edges[1:] > edges[:-1])
        sums[text[0] + full] += np.add.reduceat(found, edges[:-1][full], axis=0)
    return sums / np.maximum(counts, 1)[:, None] + model.bias


def decode(outputs: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language number, probability-like score, and lead over the second, of each text."""
    up, down = np.where(model.code > 0, model.trust, 0), np.where(model.code < 0, model.trust, 0)
    losses = np.logaddexp(0, -outputs) @ up.T + np.logaddexp(0, outputs) @ down.T
    spread = np.exp(-4 * (losses - losses.min(1, keepdims=True)))
    chance = spread / spread.sum(1, keepdims=True)
    order = np.sort(chance, axis=1)
    lead = order[:, -1] - (order[:, -2] if chance.shape[1] > 1 else 0)
    return losses.argmin(1), order[:, -1], lead


def _told(texts: pa.Array, letters: pa.Array, model: LanguageModel) -> list[pa.Array]:
    """Language, score and whether it is ambiguous, of every text."""
    names = np.array([*model.languages, UNDETERMINED], object)
    data, starts = byte_view(texts)
    known = letters.to_numpy(zero_copy_only=False).astype(bool)
    if not model.languages:
        known[:] = False
    if known.any():
        best, score, lead = decode(bit_outputs(data, starts, model), model)
    else:
        best, score, lead = np.zeros((3, len(known)))
    best = np.where(known, best, len(names) - 1).astype(int)
    return [
        pa.array(names[best], pa.string()),
        pa.array(np.where(known, score, 0.0), pa.float64()),
        pa.array(known & (lead < model.margin)),
    ]


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, texts, letters = batch.columns
        yield pa.RecordBatch.from_arrays(
            [*keys, *_told(texts, letters, model)],
            names=[*batch.schema.names[:-2], "lang_pred", "score", "ambiguous"],
        )


def has_letter(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.rlike(r"\p{L}"), F.lit(False))


def language_of(text: Column, model: LanguageModel) -> Column:
    """``lang`` and ``ambiguous`` of a text column, as a struct, for a frame whose other columns
    need not go to Python."""

    def told(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, letters in pairs:
            lang, _, ambiguous = _told(texts, letters, model)
            yield pa.StructArray.from_arrays([lang, ambiguous], ["lang", "ambiguous"])

    # Else Spark would evaluate it once for each of its fields.
    udf = F.arrow_udf(told, "lang string, ambiguous boolean").asNondeterministic()
    return udf(text, has_letter(text))


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, lang_pred, score and ambiguous of every row of ``docs``.

    Whole texts are read. NULL, empty and letterless texts are ``und`` with score 0, and so is
    everything if no language was learned. Repeated rows give repeated results, a NULL id
    stays NULL, an empty table gives no rows, and other columns are not looked at.
    """
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(text_col).alias("ok")
    ).mapInArrow(
        partial(_predict, model=model),
        with_id(docs, id_col, "lang_pred string, score double, ambiguous boolean"),
    ).withColumnRenamed("id", id_col)
