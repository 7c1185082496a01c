from __future__ import annotations

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import language_ecoc, toxicity_nnpu
from martloom.llm.common import SpanHasher, byte_view, fold
from martloom.llm.language_ecoc import (
    LanguageModel,
    bit_outputs,
    codewords,
    decode,
    identify_languages,
    train_language_model,
    trigram_buckets,
)
from martloom.llm.queries import queries
from martloom.llm.toxicity_nnpu import (
    fit,
    learn_from_labels,
    nn_gradient,
    score_toxicity,
    text_features,
)
from tests.conftest import SF_DIR
from tests.llm.data import edge_docs, empty_docs, texts

LANGUAGES = {"aa": "bcdfgh", "bb": "jklmnp", "cc": "qrstvw", "dd": "aeioux", "ee": "yzajsd"}


def babble(seed: int, letters: str, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 8))) for _ in range(n))


def speech(spark, per: int = 40):
    rows = [
        (k * 10 + j, babble(k * 10 + j, letters, 30), lang)
        for j, (lang, letters) in enumerate(LANGUAGES.items())
        for k in range(per)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_codewords_are_far_apart():
    for n in (1, 2, 3, 4, 5, 6, 9, 30):
        code = codewords(n).astype(int)
        assert code.shape[0] == n
        assert set(np.unique(code)) <= {-1, 1}
        far = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(far, default=1) >= max(1, code.shape[1] // 4)


def test_bit_outputs_count_every_trigram_of_its_text_only(spark, monkeypatch):
    monkeypatch.setattr(language_ecoc, "SLICE", 17)
    model = train_language_model(speech(spark, 10), rounds=5)
    some = ["", "ab", "abc", "Hello World, hello", "x" * 100, "é", "tail"]
    data, starts = byte_view(pa.array(some))
    found = bit_outputs(data, starts, model)
    for k, text in enumerate(some):
        buckets = trigram_buckets(np.frombuffer(text.encode(), np.uint8))
        want = model.weights[buckets].sum(0) / max(1, len(buckets)) + model.bias
        assert np.allclose(found[k], want, atol=1e-4)


def test_decoding_is_the_smallest_weighted_loss():
    r = np.random.default_rng(2)
    for n in (1, 2, 4, 7):
        code = codewords(n)
        trust = r.random(code.shape)
        trust /= trust.sum(1, keepdims=True)
        empty = np.zeros((0, code.shape[1]))
        model = LanguageModel(tuple("abcdefg"[:n]), code, trust, empty, np.zeros(code.shape[1]), 0.05)
        outputs = r.normal(0, 2, (50, code.shape[1]))
        best, score, lead = decode(outputs, model)
        for k, out in enumerate(outputs):
            losses = [
                sum(t * math.log1p(math.exp(-c * x)) for t, c, x in zip(trust[j], code[j], out, strict=True))
                for j in range(n)
            ]
            chance = [math.exp(-4 * (x - min(losses))) for x in losses]
            chance = sorted((x / sum(chance) for x in chance), reverse=True)
            assert best[k] == losses.index(min(losses))
            assert math.isclose(score[k], chance[0], rel_tol=1e-9)
            assert math.isclose(lead[k], chance[0] - (chance[1] if n > 1 else 0), abs_tol=1e-9)


def test_fitting_follows_the_gradient_of_the_logistic_loss(monkeypatch):
    """Against steps over a whole table in double precision, in one block and in several."""
    r = np.random.default_rng(1)
    table = (r.random((40, 30)) < 0.3) * r.random((40, 30))
    table /= 4 * table.sum(1, keepdims=True)
    ids = [np.flatnonzero(x).astype("<i4") for x in table]
    shares = [x[x > 0].astype("<f4") for x in table]
    target = r.choice([-1.0, 1.0], (40, 3))
    idf = np.sqrt(40 / (1 + (table > 0).sum(0)))
    x = table * idf * 10
    w = ahead = np.zeros((30, 3))
    bias = ahead_bias = np.zeros(3)
    for k in range(25):
        miss = -target / (1 + np.exp(target * (x @ ahead + ahead_bias))) / 40
        new, new_bias = ahead - 4 * (x.T @ miss + 1e-5 * ahead), ahead_bias - 4 * miss.sum(0)
        ahead, ahead_bias = new + k / (k + 3) * (new - w), new_bias + k / (k + 3) * (new_bias - bias)
        w, bias = new, new_bias
    for block in (512, 7):
        monkeypatch.setattr(language_ecoc, "BLOCK_TEXTS", block)
        weights, found_bias = language_ecoc._fit(ids, shares, target, 25)
        assert np.allclose(weights[:30], w * (idf * 10)[:, None], rtol=1e-3, atol=1e-2)
        assert np.allclose(found_bias, bias, rtol=1e-3, atol=1e-4)


def test_long_texts_make_the_samples_smaller(spark, monkeypatch):
    seen = []
    whole = language_ecoc._fit
    monkeypatch.setattr(language_ecoc, "_fit", lambda *x: (seen.append([len(i) for i in x[0]]), whole(*x))[1])
    model = train_language_model(speech(spark), rounds=2, most_buckets=2500)
    assert model.languages == tuple(LANGUAGES)
    assert sum(seen[0]) <= 2500 and len(seen[0]) > 2 * len(LANGUAGES)
    model = train_language_model(speech(spark), rounds=2, most_buckets=1)
    assert model.languages == tuple(LANGUAGES) and len(seen[1]) == len(LANGUAGES)
    rows = []
    monkeypatch.setattr(toxicity_nnpu, "fit", lambda p, u, *_: rows.append((p, u)))
    docs = speech(spark)
    for most in (1 << 25, 3000, 1):
        toxicity_nnpu.train_toxicity(docs, docs.where("doc_id < 200"), 0.5, most_features=most)
    (all_p, all_u), (some_p, some_u), (one_p, one_u) = rows
    assert len(all_p) > len(some_p) > len(one_p) == 1
    assert len(all_u) > len(some_u) > len(one_u) == 1
    assert sum(map(len, some_p)) <= 3000 and sum(map(len, some_u)) <= 3000


def test_many_languages_are_fitted_in_seconds():
    """200 languages, 40 texts of 400 buckets each, all 80 rounds."""
    r = np.random.default_rng(0)
    own = [r.choice(1 << 14, 1500, replace=False) for _ in range(200)]
    ids = [np.sort(r.choice(own[k], 400, replace=False)).astype("<i4") for k in range(200) for _ in range(40)]
    shares = [np.full(400, 1 / 400, "<f4") for _ in ids]
    code = codewords(200)
    target = np.repeat(code, 40, axis=0).astype(float)
    began = time.perf_counter()
    weights, bias = language_ecoc._fit(ids, shares, target, 80)
    assert time.perf_counter() - began < 240
    outputs = np.array([v @ weights[i] + bias for i, v in zip(ids, shares, strict=True)])
    assert (np.sign(outputs) == target).mean() > 0.9


def test_languages_of_held_out_texts(spark):
    docs = speech(spark)
    model = train_language_model(docs.where(fold("doc_id", 4) != 2))
    told = identify_languages(docs, model).join(docs, "doc_id").where(fold("doc_id", 4) == 2)
    right, n = told.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 20
    assert right >= 0.95 * n


def test_a_text_of_two_languages_is_ambiguous(spark):
    model = train_language_model(speech(spark), margin=0.5)
    both = babble(1, LANGUAGES["aa"], 50) + " " + babble(2, LANGUAGES["bb"], 50)
    docs = spark.createDataFrame([(1, both), (2, babble(3, LANGUAGES["aa"], 90))], "doc_id long, text string")
    rows = {r.doc_id: r for r in identify_languages(docs, model).collect()}
    assert rows[1].score < rows[2].score
    assert not rows[2].ambiguous


def test_languages_of_edge_rows(spark):
    model = train_language_model(speech(spark))
    rows = identify_languages(edge_docs(spark), model).collect()
    assert len(rows) == len(texts())
    letterless = {4, 5, 6, 8}
    for r in rows:
        if r.doc_id in letterless:
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
        elif r.doc_id is not None:
            assert r.lang_pred in LANGUAGES
        assert 0 <= r.score <= 1
    assert identify_languages(empty_docs(spark), model).count() == 0


def test_every_one_of_many_languages_is_learned(spark):
    """Each language has words of its own; the last ones are the rarest."""
    r = random.Random(5)
    own = [["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)] for _ in range(230)]
    rows = [
        (1000 * k + j, " ".join(r.choice(own[j]) for _ in range(25)), f"l{j:03}")
        for j in range(230)
        for k in range(3 if j < 200 else 2)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = train_language_model(docs)
    assert model.languages == tuple(f"l{j:03}" for j in range(230))
    told = identify_languages(docs, model).join(docs, "doc_id")
    right = told.where("lang = lang_pred")
    assert right.count() >= 0.95 * len(rows)
    assert right.where("lang >= 'l200'").count() >= 57
    few = train_language_model(docs, most_texts=100, rounds=1)
    assert few.languages == model.languages


def test_nothing_learned_means_nothing_told(spark):
    model = train_language_model(empty_docs(spark))
    rows = identify_languages(edge_docs(spark), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_one_language_is_all_there_is(spark):
    docs = speech(spark).where("lang = 'aa'")
    rows = identify_languages(docs, train_language_model(docs)).collect()
    assert {r.lang_pred for r in rows} == {"aa"}


def test_features_are_words_and_beginnings_wherever_they_stand():
    hasher = SpanHasher()

    def of(text: str) -> set:
        data, starts = byte_view(pa.array([text]))
        return {int(b) for _, bucket, _ in text_features(data, starts, hasher) for b in bucket}

    assert of("idiot") == of("  IDIOT! idiot ")
    assert of("loweia") & of("zz loweib")
    assert not of("loweia") & of("owei")
    assert of("") == set()


def sample(seed: int, n: int, toxic_share: float):
    """Texts as buckets: toxic ones have one of five words that clean ones lack."""
    r = np.random.default_rng(seed)
    rows, kind = [], r.random(n) < toxic_share
    for toxic in kind:
        words = r.integers(100, 3000, 60)
        rows.append(np.unique(np.append(words, r.integers(0, 5)) if toxic else words).astype("<i4"))
    return rows, kind


def test_positives_and_unlabelled_texts_are_enough():
    positive, _ = sample(0, 300, 1.0)
    unlabelled, _ = sample(1, 1500, 0.1)
    model = fit(positive, unlabelled, prior=0.1)
    unseen, kind = sample(2, 1000, 0.1)
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    out = np.array([sum(weight.get(int(b), 0) for b in x) + model.bias for x in unseen])
    assert ((out > 0) == kind).mean() > 0.99


def direct_risk(positive, unlabelled, prior, buckets, weights, bias):
    """The risk as it is written, text by text: its positive part, and its part on clean texts."""
    weight = dict(zip(buckets.tolist(), weights.tolist(), strict=True))

    def out(row):
        return sum(weight.get(int(b), 0.0) for b in row) + bias

    def loss(x, sign):
        return math.log1p(math.exp(-abs(x))) + max(-sign * x, 0)

    up = sum(loss(out(x), 1) for x in positive) / len(positive)
    down = sum(loss(out(x), -1) for x in positive) / len(positive)
    unknown = sum(loss(out(x), -1) for x in unlabelled) / len(unlabelled)
    return prior * up, unknown - prior * down


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_a_step_follows_the_gradient_of_the_risk(prior):
    """By differences; with a prior that is too large the risk on clean texts goes below zero."""
    positive, _ = sample(3, 120, 1.0)
    unlabelled, _ = sample(4, 400, 0.1)
    r = np.random.default_rng(prior > 0.5)
    buckets = np.arange(5)
    features = [[(np.repeat(np.arange(len(x)), [np.isin(t, buckets).sum() for t in x]),
                  np.concatenate([t[np.isin(t, buckets)] for t in x]))] for x in (positive, unlabelled)]
    (at_p,), (at_u,) = features
    signs = set()
    for bias in (-4.0, -1.0, 2.0):
        w = r.random(5) * 3
        slope, slope_bias, clean = nn_gradient(w, bias, at_p, at_u, len(positive), len(unlabelled), prior)
        up, down = direct_risk(positive, unlabelled, prior, buckets, w, bias)
        assert math.isclose(clean, down, abs_tol=1e-9)
        signs.add(down >= 0)

        def objective(weights, b, below=down < 0):
            one, two = direct_risk(positive, unlabelled, prior, buckets, weights, b)
            return -two if below else one + two

        for k in range(5):
            step = np.zeros(5)
            step[k] = 1e-5
            want = (objective(w + step, bias) - objective(w - step, bias)) / 2e-5
            assert math.isclose(slope[k], want, rel_tol=1e-4, abs_tol=1e-7)
        want = (objective(w, bias + 1e-5) - objective(w, bias - 1e-5)) / 2e-5
        assert math.isclose(slope_bias, want, rel_tol=1e-4, abs_tol=1e-7)
    if prior > 0.5:
        assert signs == {True, False}


def test_fitted_risk_is_lower_and_weights_are_not_negative():
    positive, _ = sample(0, 300, 1.0)
    unlabelled, _ = sample(1, 1500, 0.1)
    model = fit(positive, unlabelled, prior=0.1)
    start = direct_risk(positive, unlabelled, 0.1, model.buckets, 0 * model.weights, math.log(1 / 9))
    end = direct_risk(positive, unlabelled, 0.1, model.buckets, model.weights, model.bias)
    assert end[0] + max(0, end[1]) < 0.5 * (start[0] + max(0, start[1]))
    assert (model.weights >= 0).all()


def test_long_texts_have_the_features_of_their_words(monkeypatch):
    some = [babble(k, "abcdefghij", 80) for k in range(6)] + ["", "x" * 90, "éa" * 40 + " b"]
    data, starts = byte_view(pa.array(some))
    found = []
    for size in (1 << 19, 40):
        monkeypatch.setattr(toxicity_nnpu, "SLICE", size)
        pairs = set()
        for text, bucket, _ in text_features(data, starts, SpanHasher()):
            pairs |= set(zip(text.tolist(), bucket.tolist(), strict=True))
        found.append(pairs)
    assert found[0] == found[1]


def test_samples_and_rounds_are_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity_nnpu, "fit", lambda p, u, *_: seen.append((len(p), len(u))))
    docs = spark.range(9000).selectExpr("id AS doc_id", "sha2(string(id), 256) || ' ' || id AS text")
    docs = docs.withColumn("text", F.translate("text", "0123456789", "ghijklmnop"))
    toxicity_nnpu.train_toxicity(docs, docs.where("doc_id < 4500"), 0.5)
    assert seen == [(4000, 8000)]
    whole = language_ecoc._fit
    monkeypatch.setattr(
        language_ecoc, "_fit", lambda *x: (seen.append(x[-1]), whole(*x[:-1], 1))[1]
    )
    train_language_model(speech(spark, 5))
    assert seen[1:] == [80]


def test_a_repeated_id_is_sampled_once(spark, monkeypatch):
    docs = speech(spark)
    hot = spark.createDataFrame(
        [(10_000, babble(k, "bcdfgh", 30), "aa") for k in range(3000)], docs.schema
    )
    seen = []
    whole = language_ecoc._fit
    monkeypatch.setattr(language_ecoc, "_fit", lambda *x: (seen.append(len(x[0])), whole(*x))[1])
    model = train_language_model(docs.union(hot), rounds=5)
    assert seen == [docs.count() + 1]
    assert model.languages == tuple(LANGUAGES)
    # Of a language that is all one id, too, a text is learned.
    model = train_language_model(docs.union(hot.withColumn("lang", F.lit("ff"))), rounds=5)
    assert model.languages == (*LANGUAGES, "ff")
    rows = []
    monkeypatch.setattr(toxicity_nnpu, "_rows", lambda sample, wanted: rows.append(len(sample)) or [])
    toxicity_nnpu.train_toxicity(docs.union(hot), docs.where("doc_id < 50"), 0.5)
    assert rows == [docs.count() + 1] * 2


def test_without_positives_nothing_is_toxic(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = learn_from_labels(edge_docs(spark), labels, F.lit(True))
    rows = score_toxicity(edge_docs(spark), model).collect()
    assert len(rows) == len(texts())
    assert all(0 <= r.score < 0.5 for r in rows)
    assert score_toxicity(empty_docs(spark), model).count() == 0


def test_labels_may_repeat_conflict_and_be_null(spark):
    docs = spark.createDataFrame(
        [(k, ("scum " if k % 9 == 0 else "") + babble(k, "abcdefgh", 20)) for k in range(360)],
        "doc_id long, text string",
    )
    rows = [(k, None, int(k % 9 == 0)) for k in range(360)]
    rows += [(0, 1, 0), (0, 1, 1), (1, 1, None), (None, 1, 1), (9999, 0, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = learn_from_labels(docs, labels, F.lit(True))
    found = {r.doc_id: r.score >= 0.5 for r in score_toxicity(docs, model).collect()}
    assert found == {k: k % 9 == 0 for k in range(360)}


def test_held_out_accuracy_of_the_queries(spark):
    """On the supplied tables, of whose labels some are noise."""
    found = queries()["op4_language_ecoc"](spark, SF_DIR).where("held_out")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    right, n = (
        found.join(docs, "doc_id")
        .agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"))
        .first()
    )
    assert n > 100
    assert right >= 0.95 * n
    found = queries()["op3_toxicity_nnpu"](spark, SF_DIR).where("held_out")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    right, n = (
        found.join(labels, "doc_id")
        .agg(F.count_if(F.col("toxic") == F.col("predicted")), F.count("*"))
        .first()
    )
    assert right >= 0.9 * n
