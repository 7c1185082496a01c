"""The stages against what they should do on documents made for it, and every query's schema."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from martloom.llm.common import BATCH_BYTES
from martloom.llm.queries import queries
from tests.conftest import SF_DIR
from tests.llm.data import CLASHES, edge_docs, empty_docs, texts, words
from tests.llm.test_classifiers import speech
from tests.llm.test_duplicates import WORD, roots, simhash, without_repeats
from tests.llm.test_tokens import library

SCHEMAS = {
    "op1_repair_shards": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "op2_simhash_anchors": "doc_id long, fingerprint string, component_id long",
    "op3_toxicity_nnpu": "doc_id long, held_out boolean, score double, predicted int",
    "op4_language_ecoc": "doc_id long, held_out boolean, lang_pred string, score double",
    "op5_multiprobe_ann": "query_id long, rank int, vec_id long, score double",
    "op6_substring_sketch": "doc_id long, n_words long, n_removed long, kept_sha256 string",
    "op7_pattern_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long",
    "op8_license_rules": "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double",
    "op9_bpe_automaton": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op10_quartile_digest": "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op11_importance_table": "doc_id long, n_features long, weight long, score long, rank long",
    "op12_divergence_cells": "lang string, source string, part string, item string, value long, rank int",
    "op13_shortest_pack": "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long",
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_queries_have_the_columns_they_promise(spark, name):
    found = queries()[name](spark, "/root/testdata/sf0.001")
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    want = dict(x.strip().split(" ") for x in SCHEMAS[name].split(","))
    assert {k: kinds[k] for k in want} == {k: v.replace("long", "bigint") for k, v in want.items()}
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    if name not in (
        "op5_multiprobe_ann", "op7_pattern_packing", "op12_divergence_cells", "op13_shortest_pack"
    ):
        assert found.count() == n
    assert list(queries()) == list(SCHEMAS)


def test_the_entry_lists_them():
    registered = __spark_entry__.queries()
    assert set(SCHEMAS) | {"pipeline"} <= set(registered)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Edge documents and labels that call none of them toxic."""
    path = str(tmp_path_factory.mktemp("tables"))
    edge_docs(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return path


def stage(name: str):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, folder)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        assert out.count() > 0
        assert out.where(F.col(CLASHES[0]) == "c").count() == out.count()
        assert function(spark, docs.limit(0), folder).count() == 0, name


def test_letterless_documents_go_and_others_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stage("language")(spark, docs, folder)
    want = sorted(repr(x) for x in texts() if x[1] and any(c.isalpha() for c in x[1]))
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == want
    assert kept.where("lang IS NULL").count() == 0


def test_untagged_documents_stay(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = stage("language")(spark, docs, folder)
    want = sorted(repr(x) for x in texts() if x[1] and any(c.isalpha() for c in x[1]))
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == want
    assert kept.where("lang IS NOT NULL").count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {None, -5, 1, 7, 9, 10, 11, 12, 13, 14, 15, 16}


def test_clear_predictions_replace_lang_and_ambiguous_ones_do_not(spark, monkeypatch):
    # Rows without an id are not learned from, so their lang cannot be learned by heart.
    tags = {0: "cc", 21: "cc", 33: None}
    rows = [
        (None if r.doc_id in tags else r.doc_id, r.text, tags.get(r.doc_id, r.lang), r.lang)
        for r in speech(spark).collect()
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, told string")
    kept = stage("language")(spark, docs, "").collect()
    assert len(kept) == len(rows)
    assert [(r.doc_id, r.lang, r.told) for r in kept if r.lang != r.told] == []
    train = corpus_pipeline.train_language_model
    monkeypatch.setattr(corpus_pipeline, "train_language_model", lambda d: train(d, margin=1.1))
    kept = stage("language")(spark, docs, "").collect()
    assert {(r.text, r.lang) for r in kept} == {(r[1], r[2]) for r in rows}


def test_one_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stage("near_duplicates")(spark, docs, folder).collect()
    some = texts()
    fps = [simhash(t) for _, t in some]
    edges = [(a, b) for a in range(len(some)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    root = roots(len(some), edges)
    assert len(kept) == len(set(root))
    groups = {root[some.index((r.doc_id, r.text))] for r in kept}
    assert groups == set(root)
    by_group = {r: [i for k, (i, _) in enumerate(some) if root[k] == r] for r in root}
    for r in kept:
        ids = by_group[root[some.index((r.doc_id, r.text))]]
        assert r.doc_id == min(ids, key=lambda i: (i is not None, i))


def test_passages_go_and_untouched_texts_stay_as_they_are(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = stage("repeated_passages")(spark, docs, folder).collect()
    some = texts()
    want = []
    for k, ((i, text), (kept, _, removed)) in enumerate(
        zip(some, without_repeats([t for _, t in some], 35), strict=True)
    ):
        want.append((i, kept, len(kept)) if removed else (i, text, k))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in rows), key=repr) == sorted(want, key=repr)


def test_the_whole_pipeline(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {None, -5, 1, 7, 9, 10, 11, 12, 13, 14, 15, 16}
    end = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length


def test_sequences_can_be_made_from_what_the_pipeline_returns(spark, folder):
    known = library("word_bpe_49k.json")
    rows = corpus_pipeline.run(spark, folder).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    ids: dict = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.start == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    # Texts that no stage changes, as the tokenizers library encodes them.
    for i in (7, 12, 13):
        assert ids[i] == known.encode(dict(texts())[i], add_special_tokens=False).ids + [1]


def test_toxic_documents_go(spark, tmp_path):
    rows = [(k, ("scum " if k % 8 == 0 else "") + words(k, 30, 5000)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame(
        [(k, 1, int(k % 8 == 0)) for k in range(300)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    kept = stage("toxicity")(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {k for k in range(400) if k % 8}


def test_stages_of_no_documents(spark, tmp_path):
    empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert WORD.findall("") == []


def _largest_batch(session):
    """Bytes of the largest batch of 40 MB of text that one task's worker gets."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    texts = session.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    return texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_send_whole_texts_to_python_a_few_megabytes_at_a_time(spark, folder, name):
    session = spark.newSession()
    docs = session.read.parquet(f"{folder}/documents.parquet")
    dict(corpus_pipeline.STAGES)[name](session, docs, folder)
    assert _largest_batch(session) < 5 << 20


def test_a_size_of_batches_that_the_caller_set_stays(spark, folder):
    session = spark.newSession()
    session.conf.set(BATCH_BYTES[0], "12m")
    docs = session.read.parquet(f"{folder}/documents.parquet")
    corpus_pipeline.near_duplicates(session, docs, folder)
    assert session.conf.get(BATCH_BYTES[0]) == "12m"
    assert _largest_batch(session) > 11 << 20


def test_the_pipeline_leaves_the_size_of_batches_as_it_was(spark, folder):
    session = spark.newSession()
    corpus_pipeline.run(session, folder)
    assert session.conf.get(BATCH_BYTES[0], None) is None
