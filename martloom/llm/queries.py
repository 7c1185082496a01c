"""The operators of this package as queries over a folder of parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.bpe_automaton import encode_with_automaton
from martloom.llm.chunk_encoder import byte_bpe, word_bpe
from martloom.llm.common import documents, fold, scratch_dir
from martloom.llm.importance_resampling import Features, resample
from martloom.llm.language_ecoc import identify_languages, train_language_model
from martloom.llm.license_rules import scan_licenses
from martloom.llm.multiprobe_ann import nearest_neighbours
from martloom.llm.pattern_packing import pack_documents
from martloom.llm.quartile_digest import digest_documents
from martloom.llm.shortest_pack import pack_shortest_first
from martloom.llm.simhash_anchors import simhash_groups
from martloom.llm.source_divergence import audit_sources
from martloom.llm.substring_sketch import remove_repeated_windows
from martloom.llm.token_shards import read_token_shards, write_token_shards
from martloom.llm.toxicity_nnpu import learn_from_labels, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/shards"
    write_token_shards(documents(spark, sf_dir), path, byte_bpe(), end_id=2)
    return read_token_shards(spark, path).select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), shingle=4, distance=4)


def op3_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = learn_from_labels(docs, labels, training=~held_out)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", predicted
    )


def op4_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = train_language_model(docs.where(~held_out))
    found = identify_languages(docs, model)
    return found.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous"
    )


def op5_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, F.col("vec_id") % 50 == 0, nearest=5)


def op6_substring_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(documents(spark, sf_dir)).select(
        "doc.doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), word_bpe(), end_id=1)


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    found = scan_licenses(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"),
        joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", "detections.label")).alias("labels"),
        "score",
    )


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return encode_with_automaton(docs, byte_bpe(), decoded=True).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir))


def op11_importance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(
        documents(spark, sf_dir),
        target,
        percent=25,
        least_words=20,
        seed=7,
        features=Features(longest=2, buckets=10_000),
    )


def op12_divergence_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(documents(spark, sf_dir), least_docs=3, most_terms=200)


def op13_shortest_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_shortest_first(documents(spark, sf_dir), byte_bpe(), end_id=0, capacity=1024).drop(
        "ids"
    )


def queries() -> dict[str, Query]:
    return {
        "op1_repair_shards": op1_repair_shards,
        "op2_simhash_anchors": op2_simhash_anchors,
        "op3_toxicity_nnpu": op3_toxicity_nnpu,
        "op4_language_ecoc": op4_language_ecoc,
        "op5_multiprobe_ann": op5_multiprobe_ann,
        "op6_substring_sketch": op6_substring_sketch,
        "op7_pattern_packing": op7_pattern_packing,
        "op8_license_rules": op8_license_rules,
        "op9_bpe_automaton": op9_bpe_automaton,
        "op10_quartile_digest": op10_quartile_digest,
        "op11_importance_table": op11_importance_table,
        "op12_divergence_cells": op12_divergence_cells,
        "op13_shortest_pack": op13_shortest_pack,
    }


#: Windows as texts; a row number stands for the document, so that ids may repeat or be NULL.
OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
    [w FOR w IN string_split_regex(coalesce(text, ''), '[\t-\r ]+') IF w <> ''] AS words
  FROM documents),
windows AS (
  SELECT d, i, array_to_string(words[i:i + 34], ' ') AS w
  FROM (SELECT d, words, unnest(range(1, len(words) - 33)) AS i FROM docs)),
repeated AS (
  SELECT d, i FROM windows
  WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
gone AS (SELECT DISTINCT d, i + k AS i FROM repeated, range(35) r(k)),
placed AS (
  SELECT d, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (
  SELECT d, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM placed ANTI JOIN gone USING (d, i) GROUP BY d)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (d)"""


#: The checksum by its polynomial, over the bytes of a term.
OP11_SQL = r"""
WITH crc(t) AS (
  SELECT [list_reduce([i] || range(8), lambda c, k:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR i IN range(256)]),
docs AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
target AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
found AS (
  SELECT d, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM docs
  UNION ALL
  SELECT NULL, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM target),
counted AS (SELECT d, f, count(*) AS n FROM found GROUP BY d, f),
spelt AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
hashed AS (
  SELECT f, xor(list_reduce([4294967295] || [
      (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1
      FOR i IN range(len(x) // 2)],
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM spelt, crc),
placed AS (SELECT d, n, bucket FROM counted JOIN hashed USING (f)),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (d IS NOT NULL), 0) AS s,
    coalesce(sum(n) FILTER (d IS NULL), 0) AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM sums, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums)),
weighed AS (
  SELECT d, CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE d IS NOT NULL GROUP BY d),
scored AS (
  SELECT doc_id, len(w) AS n_words, 2 * len(w) - CASE WHEN len(w) > 0 THEN 1 ELSE 0 END AS n_features,
    coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (d)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
    count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank
FROM ranked"""

OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs
  FROM (SELECT d, lang, source, unnest(w) AS term FROM docs) GROUP BY lang, source, term),
kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
in_group AS (SELECT lang, source, term, c.n FROM counts c JOIN kept USING (lang, term)),
totals AS (SELECT lang, source, sum(n) AS total FROM in_group GROUP BY lang, source),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT lang, source, term, coalesce(i.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(i.n, 0) + 1) // (coalesce(t.total, 0) + v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + v) AS q
  FROM groups JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN in_group i USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
every_pair AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source),
rated AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM rated)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    """Where DuckDB can say it: tokenizers, XXH64, learned models and searches it cannot."""
    return {
        "op6_substring_sketch": OP6_SQL,
        "op11_importance_table": OP11_SQL,
        "op12_divergence_cells": OP12_SQL,
    }
