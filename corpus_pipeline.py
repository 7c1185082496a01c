"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept and, but for the last, returns the columns of documents.
A stage called by itself leaves the session with batches of a few MB to Python, if it had no size for them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.chunk_encoder import word_bpe
from martloom.llm.common import BATCH_BYTES, bound_batches, documents, scratch_dir
from martloom.llm.language_ecoc import has_letter, language_of, train_language_model
from martloom.llm.pattern_packing import pack_documents
from martloom.llm.simhash_anchors import simhash_groups
from martloom.llm.substring_sketch import remove_repeated_windows
from martloom.llm.toxicity_nnpu import learn_from_labels, toxicity_of

TOXIC_FROM = 0.5


def _row(docs: DataFrame) -> Column:
    """Each row as one column, so that no name can clash with a stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _fields(docs: DataFrame, struct: str, **new: Column) -> list[Column]:
    """The columns of documents out of a struct, some of them with new values."""
    return [new.get(c, F.col(f"{struct}.`{c}`")).alias(c) for c in docs.columns]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """Whole texts go to Python a few MB at a time, also when the result is written."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


@_in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not scored as toxic; without labels to learn from, all."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn_from_labels(docs, labels, training=F.lit(True))
    return docs.where(toxicity_of(F.col("text"), model) < TOXIC_FROM)


@_in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter in their text, ``lang`` being what their text is told to be.

    A clear prediction replaces ``lang``, or fills it in. Where the prediction is ambiguous, ``lang``
    stays as it is, NULL too. Without any ``lang`` to learn from, every row's stays as it is. The
    few texts that the model learned from are told much as they are tagged.
    """
    docs = docs.where(has_letter("text"))
    model = train_language_model(docs)
    if not model.languages:
        return docs
    told = docs.select(_row(docs).alias("row"), language_of(F.col("text"), model).alias("told"))
    lang = F.when(F.col("told.ambiguous"), F.col("row.lang")).otherwise(F.col("told.lang"))
    return told.select(_fields(docs, "row", lang=lang))


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, of these the smallest text hash."""
    identity = F.struct(F.col("doc_id"), F.xxhash64("text").alias("mark"))
    groups = simhash_groups(docs.select(identity.alias("id"), "text"), id_col="id")
    first = groups.where(F.col("id").eqNullSafe(F.col("component_id"))).select("id.*").distinct()
    kept = (
        docs.select(_row(docs).alias("row"), F.col("doc_id"), F.xxhash64("text").alias("mark"))
        .alias("d")
        .join(
            first.alias("f"),
            F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.mark") == F.col("f.mark")),
            "left_semi",
        )
    )
    # Rows equal in id and text are copies of each other: the first of them stays.
    copies = Window.partitionBy("doc_id", "mark").orderBy(F.xxhash64("row"))
    numbered = kept.withColumn("copy", F.row_number().over(copies))
    return numbered.where("copy = 1").select("row.*")


@_in_small_batches
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur elsewhere too.

    The other words keep the white space that follows them, line breaks and indentation too; white
    space at the edges of a changed document may go.
    """
    rows = docs.select(_row(docs).alias("row"), F.col("doc_id"), F.col("text"))
    cleaned = remove_repeated_windows(rows, keep_space=True)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("doc.row.text"))
    n_chars = F.when(changed, F.length("kept").cast("long")).otherwise(F.col("doc.row.n_chars"))
    return cleaned.select(_fields(docs, "doc.row", text=text, n_chars=n_chars))


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its token ids and its place in a training sequence."""
    return pack_documents(docs, word_bpe(), end_id=1, keep_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: The stages learn models, compare fingerprints and cut texts by token, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stage's result stored before the next."""
    base = scratch_dir(spark)
    docs = documents(spark, sf_dir)
    bounded = bound_batches(spark)
    try:
        for n, (name, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(path := f"{base}/{n}-{name}")
            docs = spark.read.parquet(path)
    finally:
        if bounded:
            spark.conf.unset(BATCH_BYTES[0])
    return docs
