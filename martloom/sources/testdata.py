"""Stand-ins for three inputs the supplied test tables lack.

``l_receiptdate``, ``p_container`` and the whole ``partsupp`` table are synthetic:
deterministic expressions over the columns that exist. Only test, bench and oracle
runs use this module; the marts know nothing of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.tables import read_table

# TPC-H container words.
CONTAINER_SIZES = ("SM", "MED", "LG", "JUMBO", "WRAP")
CONTAINER_KINDS = ("CASE", "BOX", "BAG", "JAR", "PKG", "PACK", "CAN", "DRUM")


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A raw table with the columns the marts expect."""
    if name == "partsupp":
        return partsupp(read_table(spark, base, "lineitem"))
    df = read_table(spark, base, name)
    if name == "lineitem":
        return df.withColumn("l_receiptdate", _receipt_date())
    if name == "part":
        return df.withColumn("p_container", _container())
    return df


def partsupp(lineitem: DataFrame) -> DataFrame:
    """One row per (part, supplier) pair seen on a line."""
    return (
        lineitem.select(
            F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
        )
        .distinct()
        .withColumn(
            "ps_supplycost",
            (100 + (F.col("ps_partkey") * 31 + F.col("ps_suppkey") * 17) % 99901).cast("double")
            / 100,
        )
    )


def _receipt_date() -> Column:
    days = 1 + (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 30
    return F.col("l_shipdate") + F.make_dt_interval(days=days.cast("int"))


def _container() -> Column:
    size = _word(CONTAINER_SIZES, F.col("p_partkey"))
    kind = _word(CONTAINER_KINDS, F.floor(F.col("p_partkey") / 5))
    return F.concat(size, F.lit(" "), kind)


def _word(words: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (number % len(words) + 1).cast("int"))
