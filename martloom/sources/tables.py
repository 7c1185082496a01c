"""Reading raw tables: one parquet file or directory per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(base: str, name: str, suffix: str = ".parquet") -> str:
    return f"{base.rstrip('/')}/{name}{suffix}"


def read_table(spark: SparkSession, base: str, name: str, suffix: str = ".parquet") -> DataFrame:
    """Scan one table under any path Spark can reach.

    Types come from the files: a declared type that differs from the file's would
    fail only when rows are read. ``contracts.check_input`` compares them up front.
    """
    return spark.read.parquet(table_path(base, name, suffix))
