"""Small tables built from Python rows, with the columns the marts read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double, "
    "l_tax double, l_receiptdate timestamp_ntz, l_shipdate timestamp_ntz, l_returnflag string",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, "
    "o_orderpriority string, o_totalprice double",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double",
    "nation": "n_nationkey int, n_regionkey int, n_name string",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey long, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_type string, p_container string, p_retailprice double, p_size int",
    "partsupp": "ps_partkey long, ps_suppkey long, ps_supplycost double",
}


def table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS[name])


def result(df: DataFrame, *keys: str) -> dict[tuple, dict]:
    """Collected rows by key; a key that occurs twice is an error."""
    found: dict[tuple, dict] = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        assert key not in found, key
        found[key] = row.asDict()
    return found
