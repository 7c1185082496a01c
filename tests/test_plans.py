"""Plans that must hold at scale: what is read, shuffled, broadcast and split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from martloom import MARTS
from martloom.plans.catalogue import catalogue, mart
from martloom.sources.testdata import load
from tests.conftest import SF_DIR
from tests.rows import table


def plan(df, executed: bool = False) -> str:
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)


@pytest.fixture
def no_broadcast(spark):
    """Dimensions too big to broadcast, as customers, parts and suppliers are at scale."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(catalogue()))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalogue()[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scans_read_only_needed_columns(spark):
    text = plan(mart(spark, SF_DIR, "orders"))
    schemas = re.findall(r"FileScan parquet \[(.*?)\]", text)
    assert [re.sub(r"#\d+L?", "", s) for s in schemas] == [
        "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
        "c_custkey,c_nationkey",
        "n_nationkey,n_name",
    ]
    assert "PushedFilters: [IsNotNull(c_custkey)]" in text


def test_lines_are_combined_before_their_only_shuffle(spark):
    text = plan(mart(spark, SF_DIR, "lineitems", order="file"))
    assert exchanges(text) == ["hashpartitioning"]
    assert text.index("Exchange") < text.index("partial_count")
    assert exchanges(plan(mart(spark, SF_DIR, "lineitems"))) == ["rangepartitioning", "hashpartitioning"]


def test_bucketed_lines_need_no_shuffle(spark, tmp_path):
    lines = load(spark, SF_DIR, "lineitem")
    (
        lines.write.bucketBy(8, "l_orderkey")
        .option("path", f"{tmp_path}/lines")
        .saveAsTable("bucketed_lines")
    )
    try:
        built = MARTS["lineitems"].build(spark.table("bucketed_lines"), scale=2, order="file")
        assert exchanges(plan(built)) == []
        expected = mart(spark, SF_DIR, "lineitems")
        assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.sql("DROP TABLE bucketed_lines")


def test_bucketed_orders_and_customers_join_in_place(spark, no_broadcast, tmp_path):
    keys = {"orders": "o_custkey", "customer": "c_custkey"}
    for name, key in keys.items():
        (
            load(spark, SF_DIR, name)
            .write.bucketBy(8, key)
            .option("path", f"{tmp_path}/{name}")
            .saveAsTable(f"bucketed_{name}")
        )
    try:
        built = MARTS["orders"].build(
            spark.table("bucketed_orders"),
            spark.table("bucketed_customer"),
            load(spark, SF_DIR, "nation"),
            scale=2,
        )
        text = plan(built)
        assert "SortMergeJoin [o_custkey" in text
        assert not re.search(r"hashpartitioning\([oc]_custkey", text)
        expected = mart(spark, SF_DIR, "orders")
        assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))
    finally:
        for name in keys:
            spark.sql(f"DROP TABLE bucketed_{name}")


@pytest.mark.parametrize("name", ["customers", "suppliers"])
def test_facts_shrink_before_they_meet_the_dimension(spark, no_broadcast, name):
    """Raw facts cross one shuffle, already combined; every join sees groups only."""
    text = plan(mart(spark, SF_DIR, name))
    fact = {"customers": "customer.parquet", "suppliers": "supplier.parquet"}[name]
    below = text[: text.index(fact)].rsplit("Join", 1)[1]
    assert below.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["customers", "suppliers"])
def test_one_range_shuffle_serves_merge_and_sort(spark, name):
    text = plan(mart(spark, SF_DIR, name))
    assert exchanges(text) == ["rangepartitioning", "hashpartitioning"]


@pytest.mark.parametrize("name", sorted(MARTS))
def test_nothing_is_broadcast_but_by_its_size(spark, no_broadcast, name):
    """No mart forces a broadcast: with the size limit off, none is left."""
    text = plan(mart(spark, SF_DIR, name), executed=True)
    assert "Broadcast" not in text


def test_parts_meet_the_supplies_last(spark, no_broadcast):
    """Wide part rows are shuffled once per part, not once per part and supplier."""
    text = plan(mart(spark, SF_DIR, "parts"))
    keys = re.findall(r"SortMergeJoin \[(\w+)#", text)
    assert keys == ["s_nationkey", "ps_partkey", "ps_suppkey"]


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(catalogue()["dedup_latest"](spark, SF_DIR))
    final, partial = text.split("Exchange hashpartitioning")
    assert "1, Final" in final and "1, Partial" in partial


def test_all_rules_are_counted_in_one_scan_and_one_shuffle(spark, no_broadcast):
    text = plan(catalogue()["validate_rules"](spark, SF_DIR))
    assert text.count("lineitem.parquet") == text.count("orders.parquet") == 1
    assert "Join" not in text
    # Keys are counted in the map tasks and shuffled once; then one row is left for each task.
    assert exchanges(text) == ["SinglePartition", "hashpartitioning"]
    assert text.index("partial_sum(n", text.index("hashpartitioning")) > 0


@pytest.fixture(params=["0", "64MB"], ids=["sort", "hash"])
def small_skew_limits(request, spark, no_broadcast):
    """Limits at which small tables count as skewed, with sort-merge and hash joins."""
    limits = {
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": request.param,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def spread(df, partitions=16):
    return df.repartition(partitions, F.rand(1))


@pytest.mark.parametrize("hot", ["7", "null"])
def test_hot_customer_is_split(spark, small_skew_limits, hot):
    orders = spark.range(60_000).selectExpr(
        "id AS o_orderkey",
        f"IF(id % 3 = 0, {hot}, id % 1000) AS o_custkey",
        "date_add(DATE'1995-01-01', CAST(id % 700 AS INT)) AS o_orderdate",
        "element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus",
        "concat(id % 5, '-P') AS o_orderpriority",
        "CAST(id AS DOUBLE) AS o_totalprice",
    )
    customer = spark.range(1000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey")
    nation = table(spark, "nation", [(i, 0, f"N{i}") for i in range(25)])
    built = MARTS["orders"].build(spread(orders), customer, nation, scale=2, order="none")
    assert "Join(skew=true) [o_custkey" in plan(built, executed=True)
    summed = built.groupBy("N_NAME").agg(F.sum("orders_count").alias("n"))
    per_nation = {r.N_NAME: r.n for r in summed.collect()}
    cold = {f"N{i}": 0 for i in range(25)}
    for i in range(60_000):
        if i % 3:
            cold[f"N{i % 1000 % 25}"] += 1
    hot_name = "N7" if hot == "7" else None
    cold[hot_name] = cold.get(hot_name, 0) + 20_000
    assert per_nation == cold


@pytest.mark.parametrize("hot", ["ps_suppkey", "ps_partkey"])
def test_hot_supplier_or_part_is_split(spark, small_skew_limits, hot):
    supplies = spark.range(60_000).selectExpr(
        "id % 2000 AS ps_partkey", "id % 500 AS ps_suppkey", "CAST(id AS DOUBLE) AS ps_supplycost", "id"
    )
    supplies = supplies.withColumn(hot, F.expr(f"IF(id % 3 = 0, 7, {hot})")).drop("id")
    part = spark.range(2000).selectExpr(
        "id AS p_partkey",
        "concat('T', id % 4) AS p_type",
        "'C' AS p_container",
        "CAST(id AS DOUBLE) AS p_retailprice",
        "CAST(id % 50 AS INT) AS p_size",
    )
    supplier = spark.range(500).selectExpr("id AS s_suppkey", "CAST(id % 5 AS INT) AS s_nationkey")
    nation = table(spark, "nation", [(i, 0, f"N{i}") for i in range(5)])
    built = MARTS["parts"].build(part, spread(supplies), supplier, nation, scale=2, order="none")
    assert f"Join(skew=true) [{hot}" in plan(built, executed=True)
    expected: dict[tuple, list] = {}
    for i in range(60_000):
        keys = {"ps_partkey": i % 2000, "ps_suppkey": i % 500}
        if i % 3 == 0:
            keys[hot] = 7
        group = (f"N{keys['ps_suppkey'] % 5}", f"T{keys['ps_partkey'] % 4}")
        totals = expected.setdefault(group, [0, 0, 0.0])
        totals[0] += 1
        totals[1] += keys["ps_partkey"] % 50
        totals[2] += i
    found = {(r.N_NAME, r.P_TYPE): (r.parts_count, r.size, r.avg_supplycost) for r in built.collect()}
    assert found == {k: (n, size, cost / n) for k, (n, size, cost) in expected.items()}
