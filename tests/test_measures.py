"""Exact totals, or an error: never a rounded or wrapped one."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom.operators.measures import Measure
from martloom.plans.marts import mart_customers, mart_lineitems_core

LINES = (
    "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string"
)


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def averages(spark, values, scale):
    """Taken in two steps, the second over two partial rows."""
    df = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values)], "k int, v double")
    measure = Measure("v", scale)
    parts = df.groupBy("k").agg(*measure.first())
    return parts.agg(*measure.merge()).select(measure.total, measure.average).first()


def test_rates_and_money_have_scales_of_their_own(spark):
    lines = spark.createDataFrame(
        [(1, 1, 10.25, 0.055, 0.005, "A"), (1, 2, 1.5, 0.055, 0.005, "R")], LINES
    )
    scale = {"l_extendedprice": 2, "l_discount": 3, "l_tax": 3}
    (row,) = mart_lineitems_core(lines, scale=scale).collect()
    assert (row.sum_extendprice, row.mean_discount, row.mean_tax) == (11.75, 0.055, 0.005)
    (row,) = mart_lineitems_core(lines, scale={"l_extendedprice": 2}).collect()
    assert (row.sum_extendprice, row.mean_tax) == (11.75, 0.005)


def test_more_decimals_than_declared_raise(spark, ansi):
    lines = spark.createDataFrame([(1, 1, 10.25, 0.05, 0.005, "A")], LINES)
    with pytest.raises(PySparkException, match="l_tax is not a number of at most 2 decimals: 0.005"):
        mart_lineitems_core(lines, scale=2).collect()


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf"), 0.005, 1e300])
def test_a_value_that_does_not_fit_raises(spark, ansi, bad):
    with pytest.raises(PySparkException, match="at most 2 decimals"):
        averages(spark, [5.0, bad], 2)


@pytest.mark.parametrize("values", [[4e16] * 3, [4e16] * 6, [9e16, 1.0, 9e16]])
def test_a_total_beyond_a_long_raises(spark, ansi, values):
    with pytest.raises(PySparkException, match="does not fit a long"):
        averages(spark, values, 2)


def test_no_value_gives_null_and_doubles_are_left_alone(spark, ansi):
    assert tuple(averages(spark, [None, None], 2)) == (None, None)
    assert tuple(averages(spark, [1.25, None, -0.25], 2)) == (1.0, 0.5)
    total, _ = averages(spark, [float("nan"), 1.0], None)
    assert total != total


def test_customers_with_an_infinite_balance(spark, ansi):
    customer = spark.createDataFrame(
        [(1, 1, "A", float("nan")), (2, 1, "A", 5.0)],
        "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double",
    )
    nation = spark.createDataFrame([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string")
    with pytest.raises(PySparkException, match="c_acctbal"):
        mart_customers(customer, nation, region, scale=2).collect()
    (row,) = mart_customers(customer, nation, region).select(F.isnan("avg_acctbal")).collect()
    assert row[0]


def awkward(seed: int, n: int = 600) -> list[float]:
    """Money, rates, tiny and large values of both signs that nearly cancel."""
    r = random.Random(seed)
    values = [round(r.uniform(-1e6, 1e6), 2) for _ in range(n)]
    values += [r.uniform(0, 0.1) for _ in range(n)]
    values += [r.uniform(-1, 1) * 10.0 ** r.randrange(-15, 22) for _ in range(n)]
    values += [-x for x in values[: n // 2]]
    # Of one sign in every second case, as prices are.
    return [abs(x) for x in values] if seed % 2 else values


def ulps(a: float, b: float) -> float:
    return abs(a - b) / math.ulp(b)


@pytest.mark.parametrize("seed", range(6))
def test_doubles_add_up_to_the_same_bits_however_they_are_spread(spark, ansi, seed):
    values = awkward(seed)
    df = spark.createDataFrame([(k % 5, v) for k, v in enumerate(values)], "k int, v double")
    found = set()
    for partitions in (1, 7, 200):
        spread = df.repartition(partitions, F.rand(partitions + seed))
        measure = Measure("v")
        groups = spread.groupBy("k").agg(*measure.first())
        rows = groups.select("k", measure.total, measure.average).collect()
        (merged,) = groups.agg(*measure.merge()).select(measure.total).collect()
        found.add((tuple(sorted(map(tuple, rows))), merged[0]))
    ((rows, merged),) = found
    assert ulps(merged, float(sum(map(Fraction, values)))) <= 1
    for k, total, average in rows:
        own = values[k::5]
        assert ulps(total, float(sum(map(Fraction, own)))) <= 1
        assert average == total / len(own)


def test_sums_that_a_double_holds_are_exact(spark):
    for values in ([0.1], [-0.1, 0.1], [1e22, 1.0, -1e22], [2.0**76, 2.0**30], [3.0] * 9, [-5e-324, 1.5]):
        total, _ = averages(spark, values, None)
        assert total == math.fsum(values)
    assert averages(spark, [2.0**-104, -1.0, 1.0], None)[0] == 2.0**-104


def test_values_beyond_the_digits_are_added_all_the_same(spark, ansi):
    inf = float("inf")
    assert tuple(averages(spark, [None], None)) == (None, None)
    assert averages(spark, [1e300, 1.0], None)[0] == 1e300
    assert averages(spark, [inf, 1.0], None)[0] == inf
    assert math.isnan(averages(spark, [inf, -inf, 2.0], None)[0])


def test_a_digit_that_overflows_raises(spark, ansi):
    measure = Measure("v")
    parts = spark.createDataFrame([(1.0,)], "v double").groupBy("v").agg(*measure.first())
    full = parts.withColumn("v__sum4", F.lit((1 << 63) - 1)).unionAll(parts)
    with pytest.raises(PySparkException, match="does not fit a long"):
        full.agg(*measure.merge()).select(measure.total).collect()


def test_marts_without_a_scale_are_the_same_bits_however_they_are_spread(spark):
    r = random.Random(8)
    lines = [
        (k % 40, k, r.uniform(1, 1e5), r.uniform(0, 0.1), r.uniform(0, 0.08), "ARN"[k % 3])
        for k in range(3000)
    ]
    df = spark.createDataFrame(lines, LINES)
    results = {
        tuple(sorted(map(tuple, mart_lineitems_core(df.repartition(n, F.rand(n))).collect())))
        for n in (1, 7, 200)
    }
    assert len(results) == 1
