"""What the supplied tables cannot show: NULLs, orphans, duplicates, odd dates, types."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import CONTRACTS, MARTS
from martloom.contracts import check_input, conform, input_issues, schema_issues
from martloom.plans.catalogue import mart
from martloom.sources.testdata import load
from tests.conftest import SF_DIR
from tests.rows import SCHEMAS, result, table

NATIONS = [(1, 1, "N1"), (2, 1, "N2"), (3, 9, "N3")]
REGIONS = [(1, "R1")]
DAY = datetime(1995, 1, 10)


def customers(spark, rows, nations=NATIONS, regions=REGIONS):
    built = MARTS["customers"].build(
        table(spark, "customer", rows),
        table(spark, "nation", nations),
        table(spark, "region", regions),
    )
    return result(built, "R_NAME", "N_NAME", "C_MKTSEGMENT")


def suppliers(spark, rows, nations=NATIONS, regions=REGIONS):
    built = MARTS["suppliers"].build(
        table(spark, "supplier", rows),
        table(spark, "nation", nations),
        table(spark, "region", regions),
    )
    return result(built, "R_NAME", "N_NAME")


def orders(spark, rows, customer=((1, 1, "S", 0.0),), nations=NATIONS):
    built = MARTS["orders"].build(
        table(spark, "orders", rows),
        table(spark, "customer", list(customer)),
        table(spark, "nation", nations),
    )
    return result(built, "O_MONTH", "N_NAME", "O_ORDERPRIORITY")


def parts(spark, part, partsupp, supplier, nations=NATIONS):
    built = MARTS["parts"].build(
        table(spark, "part", part),
        table(spark, "partsupp", partsupp),
        table(spark, "supplier", supplier),
        table(spark, "nation", nations),
    )
    return result(built, "N_NAME", "P_TYPE", "P_CONTAINER")


def lines(spark, rows, **options):
    built = MARTS["lineitems"].build(table(spark, "lineitem", rows), **options)
    return result(built, "L_ORDERKEY")


def test_customers_keep_unknown_nations_and_regions(spark):
    found = customers(spark, [(1, 1, "S", 5.0), (2, 99, "S", 7.0), (3, None, "S", 1.0), (4, 3, "S", 2.0)])
    assert set(found) == {("R1", "N1", "S"), (None, None, "S"), (None, "N3", "S")}
    unknown = found[(None, None, "S")]
    assert unknown["unique_customers_count"] == 2
    assert unknown["avg_acctbal"] == unknown["mean_acctbal"] == 4.0
    assert (unknown["min_acctbal"], unknown["max_acctbal"]) == (1.0, 7.0)


def test_suppliers_drop_unknown_nations_and_regions(spark):
    found = suppliers(spark, [(1, 1, 5.0), (2, 99, 7.0), (3, None, 1.0), (4, 3, 2.0)])
    assert set(found) == {("R1", "N1")}
    assert found[("R1", "N1")]["unique_supplers_count"] == 1


def test_null_measures_are_ignored_and_null_keys_not_counted(spark):
    found = customers(spark, [(1, 1, "S", None), (None, 1, "S", 4.0), (3, 2, "S", None)])
    assert found[("R1", "N1", "S")]["unique_customers_count"] == 1
    assert found[("R1", "N1", "S")]["avg_acctbal"] == 4.0
    empty = found[("R1", "N2", "S")]
    assert [empty[c] for c in ("avg_acctbal", "mean_acctbal", "min_acctbal", "max_acctbal")] == [None] * 4


def test_duplicate_nation_rows_multiply(spark):
    twice = [*NATIONS, NATIONS[0]]
    found = customers(spark, [(1, 1, "S", 5.0), (2, 2, "S", 7.0)], twice)
    assert found[("R1", "N1", "S")]["unique_customers_count"] == 2
    assert found[("R1", "N1", "S")]["avg_acctbal"] == 5.0
    assert found[("R1", "N2", "S")]["unique_customers_count"] == 1
    assert suppliers(spark, [(1, 1, 5.0)], twice)[("R1", "N1")]["unique_supplers_count"] == 2


def test_same_nation_name_in_two_regions(spark):
    nations, regions = [(1, 1, "N"), (2, 2, "N")], [(1, "R1"), (2, "R2")]
    assert set(customers(spark, [(1, 1, "S", 1.0), (2, 2, "S", 2.0)], nations, regions)) == {
        ("R1", "N", "S"),
        ("R2", "N", "S"),
    }
    assert set(suppliers(spark, [(1, 1, 1.0), (2, 2, 2.0)], nations, regions)) == {
        ("R1", "N"),
        ("R2", "N"),
    }
    merged = orders(
        spark,
        [(1, 1, DAY, "F", "P", 1.0), (2, 2, DAY, "O", "P", 4.0)],
        [(1, 1, "S", 0.0), (2, 2, "S", 0.0)],
        nations,
    )
    assert list(merged) == [("1995-01", "N", "P")]
    row = merged[("1995-01", "N", "P")]
    assert (row["orders_count"], row["sum_order_price"], row["avg_order_price"]) == (2, 5.0, 2.5)
    merged = parts(
        spark,
        [(1, "T", "C", 10.0, 10)],
        [(1, 1, 2.0), (1, 2, 4.0)],
        [(1, 1, 0.0), (2, 2, 0.0)],
        nations,
    )
    assert merged[("N", "T", "C")]["parts_count"] == 2


def test_orders_without_customer_or_date(spark):
    found = orders(
        spark,
        [
            (1, 1, datetime(1995, 1, 31, 23, 59, 59), "F", "P", 1.0),
            (2, 77, DAY, "O", "P", 2.0),
            (3, None, DAY, "P", "P", 3.0),
            (4, 1, None, None, "P", 4.0),
            (None, 1, DAY, "X", "P", None),
        ],
    )
    assert set(found) == {("1995-01", "N1", "P"), ("1995-01", None, "P"), (None, "N1", "P")}
    known, unknown = found[("1995-01", "N1", "P")], found[("1995-01", None, "P")]
    assert known["orders_count"] == 1 and known["sum_order_price"] == 1.0
    assert (known["f_order_status"], known["o_order_status"], known["p_order_status"]) == (1, 0, 0)
    assert unknown["orders_count"] == 2 and unknown["avg_order_price"] == 2.5
    assert (unknown["f_order_status"], unknown["o_order_status"], unknown["p_order_status"]) == (0, 1, 1)
    undated = found[(None, "N1", "P")]
    assert undated["f_order_status"] == undated["o_order_status"] == undated["p_order_status"] == 0


def test_orders_of_duplicate_customers_multiply(spark):
    found = orders(spark, [(1, 1, DAY, "F", "P", 3.0)], [(1, 1, "S", 0.0), (1, 2, "S", 0.0)])
    assert {key[1]: row["orders_count"] for key, row in found.items()} == {"N1": 1, "N2": 1}


def test_line_counts_and_flags(spark):
    found = lines(
        spark,
        [
            (1, None, 1.0, None, 0.1, DAY, DAY, "A"),
            (1, 5, 2.0, None, 0.3, DAY, DAY, "R"),
            (2, 5, None, 0.5, None, DAY, DAY, None),
            (2, 5, None, None, None, DAY, DAY, "X"),
        ],
    )
    first, second = found[(1,)], found[(2,)]
    assert (first["count"], first["sum_extendprice"], first["mean_discount"]) == (1, 3.0, None)
    assert first["mean_tax"] == pytest.approx(0.2)
    assert (first["A_return_flags"], first["R_return_flags"], first["N_return_flags"]) == (1, 1, 0)
    assert (second["count"], second["sum_extendprice"], second["mean_discount"]) == (2, None, 0.5)
    assert (second["A_return_flags"], second["R_return_flags"], second["N_return_flags"]) == (0, 0, 0)


def test_all_null_order_key_is_a_group(spark):
    found = lines(spark, [(None, 1, 1.0, 0.1, 0.1, DAY, DAY, "N")] * 2)
    assert found[(None,)]["count"] == 2


def test_delivery_days(spark):
    found = lines(
        spark,
        [
            (1, 1, 1.0, 0.0, 0.0, datetime(1995, 1, 7), DAY, "N"),
            (1, 1, 1.0, 0.0, 0.0, None, DAY, "N"),
            (2, 1, 1.0, 0.0, 0.0, datetime(1995, 1, 11, 0, 1), datetime(1995, 1, 10, 23, 59), "N"),
            (3, 1, 1.0, 0.0, 0.0, None, None, "N"),
        ],
    )
    assert [found[(k,)]["delivery_days"] for k in (1, 2, 3)] == [-3.0, 1.0, None]


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_every_date_like_type(spark, kind):
    text = spark.createDataFrame(
        [(1, 1, "1995-01-31 23:59:59", "F", "P", 1.0)],
        SCHEMAS["orders"].replace("timestamp_ntz", "string"),
    )
    typed = text.withColumn("o_orderdate", F.col("o_orderdate").cast(kind))
    built = MARTS["orders"].build(
        typed, table(spark, "customer", [(1, 1, "S", 0.0)]), table(spark, "nation", NATIONS)
    )
    assert [r.O_MONTH for r in built.collect()] == ["1995-01"]
    shipped = spark.createDataFrame(
        [(1, 1, 1.0, 0.0, 0.0, "1995-02-02 00:01:00", "1995-01-31 23:59:59", "N")],
        SCHEMAS["lineitem"].replace("timestamp_ntz", "string"),
    ).withColumns({c: F.col(c).cast(kind) for c in ("l_receiptdate", "l_shipdate")})
    assert result(MARTS["lineitems"].build(shipped), "L_ORDERKEY")[(1,)]["delivery_days"] == 2.0


def test_bad_date_text_is_null_and_does_not_abort(spark):
    bad = spark.createDataFrame(
        [(1, 1, "1995-13-45", "F", "P", 1.0), (2, 1, "soon", "F", "P", 1.0)],
        SCHEMAS["orders"].replace("timestamp_ntz", "string"),
    )
    built = MARTS["orders"].build(
        bad, table(spark, "customer", [(1, 1, "S", 0.0)]), table(spark, "nation", NATIONS)
    )
    assert [(r.O_MONTH, r.orders_count) for r in built.collect()] == [(None, 2)]


def test_parts_count_pairs_and_drop_unmatched(spark):
    found = parts(
        spark,
        [(1, "T", "C", 10.0, 10), (2, "T", "C", 99.0, 1), (3, "T", "D", 7.0, 3)],
        [(1, 1, 2.0), (1, 2, 4.0), (3, 3, 1.0), (3, 4, 1.0), (8, 1, 9.0), (3, None, 1.0)],
        [(1, 1, 0.0), (2, 1, 0.0), (3, 99, 0.0)],
    )
    assert set(found) == {("N1", "T", "C")}
    row = found[("N1", "T", "C")]
    assert (row["parts_count"], row["size"]) == (2, 20)
    assert row["avg_retailprice"] == row["mean_retailprice"] == 10.0
    assert row["avg_supplycost"] == row["mean_supplycost"] == 3.0
    assert (row["min_supplycost"], row["max_supplycost"]) == (2.0, 4.0)


@pytest.mark.parametrize("name", sorted(MARTS))
def test_empty_inputs_give_no_rows_and_the_contract(spark, name):
    built = MARTS[name]({t: table(spark, t, []) for t in MARTS[name].inputs})
    assert schema_issues(built.schema, CONTRACTS[name]) == []
    assert built.count() == 0


@pytest.mark.parametrize("scale", [None, 2])
@pytest.mark.parametrize("name", sorted(MARTS))
def test_decimal_inputs_in_upper_case_keep_the_contract(spark, name, scale):
    def as_decimals(df):
        return df.select(
            *[
                (F.col(c).cast("decimal(12,2)") if t == "double" else F.col(c)).alias(c.upper())
                for c, t in df.dtypes
            ]
        )

    plain = {t: load(spark, SF_DIR, t) for t in MARTS[name].inputs}
    tables = {t: as_decimals(df) for t, df in plain.items()}
    built = MARTS[name](tables, scale=scale)
    assert schema_issues(built.schema, CONTRACTS[name]) == []
    expected = MARTS[name](plain, scale=2)
    assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("name", sorted(MARTS))
def test_double_and_exact_sums_agree(spark, name):
    keys = [f.name for f in CONTRACTS[name] if f.dataType.simpleString() == "string"]
    keys = keys or ["L_ORDERKEY"]
    tables = {t: load(spark, SF_DIR, t) for t in MARTS[name].inputs}
    exact = result(MARTS[name](tables, scale=2), *keys)
    double = result(MARTS[name](tables), *keys)
    assert set(exact) == set(double)
    numbers = [c for c in CONTRACTS[name].names if c not in keys]
    for key, row in exact.items():
        expected = [row[c] for c in numbers]
        assert [double[key][c] for c in numbers] == pytest.approx(expected, rel=1e-9), key


@pytest.mark.parametrize("name", sorted(MARTS))
def test_layouts_hold_the_same_rows(spark, name):
    layouts = [mart(spark, SF_DIR, name, order=o).collect() for o in ("global", "file", "none")]
    assert layouts[0] and sorted(layouts[0]) == sorted(layouts[1]) == sorted(layouts[2])


ORDERS = {
    "lineitems": ("L_ORDERKEY",),
    "orders": ("N_NAME", "O_ORDERPRIORITY", "O_MONTH"),
    "customers": ("N_NAME", "C_MKTSEGMENT", "R_NAME"),
    "suppliers": ("N_NAME", "R_NAME"),
    "parts": ("N_NAME", "P_TYPE", "P_CONTAINER"),
}


@pytest.mark.parametrize("name", sorted(MARTS))
def test_global_order(spark, name):
    found = [tuple(r) for r in mart(spark, SF_DIR, name).select(*ORDERS[name]).collect()]
    assert len(set(found)) == len(found) > 1
    assert found == sorted(found)


@pytest.mark.parametrize("name", sorted(MARTS))
def test_order_within_files(spark, name):
    built = mart(spark, SF_DIR, name, order="file").withColumn("task", F.spark_partition_id())
    tasks: dict[int, list] = {}
    for row in built.select("task", *ORDERS[name]).collect():
        tasks.setdefault(row.task, []).append(tuple(row)[1:])
    assert all(keys == sorted(keys) for keys in tasks.values())


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError, match="order"):
        mart(spark, SF_DIR, "orders", order="sorted")


def test_invariants(spark):
    found = mart(spark, SF_DIR, "lineitems").agg(F.sum("count")).first()[0]
    assert found == load(spark, SF_DIR, "lineitem").count()
    built = mart(spark, SF_DIR, "orders")
    assert built.agg(F.sum("orders_count")).first()[0] == load(spark, SF_DIR, "orders").count()
    flags = F.col("f_order_status") + F.col("o_order_status") + F.col("p_order_status")
    assert built.filter(flags > F.col("orders_count")).count() == 0
    for name, prefix in {"customers": "acctbal", "suppliers": "acctbal", "parts": "retailprice"}.items():
        low, avg, mean, high = (F.col(f"{p}_{prefix}") for p in ("min", "avg", "mean", "max"))
        # A quotient of doubles may miss by its last bit: (x + x + x) / 3 is not always x.
        slack = F.abs(avg) * 1e-15
        outside = (avg != mean) | (low > avg + slack) | (avg > high + slack)
        assert mart(spark, SF_DIR, name).filter(outside).count() == 0


def test_input_check_names_every_problem(spark):
    df = spark.createDataFrame([(1, "a", 2)], "R_REGIONKEY long, n_name string, r_name int")
    assert input_issues(df.schema, "region") == ["column r_name is int, needs text"]
    assert input_issues(df.schema, "nation") == [
        "missing column n_nationkey",
        "missing column n_regionkey",
    ]
    with pytest.raises(ValueError, match="n_nationkey"):
        check_input(df, "nation")


def test_schema_issues():
    declared = CONTRACTS["suppliers"]
    assert schema_issues(declared, declared) == []
    assert schema_issues(CONTRACTS["customers"], declared) == [
        "missing column unique_supplers_count",
        "extra column C_MKTSEGMENT",
        "extra column unique_customers_count",
    ]


def test_conform_selects_orders_and_casts(spark):
    declared = CONTRACTS["suppliers"]
    values = {
        "extra": 0,
        "max_acctbal": Decimal("2.50"),
        "min_acctbal": Decimal("1.50"),
        "mean_acctbal": 2.0,
        "avg_acctbal": 2.0,
        "unique_supplers_count": 1,
        "n_name": "N",
        "r_name": "R",
    }
    df = spark.createDataFrame([tuple(values.values())], list(values)).withColumn(
        "unique_supplers_count", F.col("unique_supplers_count").cast("int")
    )
    built = conform(df, "suppliers")
    assert schema_issues(built.schema, declared) == []
    assert tuple(built.first()) == ("R", "N", 1, 2.0, 2.0, 1.5, 2.5)


def test_month_of_text_with_a_zone_offset(spark):
    text = spark.createDataFrame(
        [(1, 1, "1995-01-31T23:30:00-05:00", "F", "P", 1.0)],
        SCHEMAS["orders"].replace("timestamp_ntz", "string"),
    )
    built = MARTS["orders"].build(
        text, table(spark, "customer", [(1, 1, "S", 0.0)]), table(spark, "nation", NATIONS)
    )
    assert built.first().O_MONTH == "1995-02"


def test_days_from_dates(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0, 0.0, 0.0, date(1995, 3, 1), date(1995, 2, 28), "N")],
        SCHEMAS["lineitem"].replace("timestamp_ntz", "date"),
    )
    assert MARTS["lineitems"].build(df).first().delivery_days == 1.0
