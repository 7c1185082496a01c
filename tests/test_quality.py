"""Validation, parsing, cleaning and deduplication on rows that break the rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.quality import (
    HasParent,
    InDomain,
    NotNull,
    Unique,
    clean_rows,
    dedup_latest,
    parse_typed,
    validate_rules,
    validate_schema,
)

LINES = "l_orderkey long, l_linenumber int, l_returnflag string"


def test_rules_count_violations(spark):
    lines = spark.createDataFrame(
        [(1, 1, "A"), (1, 1, "R"), (1, 1, "N"), (2, 1, "X"), (3, 1, None), (None, 1, "A"), (None, 1, "A")],
        LINES,
    )
    orders = spark.createDataFrame([(1,), (1,), (3,), (None,)], "o_orderkey long")
    report = validate_rules(
        lines,
        [
            NotNull("key", "l_orderkey"),
            InDomain("flag", "l_returnflag", ("A", "R", "N")),
            Unique("duplicate", ("l_orderkey", "l_linenumber")),
            HasParent("orphan", "l_orderkey", orders, "o_orderkey"),
        ],
    )
    assert report.dtypes == [("rule", "string"), ("violations", "bigint")]
    assert dict(map(tuple, report.collect())) == {"key": 2, "flag": 1, "duplicate": 3, "orphan": 3}


def test_rules_on_an_empty_table(spark):
    lines = spark.createDataFrame([], LINES)
    report = validate_rules(
        lines,
        [
            NotNull("key", "l_orderkey"),
            Unique("duplicate", ("l_orderkey",)),
            HasParent("orphan", "l_orderkey", lines, "l_orderkey"),
        ],
    )
    assert dict(map(tuple, report.collect())) == {"key": 0, "duplicate": 0, "orphan": 0}


def test_rules_share_one_scan_and_keep_key_types_apart(spark, tmp_path):
    rows = [(k % 50, f"t{k % 9}", None if k % 10 == 0 else k % 4, float(k % 3)) for k in range(400)]
    path, parent = f"{tmp_path}/checked", f"{tmp_path}/parent"
    spark.createDataFrame(rows, "a int, b string, c int, d double").write.parquet(path)
    # Parents of a wider type, repeated, and with a NULL that is no parent.
    spark.createDataFrame([(k,) for k in [0, 1, 1, 2, None]], "p long").write.parquet(parent)
    rules = [
        Unique("a", ("a",)),
        Unique("pair", ("b", "d")),
        HasParent("c", "c", spark.read.parquet(parent), "p"),
        HasParent("a in c", "a", spark.read.parquet(path), "c"),
        NotNull("c there", "c"),
        InDomain("b.known", "b", ("t0", "t1")),
    ]
    report = validate_rules(spark.read.parquet(path), rules)
    children = {r[2] for r in rows} - {None}
    assert dict(map(tuple, report.collect())) == {
        "a": 350,
        "pair": 400 - len({(r[1], r[3]) for r in rows}),
        "c": sum(r[2] in (None, 3) for r in rows),
        "a in c": sum(r[0] not in children for r in rows),
        "c there": 40,
        "b.known": sum(r[1] not in ("t0", "t1") for r in rows),
    }
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # The checked table is read once for all rules, and once as a parent; the other parent once.
    assert plan.count("Relation [a") == 2 and plan.count("Relation [p") == 1


def test_no_rules_is_an_error(spark):
    with pytest.raises(ValueError, match="no rules"):
        validate_rules(spark.range(1), [])


def test_parsing_returns_all_rows_and_the_rejects(spark):
    raw = spark.createDataFrame(
        [(1, "12", "1995-01-31"), (2, "12a", "1995-13-45"), (3, None, "1995-02-01"), (4, "7", None)],
        "id int, number string, day string",
    )
    parsed = parse_typed(raw, {"number": "bigint", "day": "date"})
    assert parsed.dtypes[:3] == [("id", "int"), ("number", "bigint"), ("day", "date")]
    assert [(r.id, r.number, r.day and str(r.day)) for r in parsed.orderBy("id").collect()] == [
        (1, 12, "1995-01-31"),
        (2, None, None),
        (3, None, "1995-02-01"),
        (4, 7, None),
    ]
    rejects = parsed.filter(F.size("failed") > 0).collect()
    assert [(r.id, [tuple(f) for f in r.failed]) for r in rejects] == [
        (2, [("number", "12a"), ("day", "1995-13-45")])
    ]
    with pytest.raises(ValueError, match="another tag"):
        parse_typed(raw, {"number": "bigint"}, tag="DAY")


def test_cleaning_quarantines_and_loses_nothing(spark):
    raw = spark.createDataFrame(
        [(1, " a "), (2, "  "), (3, ""), (4, None), (None, "b"), (6, "c  d"), (7, "\t\n"), (8, "\r\xa0e\n\x85")],
        "id int, text string",
    )
    rows = clean_rows(raw, text=["text"], required=["id", "text"]).collect()
    assert {(r.id, r.text) for r in rows if r.complete} == {(1, "a"), (6, "c  d"), (8, "e")}
    assert {(r.id, r.text) for r in rows if not r.complete} == {
        (2, None), (3, None), (4, None), (None, "b"), (7, None)
    }
    with pytest.raises(ValueError, match="another tag"):
        clean_rows(raw, text=["text"], required=["id"], tag="id")


def test_rules_of_one_name_are_refused(spark):
    with pytest.raises(ValueError, match="named"):
        validate_rules(spark.range(1), [NotNull("r", "id"), Unique("r", ("id",))])


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a long, b string, c double")
    declared = T.StructType.fromDDL("a long, b int, d date, e date")
    assert dict(map(tuple, validate_schema(df, declared).collect())) == {
        "schema_missing": 2,
        "schema_extra": 1,
        "schema_type": 1,
    }
    assert {r.violations for r in validate_schema(df, df.schema).collect()} == {0}


def test_dedup_keeps_a_column_named_like_its_own(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "k int, _position int, _POSITION_ int")
    assert dedup_latest(df, ["k"], [F.col("_position").desc()]).collect() == [(1, 6, 2)]


def test_dedup_equals_brute_force_however_rows_are_spread(spark):
    rng = random.Random(3)
    rows = [
        # One key holds a third of all rows.
        (
            7 if rng.random() < 1 / 3 else rng.randrange(200),
            rng.choice([None, *range(40)]),
            rng.randrange(10**6),
        )
        for _ in range(5000)
    ]
    expected = {}
    for key, stamp, value in rows:
        rank = (stamp is None, -(stamp or 0), value)
        if key not in expected or rank < expected[key][0]:
            expected[key] = (rank, (key, stamp, value))
    df = spark.createDataFrame(rows, "key int, stamp int, value int")
    for partitions in (1, 7):
        spread = df.repartition(partitions, F.rand(partitions))
        kept = dedup_latest(spread, ["key"], [F.col("stamp").desc_nulls_last()])
        assert kept.columns == df.columns
        assert {tuple(r) for r in kept.collect()} == {row for _, row in expected.values()}
        assert kept.count() == len(expected)
