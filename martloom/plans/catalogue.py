"""Every operator of the workload as a query over a folder of parquet tables.

Money and rate columns of these tables have two decimals, so the queries add them
exactly (``SCALE``); their results can be compared bit by bit with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.contracts import CONTRACTS
from martloom.functions.exprs import count_value, day_diff, flag, month_label, to_day
from martloom.operators.measures import Measure
from martloom.operators.quality import (
    HasParent,
    InDomain,
    NotNull,
    Unique,
    clean_rows,
    dedup_latest,
    parse_typed,
    validate_rules,
)
from martloom.operators.sinks import (
    break_off_swap,
    file_sizes,
    path_exists,
    recover_mart,
    register_mart,
    release_run,
    remove_old_runs,
    report_path,
    scratch_dir,
    table_location,
    write_mart,
    write_run,
)
from martloom.plans.marts import MARTS, mart_lineitems_core
from martloom.sources.tables import read_table, table_path
from martloom.sources.testdata import load

Query = Callable[[SparkSession, str], DataFrame]

SCALE = 2


def catalogue() -> dict[str, Query]:
    scans = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return {
        **{f"scan_{t}": partial(_scan, table=t) for t in scans},
        "scan_partsupp": lambda spark, base: load(spark, base, "partsupp"),
        "project_lineitem_flags": project_lineitem_flags,
        "derive_order_columns": derive_order_columns,
        "join_left": join_left,
        "join_inner": join_inner,
        "join_star_3way": join_star_3way,
        "join_left_orphans": join_left_orphans,
        "join_inner_orphans": join_inner_orphans,
        "join_fanout": join_fanout,
        "agg_count": agg_count,
        "agg_sum": agg_sum,
        "agg_sum_scale4": agg_sum_scale4,
        "agg_sum_doubles": agg_sum_doubles,
        "agg_sum_int": agg_sum_int,
        "agg_conditional_count": agg_conditional_count,
        "agg_avg_mean": agg_avg_mean,
        "agg_min_max": agg_min_max,
        "agg_count_vs_distinct": agg_count_vs_distinct,
        "fn_to_date": fn_to_date,
        "fn_datediff": fn_datediff,
        "fn_month_label": fn_month_label,
        "fn_case_flag": fn_case_flag,
        **{f"mart_{m}": partial(mart, name=m) for m in MARTS},
        "mart_lineitems_core": lineitems_core,
        "sink_overwrite_roundtrip": sink_overwrite_roundtrip,
        "sink_coalesce_roundtrip": sink_coalesce_roundtrip,
        "sink_sized_roundtrip": sink_sized_roundtrip,
        "sink_recovered_roundtrip": sink_recovered_roundtrip,
        **{f"serve_{m}": partial(serve, name=m) for m in MARTS},
        "serve_repointed": serve_repointed,
        "validate_rules": lineitem_rules,
        "parse_typed": url_numbers,
        "parse_rejects": url_rejects,
        "clean_rows": clean_documents,
        "clean_quarantine": quarantined_documents,
        "dedup_latest": latest_lines,
    }


def mart(spark: SparkSession, base: str, name: str, order: str = "global") -> DataFrame:
    tables = {t: load(spark, base, t) for t in MARTS[name].inputs}
    return MARTS[name](tables, scale=SCALE, order=order)


def lineitems_core(spark: SparkSession, base: str) -> DataFrame:
    return mart_lineitems_core(read_table(spark, base, "lineitem"), scale=SCALE)


def _scan(spark: SparkSession, base: str, table: str) -> DataFrame:
    return read_table(spark, base, table)


def project_lineitem_flags(spark: SparkSession, base: str) -> DataFrame:
    flags = [
        flag(F.col("l_returnflag"), v).alias(f"{v.lower()}_flag") for v in ("A", "R", "N")
    ]
    return read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax", *flags
    )


def derive_order_columns(spark: SparkSession, base: str) -> DataFrame:
    status = F.col("o_orderstatus")
    derived = {f"{v.lower()}_order_status": flag(status, v) for v in ("F", "O", "P")}
    return (
        read_table(spark, base, "orders")
        .withColumns({"o_month": month_label(F.col("o_orderdate")), **derived})
        .select("o_orderkey", "o_month", *derived)
    )


def join_left(spark: SparkSession, base: str) -> DataFrame:
    customer = read_table(spark, base, "customer")
    return (
        read_table(spark, base, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("o_orderkey", "c_custkey", "c_nationkey")
    )


def join_inner(spark: SparkSession, base: str) -> DataFrame:
    nation = read_table(spark, base, "nation")
    return (
        read_table(spark, base, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .select("s_suppkey", "n_name")
    )


def join_star_3way(spark: SparkSession, base: str) -> DataFrame:
    nation, region = (read_table(spark, base, t) for t in ("nation", "region"))
    return (
        read_table(spark, base, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
        .select("s_suppkey", "n_name", "r_name")
    )


def _damaged_dimensions(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Nations and regions with rows taken out.

    All customers and suppliers are still read: the point is that some of them now
    have no nation or no region, which the complete tables never show.
    """
    nation = read_table(spark, base, "nation").filter("n_nationkey < 20")
    region = read_table(spark, base, "region").filter("r_regionkey <> 2")
    return nation, region


def join_left_orphans(spark: SparkSession, base: str) -> DataFrame:
    nation, region = _damaged_dimensions(spark, base)
    customers = MARTS["customers"].build(read_table(spark, base, "customer"), nation, region)
    return customers.select("R_NAME", "N_NAME", "C_MKTSEGMENT", "unique_customers_count")


def join_inner_orphans(spark: SparkSession, base: str) -> DataFrame:
    nation, region = _damaged_dimensions(spark, base)
    suppliers = MARTS["suppliers"].build(read_table(spark, base, "supplier"), nation, region)
    return suppliers.select("R_NAME", "N_NAME", "unique_supplers_count")


def _customers_of_doubled_nations(spark: SparkSession, base: str) -> DataFrame:
    """All customers joined to nations of which three occur twice."""
    nation = read_table(spark, base, "nation").select("n_nationkey", "n_name")
    doubled = nation.unionByName(nation.filter("n_nationkey < 3"))
    return read_table(spark, base, "customer").join(
        doubled, F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )


def join_fanout(spark: SparkSession, base: str) -> DataFrame:
    return (
        _customers_of_doubled_nations(spark, base)
        .groupBy(F.col("n_name").alias("N_NAME"))
        .agg(F.count("c_custkey").alias("n_count"))
    )


def agg_count_vs_distinct(spark: SparkSession, base: str) -> DataFrame:
    return (
        _customers_of_doubled_nations(spark, base)
        .groupBy(F.col("n_name").alias("N_NAME"))
        .agg(
            F.count("c_custkey").alias("n_count"),
            F.count_distinct("c_custkey").alias("n_distinct"),
        )
    )


def agg_count(spark: SparkSession, base: str) -> DataFrame:
    """Counting a column skips its NULLs: here the part of each first line."""
    part = F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_partkey"))
    lines = read_table(spark, base, "lineitem").select("l_orderkey", part.alias("part"))
    return lines.groupBy("l_orderkey").agg(F.count("part").alias("cnt"))


def agg_sum(spark: SparkSession, base: str) -> DataFrame:
    price = Measure("o_totalprice", SCALE)
    return (
        read_table(spark, base, "orders")
        .groupBy("o_orderpriority")
        .agg(*price.first())
        .select("o_orderpriority", price.total.alias("sum_order_price"))
    )


def agg_sum_scale4(spark: SparkSession, base: str) -> DataFrame:
    """Discounts given, which have four decimals."""
    amount = Measure("amount", 4)
    price, rate = (F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_discount"))
    return (
        read_table(spark, base, "lineitem")
        .select("l_returnflag", (price * rate).cast("double").alias("amount"))
        .groupBy("l_returnflag")
        .agg(*amount.first())
        .select("l_returnflag", amount.total.alias("sum_amount"))
    )


def agg_sum_doubles(spark: SparkSession, base: str) -> DataFrame:
    """Net prices as plain doubles with all their bits, in rows dealt out by a hash of their own.

    The sums are those of the exact values; rounded to whole cents, so that an engine whose sums
    depend on the order agrees.
    """
    net = Measure("net")
    lines = read_table(spark, base, "lineitem").select(
        "l_returnflag",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net"),
    )
    return (
        lines.repartition(7, F.xxhash64("net"))
        .groupBy("l_returnflag")
        .agg(*net.first())
        .select(
            "l_returnflag",
            F.round(net.total, 2).alias("sum_net"),
            F.round(net.average, 2).alias("avg_net"),
        )
    )


def agg_sum_int(spark: SparkSession, base: str) -> DataFrame:
    part = read_table(spark, base, "part")
    return part.groupBy("p_type").agg(F.sum("p_size").alias("total_size"))


def agg_conditional_count(spark: SparkSession, base: str) -> DataFrame:
    """A NULL flag counts for no value: here every 'A' was made NULL."""
    flags = read_table(spark, base, "lineitem").select(
        "l_orderkey", F.nullif("l_returnflag", F.lit("A")).alias("f")
    )
    return flags.groupBy("l_orderkey").agg(
        count_value(F.col("f"), "A").alias("a_flags"),
        count_value(F.col("f"), "R").alias("r_flags"),
    )


def agg_avg_mean(spark: SparkSession, base: str) -> DataFrame:
    balance = Measure("c_acctbal", SCALE)
    return (
        read_table(spark, base, "customer")
        .groupBy("c_mktsegment")
        .agg(*balance.first())
        .select(
            "c_mktsegment",
            balance.average.alias("avg_acctbal"),
            balance.average.alias("mean_acctbal"),
        )
    )


def agg_min_max(spark: SparkSession, base: str) -> DataFrame:
    price = F.col("p_retailprice")
    part = read_table(spark, base, "part")
    return part.groupBy("p_type").agg(
        F.min(price).alias("min_retailprice"), F.max(price).alias("max_retailprice")
    )


def fn_to_date(spark: SparkSession, base: str) -> DataFrame:
    events = read_table(spark, base, "events")
    return events.select("event_id", to_day(F.col("ts")).alias("event_date"))


def fn_month_label(spark: SparkSession, base: str) -> DataFrame:
    events = read_table(spark, base, "events")
    return events.select("event_id", month_label(F.col("ts")).alias("event_month"))


def fn_datediff(spark: SparkSession, base: str) -> DataFrame:
    lines = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", to_day(F.col("l_shipdate")).alias("shipped")
    )
    orders = read_table(spark, base, "orders").select(
        "o_orderkey", to_day(F.col("o_orderdate")).alias("ordered")
    )
    lag = day_diff(F.col("shipped"), F.col("ordered"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner").select(
        "l_orderkey", "l_linenumber", lag.alias("ship_lag_days")
    )


def fn_case_flag(spark: SparkSession, base: str) -> DataFrame:
    """A NULL condition takes the ``otherwise`` branch: here every 'F' was made NULL."""
    status = F.nullif("o_orderstatus", F.lit("F"))
    return read_table(spark, base, "orders").select(
        "o_orderkey", flag(status, "F").alias("f_flag"), flag(status, "O").alias("o_flag")
    )


def sink_overwrite_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """The orders mart written twice to one place and read back: not doubled."""
    out = scratch_dir(spark)
    first, target = f"{out}/first", report_path(f"{out}/overwrite", "orders")
    write_mart(mart(spark, base, "orders"), first, inputs=[base])
    built = spark.read.parquet(first)
    write_mart(built, target, inputs=[base, first])
    write_mart(built, target, inputs=[base, first])
    return spark.read.parquet(target)


def sink_coalesce_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """The orders mart from six tasks in four files, and how many files there are."""
    target = report_path(scratch_dir(spark), "orders")
    spread = mart(spark, base, "orders", order="none").repartition(6)
    write_mart(spread, target, num_files=4, inputs=[base])
    written = spark.read.parquet(target)
    files = F.lit(len(written.inputFiles())).cast("bigint")
    return written.withColumn("n_files", files)


def sink_sized_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Lines from many small tasks in files of half a MB, and whether all are near that size.

    Their keys are in order, within files and from file to file.
    """
    target, size = f"{scratch_dir(spark)}/lines", 1 << 19
    lines = read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = ("l_orderkey", "l_linenumber", "l_extendedprice")
    write_mart(
        lines.repartitionByRange(40, *order).sortWithinPartitions(*order),
        target,
        file_bytes=size,
        inputs=[base],
    )
    sizes = file_sizes(spark, target)
    fit = len(sizes) == 1 or all(size / 2 <= x <= 2 * size for x in sizes)
    return spark.read.parquet(target).withColumn("files_fit", F.lit(int(fit)).cast("long"))


def sink_recovered_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """The suppliers mart after a publisher died in the middle of replacing it, and whether it was."""
    target = report_path(scratch_dir(spark), "suppliers")
    write_mart(mart(spark, base, "suppliers"), target, inputs=[base])
    break_off_swap(spark, mart(spark, base, "suppliers").limit(1), target)
    recovered = recover_mart(spark, target)
    return spark.read.parquet(target).withColumn("recovered", F.lit(int(recovered)).cast("long"))


def serve_repointed(spark: SparkSession, base: str) -> DataFrame:
    """The orders mart, served in place of an older run of it, which is gone."""
    folder = scratch_dir(spark)
    path, table = report_path(folder, "orders"), f"repointed_{folder.rsplit('/', 1)[-1]}"
    built = mart(spark, base, "orders")
    runs = []
    for rows in (built.limit(7), built):
        runs.append(write_run(rows, path, inputs=[base]))
        register_mart(spark, "orders", runs[-1], table)
        release_run(spark, runs[-1])
        remove_old_runs(spark, path, runs[-1], table=table)
    return spark.table(table).select(
        *CONTRACTS["orders"].names,
        F.lit(int(table_location(spark, table).endswith(runs[1]))).cast("long").alias("repointed"),
        F.lit(int(not path_exists(spark, runs[0]))).cast("long").alias("old_run_removed"),
    )


def serve(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A mart written, registered as an external table and read from the catalog."""
    folder = scratch_dir(spark)
    path, table = report_path(folder, name), f"served_{name}_{folder.rsplit('/', 1)[-1]}"
    inputs = [table_path(base, t) for t in MARTS[name].inputs]
    write_mart(mart(spark, base, name), path, inputs=inputs)
    register_mart(spark, name, path, table)
    return spark.table(table).select(*CONTRACTS[name].names)


def lineitem_rules(spark: SparkSession, base: str) -> DataFrame:
    """All lines, some of them damaged, against a schema that differs in each way.

    So each kind of rule has something to find.
    """
    number, order = F.col("l_linenumber"), F.col("l_orderkey")
    lines = read_table(spark, base, "lineitem").withColumns(
        {
            "l_orderkey": F.when(number == 7, None).when(number == 6, -order).otherwise(order),
            "l_returnflag": F.when(number == 5, "X").otherwise(F.col("l_returnflag")),
        }
    )
    orders = read_table(spark, base, "orders")
    declared = [f for f in lines.schema if f.name not in ("l_tax", "l_shipdate")]
    declared += [T.StructField("l_tax", T.DecimalType(12, 2)), T.StructField("l_comment", T.StringType())]
    return validate_rules(
        lines,
        [
            NotNull("lineitem_key_null", "l_orderkey"),
            Unique("lineitem_key_duplicate", ("l_orderkey", "l_linenumber")),
            HasParent("lineitem_orphan_order", "l_orderkey", orders, "o_orderkey"),
            InDomain("returnflag_domain", "l_returnflag", ("A", "R", "N")),
        ],
        T.StructType(declared),
    )


def _url_numbers(spark: SparkSession, base: str) -> DataFrame:
    """The number in each page's URL; every fifth page's has a letter in it."""
    number = F.regexp_extract("url", "([0-9]+)", 1)
    broken = F.concat(number, F.lit("x"))
    numbers = read_table(spark, base, "pages").select(
        "page_id", F.when(F.col("page_id") % 5 == 0, broken).otherwise(number).alias("url_number")
    )
    return parse_typed(numbers, {"url_number": "bigint"})


def url_numbers(spark: SparkSession, base: str) -> DataFrame:
    return _url_numbers(spark, base).drop("failed")


def url_rejects(spark: SparkSession, base: str) -> DataFrame:
    rejects = _url_numbers(spark, base).filter(F.size("failed") > 0)
    return rejects.select("page_id", F.explode("failed").alias("f")).select(
        "page_id", F.col("f.column").alias("column_name"), F.col("f.text").alias("bad_text")
    )


def _cleaned_documents(spark: SparkSession, base: str) -> DataFrame:
    """Documents with white space around every third text and nothing else in every seventh."""
    wrapped = F.concat(F.lit("\t\n "), F.col("text"), F.lit(" \r\n"))
    text = F.when(F.col("doc_id") % 7 == 0, " \t\n").when(F.col("doc_id") % 3 == 0, wrapped)
    documents = read_table(spark, base, "documents").select(
        "doc_id", text.otherwise(F.col("text")).alias("text")
    )
    return clean_rows(documents, text=["text"], required=["text"])


def clean_documents(spark: SparkSession, base: str) -> DataFrame:
    return _cleaned_documents(spark, base).filter("complete").drop("complete")


def quarantined_documents(spark: SparkSession, base: str) -> DataFrame:
    return _cleaned_documents(spark, base).filter("NOT complete").drop("complete")


def latest_lines(spark: SparkSession, base: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = read_table(spark, base, "lineitem").select(*columns, "l_shipdate")
    newest_first = [F.col("l_shipdate").desc_nulls_last()]
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], newest_first).select(*columns)
