"""The five marts: DataFrames in, one contract-shaped DataFrame out.

``order`` says how the rows are laid out. ``"global"`` sorts the whole mart, as its
published files are; ``"file"`` sorts inside each task only; ``"none"`` leaves the
rows as they come. The rows are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.contracts import conform
from martloom.functions.exprs import count_value, day_diff, month_label, month_start
from martloom.operators.measures import Measure, Scale, merged_counts


def mart_lineitems(
    lineitem: DataFrame, *, scale: Scale = None, order: str = "global"
) -> DataFrame:
    """Line statistics per order.

    Spark combines the lines of an order in each map task before the shuffle, so an
    order with a third of all lines sends one row per task. Range-partitioning the
    raw lines on the key would save the sort's own shuffle but lose that.
    """
    days = day_diff(F.col("l_receiptdate"), F.col("l_shipdate"))
    stats = _line_stats(lineitem, scale, F.avg(days).alias("delivery_days"))
    return _sorted_lines(conform(stats, "lineitems"), order)


def mart_lineitems_core(
    lineitem: DataFrame, *, scale: Scale = None, order: str = "global"
) -> DataFrame:
    """``mart_lineitems`` without ``delivery_days``, for tables without receipt dates."""
    return _sorted_lines(conform(_line_stats(lineitem, scale), "lineitems_core"), order)


def mart_orders(
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    *,
    scale: Scale = None,
    order: str = "global",
) -> DataFrame:
    """Order statistics per month, customer nation and priority.

    Orders without a known customer or nation are kept under a NULL nation name.
    Customers grow with the data, so that join is left to Spark: broadcast if the
    two columns are small, else a sort-merge join whose hot keys AQE splits.
    """
    price = Measure.of(orders, "o_totalprice", scale)
    counts = ("orders_count", "f_order_status", "o_order_status", "p_order_status")
    status = F.col("o_orderstatus")
    facts = orders.select(
        "o_custkey",
        month_start(orders, "o_orderdate").alias("o_month"),
        "o_orderpriority",
        "o_orderstatus",
        # Only its presence is counted; a flag shuffles smaller than a unique key.
        F.col("o_orderkey").isNotNull().alias("has_key"),
        "o_totalprice",
    )
    by_nation = (
        facts.join(
            customer.select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
            "left",
        )
        .groupBy("o_month", "o_orderpriority", "c_nationkey")
        .agg(
            F.count_if("has_key").alias("orders_count"),
            count_value(status, "F").alias("f_order_status"),
            count_value(status, "O").alias("o_order_status"),
            count_value(status, "P").alias("p_order_status"),
            *price.first(),
        )
    )
    named = by_nation.join(
        nation.select("n_nationkey", "n_name"),
        F.col("c_nationkey") == F.col("n_nationkey"),
        "left",
    )
    keys = ("n_name", "o_orderpriority", "o_month")
    merged = _merge(named, keys, [*merged_counts(*counts), *price.merge()], order)
    return conform(
        merged.select(
            month_label(F.col("o_month")).alias("O_MONTH"),
            "n_name",
            "o_orderpriority",
            *counts,
            price.average.alias("avg_order_price"),
            price.total.alias("sum_order_price"),
            price.minimum.alias("min_order_price"),
            price.maximum.alias("max_order_price"),
        ),
        "orders",
    )


def mart_customers(
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    *,
    scale: Scale = None,
    order: str = "global",
) -> DataFrame:
    """Customer statistics per region, nation and market segment; unknown ones kept as NULL.

    ``unique_customers_count`` is a plain count, as published.
    """
    balance = Measure.of(customer, "c_acctbal", scale)
    by_nation = customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("c_custkey").alias("unique_customers_count"), *balance.first()
    )
    named = by_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    keys = ("n_name", "c_mktsegment", "r_name")
    counts = merged_counts("unique_customers_count")
    merged = _merge(named, keys, [*counts, *balance.merge()], order)
    return conform(_balances(merged, balance), "customers")


def mart_suppliers(
    supplier: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    *,
    scale: Scale = None,
    order: str = "global",
) -> DataFrame:
    """Supplier statistics per region and nation; suppliers without either are dropped.

    ``unique_supplers_count`` is a plain count; name and spelling are as published.
    """
    balance = Measure.of(supplier, "s_acctbal", scale)
    by_nation = supplier.groupBy("s_nationkey").agg(
        F.count("s_suppkey").alias("unique_supplers_count"), *balance.first()
    )
    named = by_nation.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    keys = ("n_name", "r_name")
    counts = merged_counts("unique_supplers_count")
    merged = _merge(named, keys, [*counts, *balance.merge()], order)
    return conform(_balances(merged, balance), "suppliers")


def mart_parts(
    part: DataFrame,
    partsupp: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    *,
    scale: Scale = None,
    order: str = "global",
) -> DataFrame:
    """Part and supply-cost statistics per supplier nation, part type and container.

    Each part counts once per supplier. Supply rows meet the narrow supplier table
    first and the wide part table last, so part texts are shuffled once per part
    and never once per part and supplier.
    """
    price = Measure.of(part, "p_retailprice", scale)
    cost = Measure.of(partsupp, "ps_supplycost", scale)
    supplied = partsupp.select("ps_partkey", "ps_suppkey", "ps_supplycost").join(
        supplier.select("s_suppkey", "s_nationkey"),
        F.col("ps_suppkey") == F.col("s_suppkey"),
        "inner",
    )
    by_nation = (
        supplied.join(part, F.col("ps_partkey") == F.col("p_partkey"), "inner")
        .groupBy("s_nationkey", "p_type", "p_container")
        .agg(
            F.count("p_partkey").alias("parts_count"),
            F.sum("p_size").alias("size"),
            *price.first(),
            *cost.first(),
        )
    )
    named = by_nation.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    keys = ("n_name", "p_type", "p_container")
    counts = merged_counts("parts_count", "size")
    merged = _merge(named, keys, [*counts, *price.merge(), *cost.merge()], order)
    return conform(
        merged.select(
            *keys,
            "parts_count",
            "size",
            price.average.alias("avg_retailprice"),
            price.average.alias("mean_retailprice"),
            price.minimum.alias("min_retailprice"),
            price.maximum.alias("max_retailprice"),
            cost.average.alias("avg_supplycost"),
            cost.average.alias("mean_supplycost"),
            cost.minimum.alias("min_supplycost"),
            cost.maximum.alias("max_supplycost"),
        ),
        "parts",
    )


@dataclass(frozen=True)
class Mart:
    """A mart's builder and the raw tables it takes, in argument order."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]

    def __call__(self, tables: Mapping[str, DataFrame], **options) -> DataFrame:
        return self.build(*[tables[name] for name in self.inputs], **options)


MARTS: dict[str, Mart] = {
    "lineitems": Mart(mart_lineitems, ("lineitem",)),
    "orders": Mart(mart_orders, ("orders", "customer", "nation")),
    "customers": Mart(mart_customers, ("customer", "nation", "region")),
    "suppliers": Mart(mart_suppliers, ("supplier", "nation", "region")),
    "parts": Mart(mart_parts, ("part", "partsupp", "supplier", "nation")),
}


#: What can be published: the five marts, and the line mart of tables without receipt dates.
PUBLISHABLE: dict[str, Mart] = {
    **MARTS,
    "lineitems_core": Mart(mart_lineitems_core, ("lineitem",)),
}

#: The published columns that a mart is sorted by.
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "lineitems": ("L_ORDERKEY",),
    "lineitems_core": ("L_ORDERKEY",),
    "orders": ("N_NAME", "O_ORDERPRIORITY", "O_MONTH"),
    "customers": ("N_NAME", "C_MKTSEGMENT", "R_NAME"),
    "suppliers": ("N_NAME", "R_NAME"),
    "parts": ("N_NAME", "P_TYPE", "P_CONTAINER"),
}


def _line_stats(lineitem: DataFrame, scale: Scale, *extra: Column) -> DataFrame:
    price, discount, tax = (
        Measure.of(lineitem, name, scale) for name in ("l_extendedprice", "l_discount", "l_tax")
    )
    returned = F.col("l_returnflag")
    extra_names = [F.col("delivery_days")] if extra else []
    return (
        lineitem.groupBy(F.col("l_orderkey").alias("L_ORDERKEY"))
        .agg(
            F.count("l_partkey").alias("count"),
            *price.first(),
            *discount.first(),
            *tax.first(),
            *extra,
            count_value(returned, "A").alias("A_return_flags"),
            count_value(returned, "R").alias("R_return_flags"),
            count_value(returned, "N").alias("N_return_flags"),
        )
        .select(
            F.col("L_ORDERKEY").cast("long").alias("L_ORDERKEY"),
            "count",
            price.total.alias("sum_extendprice"),
            discount.average.alias("mean_discount"),
            tax.average.alias("mean_tax"),
            *extra_names,
            "A_return_flags",
            "R_return_flags",
            "N_return_flags",
        )
    )


def _balances(named: DataFrame, balance: Measure) -> DataFrame:
    average = balance.average
    return named.select(
        "*",
        average.alias("avg_acctbal"),
        average.alias("mean_acctbal"),
        balance.minimum.alias("min_acctbal"),
        balance.maximum.alias("max_acctbal"),
    )


def _merge(
    groups: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], order: str
) -> DataFrame:
    """Merge partial results by name and lay them out by the same keys.

    The rows are groups already and cannot pile up on one key, so one range shuffle
    serves both the merge and the global sort.
    """
    _check(order)
    if order == "global":
        groups = groups.repartitionByRange(*keys)
    merged = groups.groupBy(*keys).agg(*aggregates)
    return merged if order == "none" else merged.sortWithinPartitions(*keys)


def _sorted_lines(mart: DataFrame, order: str) -> DataFrame:
    _check(order)
    if order == "global":
        return mart.orderBy("L_ORDERKEY")
    return mart if order == "none" else mart.sortWithinPartitions("L_ORDERKEY")


def _check(order: str) -> None:
    if order not in ("global", "file", "none"):
        raise ValueError(f"order must be global, file or none, not {order!r}")
