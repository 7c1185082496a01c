"""What each mart needs and what it promises.

``CONTRACTS`` is the published schema of a mart: column names (spelling and case
included), order and types. ``INPUTS`` lists the columns the marts read from each
raw table, with the kind of type they accept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """A table does not have the declared columns."""


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()

# The marts' published column names, order and types.
CONTRACTS: dict[str, T.StructType] = {
    "lineitems": _schema(
        L_ORDERKEY=_LONG,
        count=_LONG,
        sum_extendprice=_DOUBLE,
        mean_discount=_DOUBLE,
        mean_tax=_DOUBLE,
        delivery_days=_DOUBLE,
        A_return_flags=_LONG,
        R_return_flags=_LONG,
        N_return_flags=_LONG,
    ),
    "orders": _schema(
        O_MONTH=_TEXT,
        N_NAME=_TEXT,
        O_ORDERPRIORITY=_TEXT,
        orders_count=_LONG,
        avg_order_price=_DOUBLE,
        sum_order_price=_DOUBLE,
        min_order_price=_DOUBLE,
        max_order_price=_DOUBLE,
        f_order_status=_LONG,
        o_order_status=_LONG,
        p_order_status=_LONG,
    ),
    "customers": _schema(
        R_NAME=_TEXT,
        N_NAME=_TEXT,
        C_MKTSEGMENT=_TEXT,
        unique_customers_count=_LONG,
        avg_acctbal=_DOUBLE,
        mean_acctbal=_DOUBLE,
        min_acctbal=_DOUBLE,
        max_acctbal=_DOUBLE,
    ),
    "suppliers": _schema(
        R_NAME=_TEXT,
        N_NAME=_TEXT,
        unique_supplers_count=_LONG,
        avg_acctbal=_DOUBLE,
        mean_acctbal=_DOUBLE,
        min_acctbal=_DOUBLE,
        max_acctbal=_DOUBLE,
    ),
    "parts": _schema(
        N_NAME=_TEXT,
        P_TYPE=_TEXT,
        P_CONTAINER=_TEXT,
        parts_count=_LONG,
        avg_retailprice=_DOUBLE,
        size=_LONG,
        mean_retailprice=_DOUBLE,
        min_retailprice=_DOUBLE,
        max_retailprice=_DOUBLE,
        avg_supplycost=_DOUBLE,
        mean_supplycost=_DOUBLE,
        min_supplycost=_DOUBLE,
        max_supplycost=_DOUBLE,
    ),
}

_KINDS: dict[str, tuple[type[T.DataType], ...]] = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "number": (T.NumericType,),
    "text": (T.StringType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType),
}

INPUTS: dict[str, dict[str, str]] = {
    "lineitem": {
        "l_orderkey": "integer",
        "l_partkey": "integer",
        "l_extendedprice": "number",
        "l_discount": "number",
        "l_tax": "number",
        "l_receiptdate": "date",
        "l_shipdate": "date",
        "l_returnflag": "text",
    },
    "orders": {
        "o_orderkey": "integer",
        "o_custkey": "integer",
        "o_orderdate": "date",
        "o_orderstatus": "text",
        "o_orderpriority": "text",
        "o_totalprice": "number",
    },
    "customer": {
        "c_custkey": "integer",
        "c_nationkey": "integer",
        "c_mktsegment": "text",
        "c_acctbal": "number",
    },
    "nation": {"n_nationkey": "integer", "n_regionkey": "integer", "n_name": "text"},
    "region": {"r_regionkey": "integer", "r_name": "text"},
    "supplier": {"s_suppkey": "integer", "s_nationkey": "integer", "s_acctbal": "number"},
    "part": {
        "p_partkey": "integer",
        "p_type": "text",
        "p_container": "text",
        "p_retailprice": "number",
        "p_size": "integer",
    },
    "partsupp": {"ps_partkey": "integer", "ps_suppkey": "integer", "ps_supplycost": "number"},
}


CONTRACTS["lineitems_core"] = T.StructType(
    [f for f in CONTRACTS["lineitems"] if f.name != "delivery_days"]
)

_LINES = tuple(c for c in INPUTS["lineitem"] if c not in ("l_receiptdate", "l_shipdate"))

#: The columns that a mart reads of a table, where these are not all that any mart reads.
READS: dict[tuple[str, str], tuple[str, ...]] = {
    ("lineitems_core", "lineitem"): _LINES,
    ("orders", "customer"): ("c_custkey", "c_nationkey"),
    ("orders", "nation"): ("n_nationkey", "n_name"),
    ("parts", "nation"): ("n_nationkey", "n_name"),
    ("parts", "supplier"): ("s_suppkey", "s_nationkey"),
}


def schema_issues(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Differences in names, types and order; nullability is not compared."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in declared}
    issues = [f"missing column {name}" for name in want if name not in have]
    issues += [f"extra column {name}" for name in have if name not in want]
    issues += [
        f"column {name} is {have[name].simpleString()}, declared {kind.simpleString()}"
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    if not issues and actual.names != declared.names:
        issues.append(f"column order is {actual.names}, declared {declared.names}")
    return issues


def input_issues(actual: T.StructType, table: str, mart: str | None = None) -> list[str]:
    """Columns of a raw table that are missing or of a kind that the mart, or any, cannot read."""
    have = {f.name.lower(): f.dataType for f in actual}
    read = READS.get((mart, table), tuple(INPUTS[table]))
    issues = []
    for name, kind in INPUTS[table].items():
        if name not in read:
            continue
        if name not in have:
            issues.append(f"missing column {name}")
        elif not isinstance(have[name], _KINDS[kind]):
            issues.append(f"column {name} is {have[name].simpleString()}, needs {kind}")
    return issues


def check_input(df: DataFrame, table: str, mart: str | None = None) -> DataFrame:
    if issues := input_issues(df.schema, table, mart):
        raise ContractError(f"input {table}: " + "; ".join(issues))
    return df


def check_contract(schema: T.StructType, mart: str) -> None:
    if issues := schema_issues(schema, CONTRACTS[mart]):
        raise ContractError(f"mart {mart}: " + "; ".join(issues))


def conform(df: DataFrame, mart: str) -> DataFrame:
    """Select the mart's columns in contract order, spelling and type."""
    return df.to(CONTRACTS[mart])
