"""Optional steps in front of the marts: validate, parse, clean, deduplicate.

The marts do not call these. Rows that fail a step are tagged and returned with the
good ones, never lost and never a reason to abort the job. One frame holds both, so a
text is evaluated once: split it where it is written, or write it partitioned by the tag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class NotNull:
    rule: str
    column: str


@dataclass(frozen=True)
class InDomain:
    """The value is one of ``values``; NULL is not a violation."""

    rule: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """Violations are the rows beyond the first of each key; NULL is a key value."""

    rule: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class HasParent:
    """The key occurs in the parent table; a NULL key has no parent."""

    rule: str
    column: str
    parent: DataFrame
    parent_column: str


Rule = NotNull | InDomain | Unique | HasParent

#: White space that ``clean_rows`` takes off both ends: ASCII's, next line and no-break space.
WHITE = " \t\n\x0b\x0c\r\x85\xa0"


def validate_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """One row per kind of difference: ``rule``, ``violations``, a number of columns.

    ``schema_missing`` are declared columns that are absent, ``schema_extra`` undeclared ones, and
    ``schema_type`` those of another type. Names are compared in the spelling given. The
    rows are made from the schema alone; nothing is read.
    """
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in declared}
    counts = {
        "schema_missing": sum(name not in have for name in want),
        "schema_extra": sum(name not in want for name in have),
        "schema_type": sum(name in have and have[name] != kind for name, kind in want.items()),
    }
    return df.sparkSession.createDataFrame(list(counts.items()), "rule string, violations long")


def validate_rules(
    df: DataFrame, rules: Sequence[Rule], declared: T.StructType | None = None
) -> DataFrame:
    """One row per rule: ``rule``, ``violations``. Rules need names of their own.

    With a ``declared`` schema the rows of ``validate_schema`` come too.

    All rules share one scan of ``df``: a row becomes an entry for each key rule, with its key, and
    for each row rule that it violates. Entries are counted by rule and key, first in each map
    task, so a hot key shrinks to one row per task before the shuffle. Keys of parents join
    that grouping as entries that count nothing; a parent is scanned once for each rule that names it.
    """
    if not rules:
        raise ValueError("no rules given")
    names = [r.rule for r in rules]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"several rules are named {twice}")
    report = _violations(df, rules)
    return report if declared is None else report.unionByName(validate_schema(df, declared))


def _violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    # Each key rule has key columns of its own, of its columns' types; other rules leave them NULL.
    kinds = {
        (k, place): df.select(column).schema[0].dataType
        for k, rule in enumerate(rules)
        for place, column in enumerate(_keys(rule))
    }
    names = {at: "key_{}_{}".format(*at) for at in kinds}

    def entry(number: int, keys: Sequence[Column]) -> list[Column]:
        given = {(number, place): key for place, key in enumerate(keys)}
        return [
            F.lit(number).alias("rule"),
            *(given.get(at, F.lit(None).cast(kind)).alias(names[at]) for at, kind in kinds.items()),
        ]

    entries = []
    for number, rule in enumerate(rules):
        made = F.struct(*entry(number, [F.col(c) for c in _keys(rule)]))
        if isinstance(rule, (NotNull, InDomain)):
            made = F.when(_violates(rule), made)
        entries.append(made)
    found = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select(
        "e.*", F.lit(1).cast("long").alias("n"), F.lit(False).alias("parent")
    )
    for number, rule in enumerate(rules):
        if isinstance(rule, HasParent):
            key = F.col(rule.parent_column)
            parents = rule.parent.where(key.isNotNull()).select(
                *entry(number, [key]), F.lit(0).cast("long").alias("n"), F.lit(True).alias("parent")
            )
            found = found.unionByName(parents)
    per_key = found.groupBy("rule", *names.values()).agg(
        F.sum("n").alias("n"), F.max("parent").alias("parent")
    )
    counted = per_key.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("rule") == k, _surplus(rule))), F.lit(0)).alias(f"rule_{k}")
            for k, rule in enumerate(rules)
        )
    )
    rows = [
        F.struct(F.lit(rule.rule).alias("rule"), F.col(f"rule_{k}").alias("violations"))
        for k, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _keys(rule: Rule) -> list[str]:
    if isinstance(rule, Unique):
        return list(rule.columns)
    return [rule.column] if isinstance(rule, HasParent) else []


def _surplus(rule: Rule) -> Column:
    """How many of the rows with a key violate the rule."""
    n = F.col("n")
    if isinstance(rule, Unique):
        return n - 1
    return F.when(F.col("parent"), 0).otherwise(n) if isinstance(rule, HasParent) else n


def parse_typed(df: DataFrame, types: Mapping[str, str], tag: str = "failed") -> DataFrame:
    """Convert text columns to their declared types.

    Every row comes back, with NULL where a text does not parse, and ``tag``: an array of
    (column, text) of the texts at fault, empty for good rows.
    """
    _refuse_clash(df, tag)
    faults = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("text")),
        )
        for c, t in types.items()
    ]
    return df.withColumns(
        {c: F.col(c).try_cast(t) for c, t in types.items()}
        | {tag: F.array_compact(F.array(*faults))}
    )


def clean_rows(
    df: DataFrame, text: Sequence[str], required: Sequence[str], tag: str = "complete"
) -> DataFrame:
    """Trim the text columns, turn empty text into NULL and require some columns.

    Every row comes back with ``tag``: whether it has all required columns; the others are for
    quarantine. All white space goes, tabs and line breaks too.
    """
    _refuse_clash(df, tag)
    trimmed = df.withColumns(
        {c: F.nullif(F.btrim(c, F.lit(WHITE)), F.lit("")) for c in text}
    )
    return trimmed.withColumn(
        tag, reduce(Column.__and__, [F.col(c).isNotNull() for c in required])
    )


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    The remaining columns break ties, so the survivor does not depend on how rows
    are spread. Spark keeps one row per key in each map task before it shuffles
    (a window group limit), so a hot key does not reach one task whole.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    name = "_position"
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return df.withColumn(name, position).filter(F.col(name) == 1).drop(name)


def _refuse_clash(df: DataFrame, tag: str) -> None:
    if tag.lower() in map(str.lower, df.columns):
        raise ValueError(f"there is a column {tag} already: give another tag")


def _violates(rule: NotNull | InDomain) -> Column:
    col = F.col(rule.column)
    return col.isNull() if isinstance(rule, NotNull) else ~col.isin(*rule.values)
