"""Column expressions the marts are made of; all run inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_day(col: Column) -> Column:
    """Calendar date of a date, timestamp or text column; bad text gives NULL.

    ``to_date`` raises on bad text under ANSI mode, which would abort a whole job
    for one bad row.
    """
    return col.try_cast("date")


def day_diff(end: Column, start: Column) -> Column:
    """Whole days from ``start`` to ``end``, ignoring the time of day."""
    return F.datediff(to_day(end), to_day(start))


def month_start(df: DataFrame, name: str) -> Column:
    """First day of the month: a 4-byte group key, far cheaper than its label."""
    col = F.col(name)
    if isinstance(_type_of(df, name), T.StringType):
        # Text may carry a zone offset, which only a timestamp cast applies.
        col = col.try_cast("timestamp")
    return F.trunc(to_day(col), "MM")


def month_label(col: Column) -> Column:
    """``yyyy-MM`` text of a date or timestamp."""
    return F.date_format(col, "yyyy-MM")


def flag(col: Column, value: str) -> Column:
    """1 where the column equals the value, else 0; NULL counts as 0."""
    return F.when(col == value, 1).otherwise(0)


def count_value(col: Column, value: str) -> Column:
    """Rows of a group whose column equals the value: the sum of ``flag``."""
    return F.count_if(col == value)


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.select(name).schema[0].dataType
