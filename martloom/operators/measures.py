"""Aggregates that can be taken in two steps.

A mart that groups facts by a dimension's *name* first aggregates the facts by the
dimension's *key*, then looks the name up and merges. The big table is reduced
before it meets the dimension, so that join is small whichever way Spark runs it,
and the merge keeps the result the same when two keys share a name or a key occurs
twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimals of all measures, or of each by column name; columns not named are added as doubles.
Scale = int | Mapping[str, int] | None

#: Doubles are added as whole numbers of these powers of two, each of about so many bits. Of 26 bits
#: a long holds the sum of 10^11.
_DIGIT_BITS = 26
_PLACES = tuple(range(-104, 53, _DIGIT_BITS))
#: From here on (some 1.5e23) a double has bits above the highest digit.
_LIMIT = 2.0 ** (_PLACES[-1] + _DIGIT_BITS - 1)


@dataclass(frozen=True)
class Measure:
    """Count, total, average, minimum and maximum of one numeric column.

    ``scale=None`` adds doubles in fixed point: a value is cut into digits of 26 bits, from
    2^-104 to 2^78, whose sums are whole numbers, and only the sum of all is rounded. So the total is
    the same bits whatever the order, partitioning or retry, and within a bit of the exact
    one. A value that is not a multiple of 2^-104 (it is smaller than some 4e-16) is rounded to one
    first. NaN and infinities give what doubles give. Finite values from 1.5e23 on are added as
    plain doubles, the only ones whose last bits depend on the order.

    ``scale=n`` says that values have at most n decimals and adds
    them as whole units of 10^-n in a long: the same on every run too, with one sum instead of
    eight. A value with more decimals, NaN, an infinity, or a
    total beyond 9.2e18 units (all line prices of a 100 TB TPC-H database, in
    cents, are about 2.3e18) raises, whether ANSI mode is on or off; nothing is
    rounded. A mapping gives each column's own scale.

    Without a scale, decimals and integers (``doubles=False``) are added as they are, which is exact.
    """

    column: str
    scale: Scale = None
    doubles: bool = True

    @classmethod
    def of(cls, rows: DataFrame, column: str, scale: Scale = None) -> Measure:
        """For a column of the type that it has in ``rows``."""
        kind = rows.select(column).schema[0].dataType
        return cls(column, scale, isinstance(kind, (T.FloatType, T.DoubleType)))

    @property
    def decimals(self) -> int | None:
        if isinstance(self.scale, Mapping):
            return self.scale.get(self.column)
        return self.scale

    def _units(self, col: Column) -> Column:
        """Whole units; equal to the value again when divided, or an error."""
        value, one = col.cast("double"), float(10**self.decimals)
        units = F.rint(value * one).try_cast("long")
        exact = F.coalesce(units.cast("double") / one == value, F.lit(False))
        problem = F.concat(
            F.lit(f"{self.column} is not a number of at most {self.decimals} decimals: "),
            value.cast("string"),
        )
        return F.when(value.isNull(), F.lit(None)).when(exact, units).otherwise(
            F.raise_error(problem).cast("long")
        )

    def _checked(self, part: str) -> Column:
        """A sum of whole numbers, which is NULL without values; NULL with values is an overflow."""
        total, n = F.col(self._part(part)), F.col(self._part("n"))
        overflow = F.raise_error(F.lit(f"the total of {self.column} does not fit a long"))
        return F.when(total.isNull() & (n > 0), overflow.cast("long")).otherwise(total)

    def _digits(self, value: Column) -> list[Column]:
        """How many of each power of two add up to a value; 0 for one that ``_LIMIT`` leaves out.

        Rounding to a place and taking off what is rounded at the next leaves at most half a unit of
        the next, and the difference is exact.
        """
        held = F.when(F.abs(value) < _LIMIT, value)
        rounded = [F.rint(held * 2.0**-place) for place in _PLACES]
        higher = [x * 2.0**_DIGIT_BITS for x in rounded[1:]] + [F.lit(0.0)]
        return [
            F.coalesce((one - more).cast("long"), F.lit(0).cast("long"))
            for one, more in zip(rounded, higher, strict=True)
        ]

    @property
    def _in_digits(self) -> bool:
        return self.decimals is None and self.doubles

    @property
    def _sums(self) -> list[str]:
        """The sums of whole numbers that the total is made of."""
        if self._in_digits:
            return [f"sum{k}" for k in range(len(_PLACES))]
        return [] if self.decimals is None else ["sum"]

    @property
    def _rest(self) -> list[str]:
        """What is added as Spark adds it."""
        return ["rest"] if self.decimals is None else []

    def first(self) -> list[Column]:
        """Partial aggregates over raw rows."""
        col = F.col(self.column)
        whole, rest = [], []
        if self._in_digits:
            value = col.cast("double")
            whole, rest = self._digits(value), [F.when(~(F.abs(value) < _LIMIT), value)]
        elif self.decimals is None:
            rest = [col]
        else:
            whole = [self._units(col)]
        return [
            F.count(col).alias(self._part("n")),
            *(F.try_sum(x).alias(self._part(p)) for x, p in zip(whole, self._sums, strict=True)),
            *(F.sum(x).alias(self._part(p)) for x, p in zip(rest, self._rest, strict=True)),
            F.min(col).alias(self._part("min")),
            F.max(col).alias(self._part("max")),
        ]

    def merge(self) -> list[Column]:
        """The same aggregates over rows that ``first`` or ``merge`` produced."""
        return [
            F.sum(self._part("n")).alias(self._part("n")),
            *(F.try_sum(self._checked(p)).alias(self._part(p)) for p in self._sums),
            *(F.sum(self._part(p)).alias(self._part(p)) for p in self._rest),
            F.min(self._part("min")).alias(self._part("min")),
            F.max(self._part("max")).alias(self._part("max")),
        ]

    @property
    def total(self) -> Column:
        """NULL when the group has no value."""
        if self.decimals is not None:
            return self._checked("sum") / float(10**self.decimals)
        if not self.doubles:
            return F.col(self._part("rest")).cast("double")
        digits = [self._checked(p) for p in self._sums]
        # Of values of one sign no more than half of a digit's sum is taken off by the next ones.
        one_sign = (F.col(self._part("min")) >= 0) | (F.col(self._part("max")) <= 0)
        added = F.when(one_sign, _added_up(digits)).otherwise(_from_digits(digits))
        total = added + F.coalesce(self._part("rest"), F.lit(0.0))
        return F.when(F.col(self._part("n")) > 0, total)

    @property
    def average(self) -> Column:
        """NULL when the group has no value (NULL / 0 does not raise)."""
        return self.total / F.col(self._part("n"))

    @property
    def minimum(self) -> Column:
        return F.col(self._part("min"))

    @property
    def maximum(self) -> Column:
        return F.col(self._part("max"))

    def _part(self, what: str) -> str:
        return f"{self.column}__{what}"


def _added_up(sums: list[Column]) -> Column:
    """A number given by sums of digits, added as doubles from the lowest on."""
    value = F.lit(0.0)
    for digit in sums:
        value = value * F.lit(2.0**-_DIGIT_BITS) + digit.cast("double")
    return value * F.lit(2.0 ** _PLACES[-1])


def _from_digits(sums: list[Column]) -> Column:
    """The double next to a number given by sums of digits, from the lowest on.

    What a digit has too much of is carried to the next, to the nearest, so that no digit is
    larger than half of the next one's unit and nothing cancels when they are added as doubles.
    """
    half, down = 1 << (_DIGIT_BITS - 1), 2.0**-_DIGIT_BITS

    def carried(acc: Column, digit: Column) -> Column:
        whole = digit + acc["carry"]
        carry = F.shiftright(whole + F.lit(half), _DIGIT_BITS)
        left = whole - F.shiftleft(carry, _DIGIT_BITS)
        value = acc["value"] * F.lit(down) + left.cast("double")
        return F.struct(carry.alias("carry"), value.alias("value"))

    def scaled(acc: Column) -> Column:
        top = acc["carry"].cast("double") * F.lit(1 / down) + acc["value"]
        return top * F.lit(2.0 ** _PLACES[-1])

    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("value"))
    return F.aggregate(F.array(*sums), start, carried, scaled)


def merged_counts(*names: str) -> list[Column]:
    """Add up counts and integer sums from the first step, keeping their names."""
    return [F.sum(name).alias(name) for name in names]
