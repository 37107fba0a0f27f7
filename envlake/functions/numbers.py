"""Numbers that are what they seem: finite, in range, exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column) -> Column:
    """A double from text or a number, null where it is none; NaN counts as none, infinity stays."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(PLAIN_NUMBER) | text.isin("Infinity", "-Infinity"), text.try_cast("double"))


def infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))


def finite(c: Column) -> Column:
    """c where it is a finite number, else null."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def outside(c: Column, low: float | None, high: float | None) -> Column:
    """Whether c is a number beyond its inclusive limits; null is not."""
    beyond = F.lit(False)
    if low is not None:
        beyond = beyond | (c < F.lit(low))
    if high is not None:
        beyond = beyond | (c > F.lit(high))
    return F.coalesce(beyond, F.lit(False))


def exact_decimal(c: Column, precision: int = 18, scale: int = 6) -> Column:
    """A text or number as decimal(precision, scale), null if it does not fit without rounding."""
    text = F.trim(c.cast("string"))
    small, wide = text.try_cast(f"decimal({precision},{scale})"), text.try_cast("decimal(38,18)")
    return F.when(small.cast("decimal(38,18)") == wide, small)


def strict_id(c: Column, what: str = "an id") -> Column:
    """A whole number as bigint; null stays null, anything else is an error when it is computed."""
    value = positive_id(c)
    return F.when(c.isNull() | value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"{what} is no positive whole number: "), c.cast("string"))))


def positive_id(c: Column) -> Column:
    """A positive whole number as bigint, else null."""
    value = c.try_cast("double")
    return F.when((value > 0) & (value == F.floor(value)), value.try_cast("bigint"))
