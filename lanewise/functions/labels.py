"""Small column functions: flags, bands, labels, postcodes, casts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 for true, 0 for false or null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def flag_in(value: Column, values: list, yes, no) -> Column:
    """`yes` when the value is listed, else `no`; a null value is not listed."""
    return F.when(value.isin(list(values)), F.lit(yes)).otherwise(F.lit(no))


def label_values(value: Column, labels: dict, default) -> Column:
    """The label of each listed value, `default` for all others and for null."""
    chain = reduce(lambda acc, item: acc.when(value == F.lit(item[0]), F.lit(item[1])), labels.items(), F)
    return chain.otherwise(F.lit(default))


def band(value: Column, bounds: list, null_band: int | None = None) -> Column:
    """Number of the first band whose upper bound is not below the value, counting from 1.

    Values above all bounds fall in one more band; null does too unless `null_band` is given.
    """
    rest = len(bounds) + 1
    chain = F if null_band is None else F.when(value.isNull(), F.lit(null_band))
    chain = reduce(lambda acc, item: acc.when(value <= F.lit(item[1]), F.lit(item[0])), enumerate(bounds, 1), chain)
    return chain.otherwise(F.lit(rest))


def fallback(value: Column, *others) -> Column:
    """The first non-null of a column and its fallbacks (columns or constants)."""
    return F.coalesce(value, *[other if isinstance(other, Column) else F.lit(other) for other in others])


def volume(*sides: Column) -> Column:
    """Product of the sides; null when one is null."""
    return reduce(lambda product, side: product * side, sides)


def pad_zip(code: Column, width: int = 5) -> Column:
    """Postcode text of exactly `width` characters: zeros on the left, or cut."""
    return F.lpad(code.cast("string"), width, "0")


def prefix(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def to_int(value: Column) -> Column:
    """Integer, null when the text is no number."""
    return value.try_cast("int")


def to_double(value: Column) -> Column:
    """Double, null when the text is no number."""
    return value.try_cast("double")


def round_half_even(value: Column) -> Column:
    """Nearest whole number, halves to the even one."""
    return F.rint(value)
