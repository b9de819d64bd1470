"""Numeric helpers shared by all operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c: Column | str, digits: int) -> Column:
    """Round half away from zero, the same on every partitioning.

    A double sum depends on the order of its parts in the last bits, which flips
    values that sit exactly between two roundings. Rounding to 9 digits first
    removes those bits.
    """
    return F.round(F.round(as_col(c), 9), digits)


def stable_round_double(c: Column | str, digits: int) -> Column:
    """`stable_round` of a double with at most 8 digits, the same to the last bit.

    Rounding a double goes through its decimal text. Away from the point where both roundings together turn (half a unit less
    half of the ninth digit) whole numbers of units tell the same; only values next to it, or too large, take the long way.
    """
    c, unit = as_col(c), 10.0**digits
    units = F.abs(c) * unit
    turn = 0.5 - 0.5e-9 * unit
    whole = F.floor(units + (1.0 - turn))
    clear = (units < 1e9) & (F.abs(units - F.floor(units) - turn) > 1e-6)
    return F.when(clear, F.when(c < 0, -whole).otherwise(whole) / unit).otherwise(stable_round(c, digits))


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column (two decimals), returned as double."""
    return F.sum(as_col(c).cast("decimal(20,2)")).cast("double")


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """top / bottom, with `default` where the result is null or the divisor is 0."""
    value = top / F.nullif(bottom.cast("double"), F.lit(0.0))
    return value if default is None else F.coalesce(value, F.lit(default))


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        c = F.greatest(F.lit(float(low)), c)
    if high is not None:
        c = F.least(F.lit(float(high)), c)
    return c


def finite(c: Column, default: float = 0.0) -> Column:
    """Null, NaN and infinities become `default` (NaN sorts above infinity)."""
    return F.when(F.abs(c) < float("inf"), c).otherwise(F.lit(default))


def flag(condition: Column) -> Column:
    """True -> 1.0, false or null -> 0.0."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
