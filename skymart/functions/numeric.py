"""Exact means and rounding.

Sums over decimals run on their unscaled integers: exact, codegen-friendly, and wide enough for
trillions of rows, where a decimal sum would overflow its declared precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

AggWrapper = Callable[[Column], Column]


def over(window: WindowSpec | None) -> AggWrapper:
    """Wrap an aggregate in a window, or leave it for ``groupBy().agg``."""
    return (lambda agg: agg) if window is None else (lambda agg: agg.over(window))


def unscaled(value: Column, scale: int = 2) -> Column:
    """Integer number of 10**-scale units of a decimal column."""
    return (value * F.lit(10**scale)).cast("bigint")


def decimal_scale(df: DataFrame, name: str) -> int | None:
    kind = df.schema[name].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else None


def mean(df: DataFrame, name: str, window: WindowSpec | None = None) -> Column:
    """Mean of a column as double: exact sum for decimals, ``avg`` for doubles; nulls skipped."""
    wrap = over(window)
    scale = decimal_scale(df, name)
    if scale is None:
        return wrap(F.avg(name))
    total = wrap(F.sum(unscaled(F.col(name), scale)))
    count = wrap(F.count(name))
    return total.cast("double") / F.nullif(count * F.lit(10**scale), F.lit(0))


def round_half_away(total: Column, count: Column, places: int, scale: int = 2) -> Column:
    """``round(total / 10**scale / count, places)`` with ties away from zero, in integers.

    ``total`` is a bigint of 10**-scale units. Dividing first and rounding after would round
    twice and misplace ties.
    """
    parts = count * F.lit(10 ** (scale - places))
    whole = F.call_function("div", F.abs(total) * 2 + parts, F.nullif(parts * 2, F.lit(0)))
    signed = F.when(total < 0, -whole).otherwise(whole)
    return (signed / F.lit(10.0**places)).cast(T.DecimalType(18, places))


def round_mean(name: str, places: int, window: WindowSpec | None = None, scale: int = 2) -> Column:
    """SQL ``round(avg(decimal column), places)``, exact."""
    wrap = over(window)
    total = wrap(F.sum(unscaled(F.col(name), scale)))
    return round_half_away(total, wrap(F.count(name)), places, scale)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
