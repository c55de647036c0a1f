"""Cleaning and standardization."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymart.config import MEASURES, TEXT_COLUMNS, VALID_RANGES

KEY = ("observed_at", "location")
#: All Unicode white space, and the four separators U+001C to U+001F.
WHITE_SPACE = r"[\s\x1C-\x1F]+"


def drop_missing_required(df: DataFrame, columns: Sequence[str] = KEY) -> DataFrame:
    """C1"""
    return df.na.drop(subset=list(columns))


def dedupe_keep_first(
    df: DataFrame, keys: Sequence[str] = KEY, order_by: Sequence[str] = ("raw_id",)
) -> DataFrame:
    """First row per key in ``order_by`` order.

    The filter on the row number makes Spark keep one row per key and task before the shuffle, so
    a key with very many copies does not reach a single task.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def null_out_of_range(df: DataFrame, ranges: dict = VALID_RANGES) -> DataFrame:
    """Measures outside their inclusive range, and NaN, become null."""

    def checked(name: str, low, high) -> Column:
        value = F.col(name)
        valid = F.lit(True)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            valid = ~F.isnan(value)
        if low is not None:
            valid = valid & (value >= F.lit(low))
        if high is not None:
            valid = valid & (value <= F.lit(high))
        return F.when(valid, value)

    return df.withColumns(
        {name: checked(name, *bounds) for name, bounds in ranges.items() if name in df.columns}
    )


def to_utc(value: Column, kind: T.DataType) -> Column:
    """C4: timestamp of any timestamp or text value, null when it cannot be parsed."""
    return F.try_to_timestamp(value) if isinstance(kind, T.StringType) else value.cast("timestamp")


def trim_nullify(value: Column) -> Column:
    """Strip surrounding white space; blank and textual nulls become null."""
    text = F.regexp_replace(value.cast("string"), f"(?U)^{WHITE_SPACE}|{WHITE_SPACE}$", "")
    return F.when(~text.isin("", "None", "nan"), text)


def upper_wind(df: DataFrame) -> DataFrame:
    """C6"""
    if "wind_direction" not in df.columns:
        return df
    return df.withColumn("wind_direction", F.upper("wind_direction"))


def _count_rows(df: DataFrame, observation: Observation | None) -> DataFrame:
    return df if observation is None else df.observe(observation, F.count(F.lit(1)).alias("rows"))


def clean(
    df: DataFrame,
    *,
    order_by: Sequence[str] = ("raw_id",),
    rows_in: Observation | None = None,
    rows_out: Observation | None = None,
) -> DataFrame:
    """C1, C2 and C3. The observations count rows while the result is computed."""
    out = (
        _count_rows(df, rows_in)
        .transform(drop_missing_required)
        .transform(dedupe_keep_first, KEY, order_by)
        .transform(null_out_of_range)
    )
    return _count_rows(out, rows_out)


def standardize(df: DataFrame) -> DataFrame:
    """C4, C5 and C6. Runs after ``clean``, so rows differing only in blanks survive it."""
    changes = {"observed_at": to_utc(F.col("observed_at"), df.schema["observed_at"].dataType)}
    changes |= {name: trim_nullify(F.col(name)) for name in TEXT_COLUMNS if name in df.columns}
    return df.withColumns(changes).transform(upper_wind)


def exact_measures(df: DataFrame, kind: str = "decimal(18,6)") -> DataFrame:
    """Measures as decimals: their sums are exact and the same for every partitioning."""
    return df.withColumns({name: F.col(name).cast(kind) for name in MEASURES if name in df.columns})
