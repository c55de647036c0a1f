"""Features, classes, trends, anomalies and prediction (F1, K5, T1, T2, A1, PR1).

Whole-history statistics of a location are a grouped aggregate joined back, not a window over the
location: the aggregate combines on the map side and the join splits hot locations, where a window
would read a location's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.config import DEFAULTS, Settings
from skymart.functions import classes, numeric
from skymart.functions.timeline import SLICE_ROWS, with_trailing

FEATURES = ("temp_avg", "temp_max", "temp_min", "humidity_avg", "pressure_avg")
SPREAD = ("__mean", "__std", "__count")


def location_profile(df: DataFrame, *, features: bool = True, spread: bool = True) -> DataFrame:
    """One row per non-null location with the statistics F1 and A1 need."""
    wanted: list[Column] = []
    if features:
        wanted += [
            numeric.mean(df, "temperature").alias("temp_avg"),
            F.max("temperature").alias("temp_max"),
            F.min("temperature").alias("temp_min"),
            numeric.mean(df, "humidity").alias("humidity_avg"),
            numeric.mean(df, "pressure").alias("pressure_avg"),
        ]
    if spread:
        wanted += [
            F.avg(F.col("temperature").cast("double")).alias("__mean"),
            F.stddev_samp(F.col("temperature").cast("double")).alias("__std"),
            F.count("temperature").alias("__count"),
        ]
    return df.where(F.col("location").isNotNull()).groupBy("location").agg(*wanted)


def add_features(df: DataFrame) -> DataFrame:
    """per-location averages and extremes on every row; null locations get nulls."""
    return df.drop(*FEATURES).join(location_profile(df, spread=False), "location", "left")


def classify(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """K5"""
    return df.withColumns(
        {
            "temp_class": classes.temperature_class(F.col("temperature"), settings),
            "humidity_class": classes.humidity_class(F.col("humidity"), settings),
            "wind_class": classes.wind_class(F.col("wind_speed"), settings),
            "rainfall_class": classes.rainfall_class(F.col("rainfall"), settings),
        }
    )


def _moving_columns(df: DataFrame, window: int) -> dict:
    def trailing(name: str):
        return lambda w: numeric.mean(df, name, w.rowsBetween(-(window - 1), 0))

    return {"temp_ma": trailing("temperature"), "humidity_ma": trailing("humidity")}


def _delta_columns() -> dict:
    def change(name: str):
        return lambda w: F.col(name) - F.lag(name).over(w)

    return {"temp_delta": change("temperature"), "humidity_delta": change("humidity")}


def _predicted_columns(df: DataFrame, window: int) -> dict:
    return {"predicted_temp": lambda w: numeric.mean(df, "temperature", w.rowsBetween(-window, -1))}


def _along_time(df: DataFrame, columns: dict, lookback: int, slice_rows: int) -> DataFrame:
    return with_trailing(
        df,
        columns,
        key="location",
        order="observed_at",
        tie=("raw_id",),
        lookback=lookback,
        inputs=("temperature", "humidity"),
        slice_rows=slice_rows,
    )


def moving_average(
    df: DataFrame, window: int | None = None, *, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Trailing mean of temperature and humidity; nulls skipped, one value is enough."""
    window = window or DEFAULTS.moving_avg_window
    return _along_time(df, _moving_columns(df, window), window, slice_rows)


def delta(df: DataFrame, *, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Change against the previous row of the location."""
    return _along_time(df, _delta_columns(), 1, slice_rows)


def compute_trends(
    df: DataFrame, window: int | None = None, *, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """T1 and T2 in one pass."""
    window = window or DEFAULTS.moving_avg_window
    columns = _moving_columns(df, window) | _delta_columns()
    return _along_time(df, columns, window, slice_rows)


def predict(
    df: DataFrame, window: int | None = None, *, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """PR1: mean of the previous ``window`` rows; null on the first row."""
    window = window or DEFAULTS.moving_avg_window
    return _along_time(df, _predicted_columns(df, window), window, slice_rows)


def _anomaly_flag(threshold: float) -> Column:
    distance = F.abs(F.col("temperature").cast("double") - F.col("__mean"))
    beyond = (F.col("__std") > 0) & (distance / F.nullif("__std", F.lit(0.0)) > F.lit(threshold))
    return F.coalesce((F.col("__count") >= 2) & beyond, F.lit(False))


def detect_anomalies(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """A1: absolute z-score by sample deviation above the threshold; never null."""
    threshold = threshold or DEFAULTS.anomaly_zscore_threshold
    profile = location_profile(df, features=False)
    return (
        df.join(profile, "location", "left")
        .withColumn("is_anomaly", _anomaly_flag(threshold))
        .drop(*SPREAD)
    )


def enrich(
    df: DataFrame, settings: Settings = DEFAULTS, *, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """F1, K5, T1, T2, A1 and PR1 with one aggregate, one join and one window shuffle."""
    window = settings.moving_avg_window
    columns = _moving_columns(df, window) | _delta_columns() | _predicted_columns(df, window)
    profiled = df.drop(*FEATURES).join(location_profile(df), "location", "left")
    flagged = profiled.withColumn(
        "is_anomaly", _anomaly_flag(settings.anomaly_zscore_threshold)
    ).drop(*SPREAD)
    return _along_time(classify(flagged, settings), columns, window, slice_rows)
