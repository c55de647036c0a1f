"""Aggregates of the facts that every load keeps up to date (behind V1, V2, V5, V6, G1, G7, G9).

``fact_days`` has one row per location and day, ``location_totals`` one per location, ``time_coverage``
one per timestamp. All of them are sums, counts and extremes of whole days: a load adds the rows
of the days it appends, and replaces those of the days it merges (in directories of a month). Totals of locations on merged days
are added up again from ``fact_days``, which also mends extremes that a merge took away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.config import CODE_PATTERN
from skymart.functions import numeric

MEASURES = ("temperature", "humidity", "wind_speed", "rainfall", "cloud_coverage")
SUMS = tuple(f"{name}_{kind}" for name in MEASURES for kind in ("sum", "n"))
SQUARES = "temperature_squares"


def by_day(facts: DataFrame) -> DataFrame:
    """One row per location and day; sums are integers of hundredths."""
    cents = numeric.unscaled(F.col("temperature"))
    sums = [
        total
        for name in MEASURES
        for total in (F.sum(numeric.unscaled(F.col(name))).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n"))
    ]
    days = facts.groupBy("location_id", "date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("time_id").alias("first"),
        F.max("time_id").alias("last"),
        F.min("temperature").alias("low"),
        F.max("temperature").alias("high"),
        *sums,
        F.sum((cents * cents).cast("decimal(14,0)")).cast("decimal(24,0)").alias(SQUARES),
    )
    return days.withColumn("month", month("date"))


def month(date: str | Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def by_location(parts: DataFrame) -> DataFrame:
    """Days, or totals, of one location added up."""
    return parts.groupBy("location_id").agg(
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(name).alias(name) for name in SUMS],
        F.sum(SQUARES).cast("decimal(24,0)").alias(SQUARES),
    )


def coverage(facts: DataFrame, places: DataFrame, pattern: str = CODE_PATTERN) -> DataFrame:
    """How many coded districts each timestamp has; timestamps without any are left out."""
    coded = places.where(F.col("district").rlike(pattern)).select("location_id", "district")
    return (
        facts.select("time_id", "date", "location_id")
        .join(coded, "location_id")
        .groupBy("time_id", "date")
        .agg(F.countDistinct("district").alias("districts"))
        .withColumn("month", month("date"))
    )


def changed_totals(
    totals: DataFrame, added: DataFrame, days: DataFrame | None = None, merged: DataFrame | None = None
) -> DataFrame:
    """Totals of the locations of ``added`` days after a load.

    ``merged`` names the locations whose days were replaced; theirs come from all their ``days``.
    """
    plain = added if merged is None else added.join(merged, "location_id", "left_anti")
    known = totals.join(plain.select("location_id").distinct(), "location_id", "left_semi")
    summed = plain.select(*[c for c in plain.columns if c in known.columns])
    result = by_location(known.select(summed.columns).unionByName(summed))
    if merged is None:
        return result
    return result.unionByName(by_location(days.join(merged, "location_id", "left_semi")))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
