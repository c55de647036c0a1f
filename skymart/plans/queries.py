"""Parameterized queries over the warehouse."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymart.config import CODE_PATTERN
from skymart.plans.views import (
    WEATHER,
    Star,
    combined_mean,
    latest_per_district,
    micros,
    observed_at,
    partial_sums,
    trend_columns,
    utc,
    with_district,
    with_weather,
    within,
)
from skymart.sources.admin import district_names

UNKNOWN_PARENT = "Unknown"

SNAPSHOT = (
    "temperature",
    "humidity",
    "pressure",
    "wind_direction",
    "wind_speed",
    "rainfall",
    "visibility",
    "cloud_coverage",
)


def clamp(value: str | int | None, default: int = 24, low: int = 1, high: int = 96) -> int:
    """Integer parameter: leading digits count, anything else or zero means the default."""
    found = re.match(r"\s*([+-]?\d+)", str(default if value is None else value))
    number = (int(found.group(1)) if found else 0) or default
    return min(max(number, low), high)


# -- locations -----------------------------------------------------------------------------------

#: Up to this many location keys a filter is put into the scan as literals.
MAX_LITERAL_KEYS = 1_000


def at_locations(star: Star, condition: Column) -> Star:
    """Facts of the matching districts only.

    A short key list reaches the parquet scan, whose row groups are sorted by location; a long one
    becomes a semi join.
    """
    matching = star.dim_location.where(condition)
    keys = [row[0] for row in matching.select("location_id").take(MAX_LITERAL_KEYS + 1)]
    return star.at(matching, keys if len(keys) <= MAX_LITERAL_KEYS else None)


def under(parent: str) -> Column:
    """Districts below a parent code."""
    return F.col("district").startswith(f"{parent}.")


# -- snapshot ------------------------------------------------------------------------------------

#: Days around ``as_of`` searched one after the other; None searches everything.
SEARCH_DAYS = (1, 16, 256, None)


def _nearest(covered: DataFrame, as_of: datetime, min_locations: int) -> DataFrame:
    return (
        covered.where(F.col("districts") >= min_locations)
        .orderBy(F.abs(F.col("time_id") - micros(as_of)), "time_id")
        .limit(1)
        .select("time_id", F.col("districts").alias("locations"))
    )


def closest_timestamp(
    star: Star,
    *,
    as_of: datetime | None = None,
    min_locations: int = 10,
    pattern: str = CODE_PATTERN,
) -> DataFrame:
    """G1: the timestamp nearest to ``as_of`` with enough coded districts; the earlier on a tie.

    Searched are the numbers of coded districts that a load keeps per timestamp; for another pattern
    they are counted from the facts. A hit inside the searched days is nearer than anything outside
    them, so the search usually reads a few days.
    """
    as_of = utc(as_of)
    for days in SEARCH_DAYS:
        around = star.coverage(pattern)
        if days is not None:
            span = timedelta(days=days)
            months = (f"{as_of - span:%Y-%m}", f"{as_of + span:%Y-%m}")
            around = within(around, as_of - span, as_of + span).where(F.col("month").between(*months))
        hit = _nearest(around, as_of, min_locations).collect()
        if hit or days is None:
            break
    return star.fact.sparkSession.createDataFrame(hit, "time_id bigint, locations bigint").select(
        observed_at().alias("timestamp"), "locations"
    )


def _at_closest(star: Star, **parameters) -> Star:
    """Facts of the closest timestamp, read from its own day only."""
    closest = closest_timestamp(star, **parameters).select(F.unix_micros("timestamp")).first()
    if closest is None:
        return star.only(star.fact.where(F.lit(False)))
    instant = utc(datetime(1970, 1, 1)) + timedelta(microseconds=closest[0])
    return star.between(instant, instant)


def _snapshot(star: Star) -> DataFrame:
    placed = with_district(star.fact, star, "latitude", "longitude")
    return with_weather(placed, star, *WEATHER).select(
        "district",
        "latitude",
        "longitude",
        *SNAPSHOT,
        *WEATHER,
        observed_at().alias("observed_at"),
        "source",
    )


def current(
    star: Star,
    *,
    as_of: datetime | None = None,
    district: str | None = None,
    min_locations: int = 10,
    pattern: str = CODE_PATTERN,
) -> DataFrame:
    """All facts at the closest timestamp, or those of one district."""
    moment = _at_closest(star, as_of=as_of, min_locations=min_locations, pattern=pattern)
    if district is not None:
        moment = at_locations(moment, F.col("district") == district)
    return _snapshot(moment)


def with_parent(df: DataFrame, missing: Column) -> DataFrame:
    """Add the parent district's name, found by the code's first eight characters."""
    names = F.broadcast(district_names(df.sparkSession))  # 21 rows
    return (
        df.withColumn("prefix", F.substring("district", 1, 8))
        .join(names, "prefix", "left")
        .withColumn("kecamatan", F.coalesce("kecamatan", missing))
        .drop("prefix")
    )


def weather_map(
    star: Star,
    *,
    as_of: datetime | None = None,
    min_locations: int = 10,
    pattern: str = CODE_PATTERN,
) -> DataFrame:
    """The snapshot of coded districts with their parent's name."""
    snapshot = current(star, as_of=as_of, min_locations=min_locations, pattern=pattern)
    return with_parent(snapshot.where(F.col("district").rlike(pattern)), F.lit(UNKNOWN_PARENT))


# -- forecast ------------------------------------------------------------------------------------


def _first_districts(star: Star, rows: int) -> Star:
    """The first districts that have ``rows`` facts together."""
    if star.totals is None:
        return star
    districts = with_district(star.totals.select("location_id", "rows"), star).groupBy("district")
    listed = districts.agg(F.sum("rows").alias("rows"), F.collect_list("location_id").alias("keys"))
    names, keys, found = [], [], 0
    for row in listed.orderBy("district").limit(rows).collect():  # each has a row at least
        if found >= rows:
            break
        names.append(row["district"])
        keys += row["keys"]
        found += row["rows"]
    places = star.dim_location.where(F.col("district").isin(names) if names else F.lit(False))
    return star.at(places, keys if len(keys) <= MAX_LITERAL_KEYS else None)


def forecast(
    star: Star,
    *,
    adm4: str | None = None,
    kecamatan: str | None = None,
    limit: str | int | None = None,
) -> DataFrame:
    """Newest rows of a code, of a parent, or the first rows by district.

    The limit is global. Equal timestamps come in district order. Without a code or parent, the row
    counts per location tell which districts in order hold the rows, and only their facts are read.
    """
    wanted = clamp(limit)
    order = [F.desc("time_id"), F.asc("district")]
    if adm4:
        star = at_locations(star, F.col("district") == adm4)
    elif kecamatan:
        star = at_locations(star, under(kecamatan))
    else:
        star = _first_districts(star, wanted)
        order.reverse()
    top = with_district(star.fact, star).orderBy(*order).limit(wanted)
    return with_weather(top, star, "condition_desc", "temp_classification").select(
        "district",
        "temperature",
        "humidity",
        "rainfall",
        "wind_speed",
        "cloud_coverage",
        "condition_desc",
        "temp_classification",
        observed_at().alias("observed_at"),
        "temp_avg",
        "temp_max",
        "temp_min",
    )


def _newest_first(df: DataFrame, item: Column, name: str) -> DataFrame:
    """One row per district with its items in descending order of their first field."""
    return df.groupBy("district").agg(F.sort_array(F.collect_list(item), asc=False).alias(name))


def forecast_nested(rows: DataFrame) -> DataFrame:
    """Forecast rows as one list per district. Their number is bounded by the query's limit."""
    item = F.struct(
        "observed_at",
        "temperature",
        "humidity",
        "rainfall",
        "wind_speed",
        "cloud_coverage",
        F.col("condition_desc").alias("condition"),
        "temp_classification",
        F.struct("temp_avg", "temp_max", "temp_min").alias("aggregates"),
    )
    return _newest_first(rows, item, "observations")


# -- trend ---------------------------------------------------------------------------------------

TREND_NAMES = ("temp_ma", "humidity_ma", "rainfall_ma")


def trend(
    star: Star,
    *,
    adm4: str | None = None,
    kecamatan: str | None = None,
    limit: str | int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Newest rows per district with trailing means and changes.

    The frames look two rows back, so the newest ``limit + 2`` rows per district are all they need:
    every group is cut to that before the shuffle and the windows run on short groups.
    """
    if adm4:
        star = at_locations(star, F.col("district") == adm4)
    elif kecamatan:
        star = at_locations(star, under(kecamatan))
    wanted = clamp(limit)
    slim = replace(
        star, fact=star.fact.select("time_id", "location_id", "date", "temperature", "humidity", "rainfall")
    )
    line = Window.partitionBy("district").orderBy("time_id", F.desc("location_id"))
    columns = {name: make(line) for name, make in trend_columns(TREND_NAMES).items()}
    result = (
        latest_per_district(slim, wanted + 2)
        .select("*", *[value.alias(name) for name, value in columns.items()])
        .where(F.col("rn") <= wanted)
        .select(
            "district",
            "temperature",
            "humidity",
            "rainfall",
            observed_at().alias("observed_at"),
            *columns,
            "rn",
        )
    )
    return result.orderBy("district", F.desc("observed_at")) if ordered else result


def trend_nested(rows: DataFrame) -> DataFrame:
    """Trend rows as one list per district, at most the query's limit each."""
    item = F.struct(
        "observed_at",
        "temperature",
        "humidity",
        "rainfall",
        F.struct(
            F.col("temp_ma").alias("temperature"),
            F.col("humidity_ma").alias("humidity"),
            F.col("rainfall_ma").alias("rainfall"),
        ).alias("moving_averages"),
        F.struct(
            F.col("temp_delta").alias("temperature"), F.col("humidity_delta").alias("humidity")
        ).alias("deltas"),
    )
    return _newest_first(rows, item, "trend")


# -- heatmap and locations -----------------------------------------------------------------------


def heatmap(
    star: Star,
    *,
    as_of: datetime | None = None,
    hours: str | int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Averages of the last hours per district and position."""
    span = timedelta(hours=clamp(hours, high=168))
    measures = ("temperature", "rainfall", "humidity", "cloud_coverage")
    per_location = (
        star.between(utc(as_of) - span)
        .fact.groupBy("location_id")
        .agg(F.count(F.lit(1)).alias("rows"), *partial_sums(*measures))
    )
    result = (
        with_district(per_location, star, "latitude", "longitude")
        .groupBy("district", "latitude", "longitude")
        .agg(
            combined_mean("temperature", 1).alias("avg_temperature"),
            combined_mean("rainfall", 2).alias("avg_rainfall"),
            combined_mean("humidity", 1).alias("avg_humidity"),
            combined_mean("cloud_coverage", 1).alias("avg_cloud_coverage"),
            F.sum("rows").alias("data_points"),
        )
    )
    return result.orderBy("district") if ordered else result


def locations_flat(
    dim_location: DataFrame, names: DataFrame, *, pattern: str = CODE_PATTERN
) -> DataFrame:
    """Coded districts with their own and their parent's name, one row each."""
    coded = dim_location.where(F.col("district").rlike(pattern)).select("district").distinct()
    parents = with_parent(coded, F.substring("district", 1, 8))
    return parents.join(names.withColumnRenamed("adm4", "district"), "district", "left").select(
        "kecamatan",
        F.col("district").alias("adm4"),
        F.coalesce("desa", "district").alias("name"),
    )


def locations(
    dim_location: DataFrame, names: DataFrame, *, pattern: str = CODE_PATTERN
) -> DataFrame:
    """Parents in order, each with the sorted list of its sub-districts."""
    return (
        locations_flat(dim_location, names, pattern=pattern)
        .groupBy("kecamatan")
        .agg(F.array_sort(F.collect_list(F.struct("adm4", "name"))).alias("kelurahan"))
        .orderBy("kecamatan")
    )
