"""Dimensions, facts and the incremental load.

Surrogate keys are computed from the natural keys, so facts resolve their keys without a join.
"""

from __future__ import annotations

import logging
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymart.config import CITY, REGION_LEVEL
from skymart.operators import quality, rollup
from skymart.schemas import FACT_MEASURES
from skymart.session import materialize, shared_dir
from skymart.sources.admin import location_id
from skymart.sources.warehouse import BUCKETS, Snapshot, Warehouse, partition_value

logger = logging.getLogger(__name__)

# Batch column -> dim_weather column.
WEATHER_COLUMNS = {
    "condition_code": "condition_code",
    "condition_desc": "condition_desc",
    "temp_class": "temp_classification",
    "humidity_class": "humidity_classification",
    "wind_class": "wind_classification",
    "rainfall_class": "rain_classification",
}


@dataclass(frozen=True)
class LoadResult:
    inserted: int = 0
    skipped: int = 0
    quality_issues: list[quality.Issue] = field(default_factory=list)


# -- keys ----------------------------------------------------------------------------------------


def time_key(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp"))


def weather_key(*parts: Column) -> Column:
    """Hash of all parts with nulls kept apart: a plain hash skips nulls and would mix them up."""
    named = [part.alias(f"p{i}") for i, part in enumerate(parts)]
    return F.xxhash64(F.to_json(F.struct(*named), {"ignoreNullFields": "false"}))


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def safe_num(df: DataFrame, name: str, kind: str) -> Column:
    """NaN and missing columns as null, otherwise the declared decimal; overflow raises.

    Noise below 1e-9, as left by summing doubles, is removed first: it would misplace ties.
    """
    if name in df.columns and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = F.col(name)
        return F.when(~F.isnan(value), F.round(value, 9)).cast(kind)
    return _optional(df, name, kind)


# -- L2 ------------------------------------------------------------------------------------------


def filter_new(df: DataFrame, watermark: datetime | None) -> DataFrame:
    """L2: rows strictly after the watermark; all rows without one."""
    return df if watermark is None else df.where(F.col("observed_at") > F.lit(watermark))


# -- dimensions ----------------------------------------------------------------------------------


def build_dim_time(batch: DataFrame) -> DataFrame:
    """L3: one row per timestamp of the batch; weeks start on Monday = 0."""
    ts = F.col("timestamp")
    return (
        batch.where(F.col("observed_at").isNotNull())
        .select(F.col("observed_at").cast("timestamp").alias("timestamp"))
        .distinct()
        .select(
            time_key(ts).alias("time_id"),
            "timestamp",
            F.to_date(ts).alias("date"),
            F.hour(ts).cast("smallint").alias("hour"),
            F.dayofmonth(ts).cast("smallint").alias("day"),
            F.month(ts).cast("smallint").alias("month"),
            F.year(ts).cast("smallint").alias("year"),
            F.weekday(ts).cast("smallint").alias("day_of_week"),
            (F.weekday(ts) >= 5).alias("is_weekend"),
        )
    )


def new_dim_time(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """L3: timestamps the dimension lacks."""
    return build_dim_time(batch).join(existing, "time_id", "left_anti")


def batch_locations(batch: DataFrame, city: str = CITY) -> DataFrame:
    """Locations of a batch with the coordinates of their first row."""
    order = [F.col(c) for c in ("observed_at", "raw_id") if c in batch.columns]
    place = F.struct(
        _optional(batch, "latitude", "decimal(9,6)").alias("latitude"),
        _optional(batch, "longitude", "decimal(9,6)").alias("longitude"),
    )
    return (
        batch.where(F.col("location").isNotNull())
        .groupBy(F.col("location").alias("district"))
        .agg(F.min_by(place, F.struct(*order)).alias("place"))
        .select(
            location_id(F.lit(city), F.col("district")).alias("location_id"),
            F.lit(city).alias("city"),
            "district",
            "place.latitude",
            "place.longitude",
        )
    )


def upsert_dim_location(existing: DataFrame, batch: DataFrame, city: str = CITY) -> DataFrame:
    """L4: the whole dimension after the batch; new coordinates win unless null."""
    new, old = batch_locations(batch, city).alias("n"), existing.alias("o")

    def prefer(first: str, second: str, name: str) -> Column:
        return F.coalesce(f"{first}.{name}", f"{second}.{name}").alias(name)

    return new.join(old, ["city", "district"], "full_outer").select(
        F.coalesce("n.location_id", "o.location_id").alias("location_id"),
        "city",
        "district",
        prefer("n", "o", "latitude"),
        prefer("n", "o", "longitude"),
        F.coalesce("o.region_level", F.lit(REGION_LEVEL)).alias("region_level"),
    )


def _weather_parts(batch: DataFrame) -> list[Column]:
    return [_optional(batch, name, "string") for name in WEATHER_COLUMNS]


def build_dim_weather(batch: DataFrame) -> DataFrame:
    """Distinct combinations of the batch; missing columns as null."""
    parts = [
        part.alias(name) for part, name in zip(_weather_parts(batch), WEATHER_COLUMNS.values())
    ]
    combos = batch.select(*parts).distinct()
    key = weather_key(*[F.col(name) for name in WEATHER_COLUMNS.values()])
    return combos.select(key.alias("weather_id"), *WEATHER_COLUMNS.values())


def extend_dim_weather(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Combinations the dimension lacks. The key encodes nulls, so the join is null-safe."""
    return build_dim_weather(batch).join(existing, "weather_id", "left_anti")


# -- facts ---------------------------------------------------------------------------------------


def fact_rows(batch: DataFrame, *, city: str = CITY, created_at: Column | None = None) -> DataFrame:
    """Rows with all keys resolved, plus the order in which they would have been written."""
    moment = F.col("observed_at").cast("timestamp")
    measures = [safe_num(batch, name, kind).alias(name) for name, kind in FACT_MEASURES.items()]
    return batch.where(F.col("observed_at").isNotNull() & F.col("location").isNotNull()).select(
        time_key(moment).alias("time_id"),
        location_id(F.lit(city), F.col("location")).alias("location_id"),
        weather_key(*_weather_parts(batch)).alias("weather_id"),
        *measures,
        _optional(batch, "wind_direction", "string").alias("wind_direction"),
        _optional(batch, "source", "string").alias("source"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.to_date(moment).alias("date"),
        _optional(batch, "raw_id", "bigint").alias("__order"),
    )


def upsert_fact(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Last row per (time, location); the first ``created_at`` of a key is kept.

    Grouped aggregation combines copies of a key before the shuffle.
    """
    if existing is not None:
        old = existing.withColumns({"__order": F.lit(None).cast("bigint"), "__new": F.lit(False)})
        rows = old.unionByName(rows.withColumn("__new", F.lit(True)))
    else:
        rows = rows.withColumn("__new", F.lit(True))
    keys = ["time_id", "location_id", "date"]
    payload = [c for c in rows.columns if c not in (*keys, "created_at", "__order", "__new")]
    latest = F.max_by(F.struct(*payload), F.struct("__new", "__order"))
    return (
        rows.groupBy(*keys)
        .agg(latest.alias("__row"), F.min("created_at").alias("created_at"))
        .select(*keys, "__row.*", "created_at")
    )


# -- L7 ------------------------------------------------------------------------------------------


def load(
    df: DataFrame,
    warehouse: Warehouse,
    *,
    skip_quality: bool = False,
    city: str = CITY,
    extra: dict[str, list[str]] | None = None,
    base: Snapshot | None = None,
) -> LoadResult:
    """Quality gate, watermark filter, dimensions, facts; published in one step.

    The new rows are written once to the shared folder and read back by column for each table;
    the quality counts over the whole input are gathered by the same pass.
    A normal load only appends facts; days that hold facts newer than the watermark are merged.
    ``extra`` tables are published together with the load.
    """
    base = base or warehouse.snapshot()
    watch = quality.QualityWatch(df)
    if watch.missing and not skip_quality:
        raise quality.refusal([quality.Issue(quality.NO_COLUMN, name) for name in watch.missing])
    stage = f"{shared_dir(warehouse.spark)}/stage-{uuid.uuid4().hex}"
    try:
        batch = materialize(filter_new(watch.frame, base.watermark), stage)
        issues = [] if skip_quality else watch.issues()
        for issue in issues:
            logger.warning("Quality issue: %s", issue)
        if quality.blocks_load(issues):
            raise quality.refusal(issues)
        stats = batch.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("observed_at").isNotNull() & F.col("location").isNotNull()).alias("ok"),
            F.max(F.unix_micros(F.col("observed_at").cast("timestamp"))).alias("last"),
            F.collect_set(F.to_date("observed_at")).alias("dates"),
        ).first()
        if stats["rows"] == 0:
            if extra:
                warehouse.publish(base, extra, base.watermark_us)
            return LoadResult(quality_issues=issues)

        tables = dict(extra or {})
        tables.update(_write_dimensions(batch, warehouse, base, city))
        tables.update(_write_facts(batch, warehouse, base, city, stats["dates"], tables))
        watermark = base.watermark_us if stats["last"] is None else stats["last"]
        warehouse.publish(base, tables, watermark)
        return LoadResult(stats["ok"], stats["rows"] - stats["ok"], issues)
    finally:
        warehouse.delete(stage)


#: Directories a growing dimension may consist of before it is rewritten as one.
MAX_DIRECTORIES = 32
#: Directories a day may consist of before the next load of that day merges them.
MAX_DAY_DIRECTORIES = 8


def _grow(warehouse: Warehouse, base: Snapshot, name: str, added: DataFrame) -> list[str]:
    published = base.tables.get(name, [])
    if len(published) < MAX_DIRECTORIES:
        return published + warehouse.write(added, name)
    return warehouse.write(warehouse.table(name, snapshot=base).unionByName(added), name)


def _write_dimensions(
    batch: DataFrame, warehouse: Warehouse, base: Snapshot, city: str
) -> dict[str, list[str]]:
    times, places, weather = (
        warehouse.table(name, snapshot=base) for name in ("dim_time", "dim_location", "dim_weather")
    )
    locations = upsert_dim_location(places, batch, city)
    known = base.tables.get("dim_location")
    changed = not known or not locations.exceptAll(places).isEmpty()
    return {
        "dim_time": _grow(warehouse, base, "dim_time", new_dim_time(times, batch)),
        "dim_location": warehouse.write(locations, "dim_location") if changed else known,
        "dim_weather": _grow(warehouse, base, "dim_weather", extend_dim_weather(weather, batch)),
    }


def _write_facts(
    batch: DataFrame,
    warehouse: Warehouse,
    base: Snapshot,
    city: str,
    dates: list,
    dimensions: dict[str, list[str]],
) -> dict[str, list[str]]:
    """Directories of the facts and their aggregates after the load.

    Rows behind the watermark are not loaded, so they meet published ones only on days that hold facts
    newer than it: after it was moved back, or where there is none. Those days are rewritten, and days
    of many directories as well; all others grow by a directory.
    """
    rows = fact_rows(batch, city=city, created_at=F.lit(datetime.now(UTC)))
    published = base.tables.get("fact_weather", [])
    touched = {d.isoformat() for d in dates}
    parts = Counter(day for day in map(partition_value, published) if day in touched)
    there = set(parts)
    if there:
        existing = warehouse.table("fact_weather", snapshot=base, dates=dates)
        if base.watermark_us is not None:
            newer = existing.where(F.col("time_id") > base.watermark_us).select("date").distinct()
            there = {r.date.isoformat() for r in newer.collect()}  # at most the days of the batch
        there |= {day for day, n in parts.items() if n >= MAX_DAY_DIRECTORIES}
    facts = upsert_fact(rows)
    if there:
        met = F.col("date").cast("string").isin(sorted(there))
        merged = upsert_fact(rows.where(met), existing.where(met))
        facts = merged.unionByName(upsert_fact(rows.where(~met)))
    written = warehouse.write(facts, "fact_weather")
    return {
        "fact_weather": _but(published, there) + written,
        **_write_rollups(warehouse, base, warehouse.read("fact_weather", written), there, dimensions),
    }


def _but(paths: list[str], parts: set[str]) -> list[str]:
    return [path for path in paths if partition_value(path) not in parts]


def _write_rollups(
    warehouse: Warehouse,
    base: Snapshot,
    facts: DataFrame,
    there: set[str],
    dimensions: dict[str, list[str]],
) -> dict[str, list[str]]:
    """Directories of the aggregates; ``facts`` are the written ones, ``there`` the days they replace."""
    if base.tables.get("fact_weather") and "fact_days" not in base.tables:
        return {}  # a warehouse from before the aggregates: they are computed when asked for
    places = warehouse.read("dim_location", dimensions["dim_location"])
    days = _grow_months(warehouse, base, "fact_days", rollup.by_day(facts), there)
    covered = _grow_months(warehouse, base, "time_coverage", rollup.coverage(facts, places), there)
    new, merged, all_days = rollup.by_day(facts), None, None
    if there:  # a merged day holds all its locations, those it had before as well
        merged = new.where(F.col("date").cast("string").isin(sorted(there))).select("location_id").distinct()
        all_days = warehouse.read("fact_days", days)
    totals = regroup(
        warehouse,
        base,
        "location_totals",
        new.select(rollup.bucket_of("location_id", BUCKETS).alias("bucket")),
        lambda old: rollup.changed_totals(old, new, all_days, merged),
        "location_id",
    )
    return {
        "fact_days": days,
        "time_coverage": covered,
        "location_totals": totals,
    }


def _grow_months(
    warehouse: Warehouse, base: Snapshot, table: str, added: DataFrame, there: set[str]
) -> list[str]:
    """Directories of an aggregate by month: months of merged days or many directories are rewritten."""
    published = base.tables.get(table, [])
    parts = Counter(map(partition_value, published))
    months = {day[:7] for day in there} | {m for m, n in parts.items() if n >= MAX_DAY_DIRECTORIES}
    old = [path for path in published if partition_value(path) in months]
    if old:
        kept = warehouse.read(table, old)
        if there:
            kept = kept.where(~F.col("date").cast("string").isin(sorted(there)))
        added = added.unionByName(kept)
    return _but(published, months) + warehouse.write(added, table)


def regroup(
    warehouse: Warehouse,
    base: Snapshot,
    table: str,
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    key: str,
) -> list[str]:
    """Rewrite the touched buckets of a table with one row per ``key``.

    ``change`` gives the changed rows of the old ones; all others of these buckets stay as they are.
    """
    buckets = [r[0] for r in touched.distinct().collect()]  # at most BUCKETS
    old = warehouse.table(table, snapshot=base, buckets=buckets)
    changed = change(old.drop("bucket")).withColumn("bucket", rollup.bucket_of(key, BUCKETS))
    kept = old.join(changed.select(key), key, "left_anti")
    written = warehouse.write(kept.unionByName(changed), table)
    return _but(base.tables.get(table, []), {str(b) for b in buckets}) + written
