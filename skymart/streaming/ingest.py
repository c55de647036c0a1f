"""Incremental ingest of raw files (ST1-ST3).

A batch run recomputes the features of the whole history. The stream keeps per-location running
totals instead: the fact history is not read again. Totals lie in hash buckets of locations, and a
micro-batch rewrites the buckets of its own locations only. It reads the time dimension, and rewrites
the location dimension when a location is new or moved.

Of rows with one location (as written) and time, the first to arrive counts; within a micro-batch the
smallest raw_id. So the facts are those of a batch run if raw ids rise with arrival.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skymart.config import CITY, DEFAULTS, DocumentKeys, Settings
from skymart.operators.enrich import classify
from skymart.operators.load import LoadResult, load, regroup
from skymart.operators.parse import floor_slot
from skymart.operators.rollup import bucket_of
from skymart.plans.transform import cleaned_observations
from skymart.schemas import RAW
from skymart.session import materialize, shared_dir
from skymart.sources.warehouse import BUCKETS, Warehouse


#: Column with the location before standardization.
GIVEN = "__given_location"


@dataclass(frozen=True)
class BatchResult:
    load: LoadResult
    late: int
    repeated: int


def slot_3h(instant: Column) -> Column:
    """ST3: start of the tumbling 3-hour slot (00, 03, ... UTC)."""
    return floor_slot(instant, 3)


def slot_counts(rows: DataFrame, time: str = "observed_at") -> DataFrame:
    """ST3 as a windowed aggregate; works on batch and streaming frames."""
    return rows.groupBy(F.window(time, "3 hours")).agg(
        F.count(F.lit(1)).alias("observations")
    ).select(F.col("window.start").alias("slot"), "observations")


def late_rows(df: DataFrame, watermark: datetime | None) -> DataFrame:
    """ST2: rows at or before the watermark, which a load leaves out."""
    return df.where(F.lit(False) if watermark is None else F.col("observed_at") <= F.lit(watermark))


def _batch_totals(rows: DataFrame) -> DataFrame:
    def total(name: str, short: str) -> list[Column]:
        return [F.count(name).alias(f"{short}_count"), F.sum(name).alias(f"{short}_sum")]

    return (
        rows.where(F.col("location").isNotNull())
        .groupBy("location")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *total("temperature", "temp"),
            F.max("temperature").alias("temp_max"),
            F.min("temperature").alias("temp_min"),
            *total("humidity", "humidity"),
            *total("pressure", "pressure"),
        )
    )


def merge_totals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Running totals after a batch."""
    summed = [c for c in old.columns if c.endswith(("rows", "_count", "_sum"))]
    return (
        old.unionByName(new)
        .groupBy("location")
        .agg(
            *[F.sum(c).alias(c) for c in summed],
            F.max("temp_max").alias("temp_max"),
            F.min("temp_min").alias("temp_min"),
        )
        .select(*old.columns)
    )


def with_running_features(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """F1 from running totals."""

    def mean(short: str) -> Column:
        return F.col(f"{short}_sum") / F.nullif(f"{short}_count", F.lit(0))

    features = totals.select(
        "location",
        mean("temp").alias("temp_avg"),
        "temp_max",
        "temp_min",
        mean("humidity").alias("humidity_avg"),
        mean("pressure").alias("pressure_avg"),
    )
    return rows.join(features, "location", "left")


def ingest_batch(
    raw: DataFrame,
    warehouse: Warehouse,
    keys: DocumentKeys,
    settings: Settings = DEFAULTS,
    *,
    city: str = CITY,
) -> BatchResult:
    """ST1: one batch of raw rows into the warehouse; replaying a batch changes nothing.

    Late rows count towards the features, as they would in a full recomputation, but not as facts.
    A (location, time) seen before is dropped; only the days of the late rows are searched for it,
    as newer rows cannot have been seen.
    """
    base = warehouse.snapshot()
    stage = f"{shared_dir(warehouse.spark)}/stage-{uuid.uuid4().hex}"
    try:
        rows = materialize(cleaned_observations(raw, keys, given=GIVEN), f"{stage}/cleaned")
        late = late_rows(rows, base.watermark)
        summary = late.agg(
            F.count(F.lit(1)).alias("late"), F.collect_set(F.to_date("observed_at")).alias("days")
        ).first()
        unseen = rows
        if summary["late"]:
            seen = warehouse.table("seen_keys", snapshot=base, dates=summary["days"])
            seen = seen.withColumnRenamed("location", GIVEN)
            keys = [GIVEN, "observed_at"]
            fresh = rows.where(F.col("observed_at") > F.lit(base.watermark))
            unseen = fresh.unionByName(late.join(seen.select(*keys), keys, "left_anti"))
            unseen = materialize(unseen, f"{stage}/unseen")
        count = unseen.count()
        repeated = rows.count() - count if summary["late"] else 0
        if count == 0:
            return BatchResult(LoadResult(), summary["late"], repeated)

        new = materialize(_batch_totals(unseen), f"{stage}/totals")
        totals_dirs = regroup(
            warehouse,
            base,
            "location_stats",
            new.select(bucket_of("location", BUCKETS).alias("bucket")),
            lambda old: merge_totals(old.join(new, "location", "left_semi"), new),
            "location",
        )
        here = [p for p in totals_dirs if p not in set(base.tables.get("location_stats", []))]
        totals = warehouse.read("location_stats", here)
        # Copies are told by the location as written, as in the batch run.
        keyed = unseen.select(
            F.col(GIVEN).alias("location"), "observed_at", F.to_date("observed_at").alias("date")
        ).where(F.col("observed_at").isNotNull())
        extra = {
            "location_stats": totals_dirs,
            "seen_keys": base.tables.get("seen_keys", []) + warehouse.write(keyed, "seen_keys"),
        }
        features = classify(with_running_features(unseen.drop(GIVEN), totals), settings)
        result = load(features, warehouse, city=city, extra=extra, base=base)
        return BatchResult(result, summary["late"], repeated)
    finally:
        warehouse.delete(stage)


def ingest_stream(
    spark: SparkSession,
    source: str,
    warehouse: Warehouse,
    keys: DocumentKeys,
    *,
    checkpoint: str,
    fmt: str = "parquet",
    settings: Settings = DEFAULTS,
    max_files_per_trigger: int = 1_000,
) -> StreamingQuery:
    """ST1: ingest all new raw files and stop; the checkpoint remembers them.

    A batch that was published before a failure is replayed and then holds only seen rows.
    """
    stream = (
        spark.readStream.schema(RAW)
        .format(fmt)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(source)
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch.select("raw_id", "source", "raw_json", "observed_at"), warehouse, keys, settings)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
