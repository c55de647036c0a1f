"""Weather observations derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Condition text of an event type.
CONDITIONS = {
    "click": "Cerah",
    "view": "Berawan",
    "purchase": "Hujan Sedang",
    "signup": "Cerah Berawan",
}
OTHER_CONDITION = "Hujan Petir"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event, with decimal measures built from integer cents."""
    events = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    cents = F.round(F.col("value") * 100).cast("bigint")
    tenth = F.call_function("div", F.col("__cents"), F.lit(10))
    parent = F.lpad((F.col("user_id") % 21 + 1).cast("string"), 2, "0")
    child = (F.lit(1001) + F.call_function("div", F.col("user_id"), F.lit(21))).cast("string")
    condition = F.lit(OTHER_CONDITION)
    for kind, text in CONDITIONS.items():
        condition = F.when(F.col("event_type") == kind, F.lit(text)).otherwise(condition)
    ts = F.col("ts").cast("timestamp")
    return events.withColumns({"__k": k, "__cents": cents}).select(
        F.col("event_id").alias("raw_id"),
        ts.alias("observed_at"),
        F.timestamp_seconds(F.call_function("div", F.unix_seconds(ts), F.lit(10800)) * 10800).alias(
            "slot"
        ),
        F.concat(F.lit("12.71."), parent, F.lit("."), child).alias("location"),
        F.lit("Events").alias("source"),
        ((F.lit(350) + F.col("user_id") % 21) / F.lit(100)).cast("decimal(9,6)").alias("latitude"),
        ((F.lit(98600) + F.call_function("div", F.col("user_id"), F.lit(21))) / F.lit(1000))
        .cast("decimal(9,6)")
        .alias("longitude"),
        ((F.lit(1800) + tenth) / F.lit(100)).cast("decimal(5,2)").alias("temperature"),
        (F.col("__k") + 5).cast("decimal(5,2)").alias("humidity"),
        (F.lit(1000) + F.col("__k") % 20).cast("decimal(7,2)").alias("pressure"),
        (F.col("event_id") * 37 % 360).cast("int").alias("wind_deg"),
        (F.col("event_id") % 50).cast("decimal(5,2)").alias("wind_speed"),
        F.when(F.col("event_type") == "purchase", (tenth / F.lit(100)).cast("decimal(6,2)"))
        .otherwise(F.lit(0).cast("decimal(6,2)"))
        .alias("rainfall"),
        (F.col("__k") % 17).cast("decimal(4,2)").alias("uv_index"),
        F.when(F.col("__k") % 10 != 0, (F.col("__k") / F.lit(10)).cast("decimal(5,2)")).alias(
            "visibility"
        ),
        F.col("__k").cast("decimal(5,2)").alias("cloud_coverage"),
        F.col("event_type").alias("condition_code"),
        condition.alias("condition_desc"),
    )
