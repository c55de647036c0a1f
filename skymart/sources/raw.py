"""Staging area of raw provider documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.schemas import RAW


def read_raw_observations(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The four columns the transform reads. Order is imposed by the windows that need it."""
    return (
        spark.read.schema(RAW)
        .format(fmt)
        .load(path)
        .select("raw_id", "source", "raw_json", "observed_at")
    )


def append_raw(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    first_id: int = 0,
    ingested_at: Column | None = None,
) -> None:
    """Append (source, raw_json, observed_at) rows; duplicates are kept.

    Rows without a ``raw_id`` are numbered from ``first_id``, increasing but with gaps.
    """
    if "raw_id" not in rows.columns:
        rows = rows.withColumn("raw_id", F.lit(first_id) + F.monotonically_increasing_id())
    rows.select(
        "raw_id",
        "source",
        "raw_json",
        "observed_at",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.lit(False).alias("processed"),
    ).write.mode("append").format(fmt).save(path)


def next_raw_id(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """First free id: one past the largest in the staging area; reads one column."""
    largest = read_raw_observations(spark, path, fmt).agg(F.max("raw_id")).first()[0]
    return 0 if largest is None else largest + 1
