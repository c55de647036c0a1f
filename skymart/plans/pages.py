"""Data behind the pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.config import LOCAL_TIME_ZONE
from skymart.plans.queries import with_parent

# How a missing temperature ranks among others, and sorts in the list.
MISSING_IN_RANKING = -999
MISSING_IN_ORDER = 0


def hottest_per_parent(snapshot: DataFrame, *, ordered: bool = True) -> DataFrame:
    """The hottest row per parent district, hottest parent first.

    A grouped ``min_by`` on (descending temperature, district) combines before the shuffle.
    """
    named = with_parent(snapshot, F.substring("district", 1, 8))
    payload = [c for c in named.columns if c != "kecamatan"]
    rank = F.struct(
        (-F.coalesce("temperature", F.lit(MISSING_IN_RANKING))).alias("cold"), "district"
    )
    result = (
        named.groupBy("kecamatan")
        .agg(F.min_by(F.struct(*payload), rank).alias("hottest"))
        .select("kecamatan", "hottest.*")
    )
    if not ordered:
        return result
    return result.orderBy(F.desc(F.coalesce("temperature", F.lit(MISSING_IN_ORDER))), "kecamatan")


def hottest_overall(snapshot: DataFrame) -> DataFrame:
    """The hottest row; the smaller district code wins a tie."""
    return snapshot.orderBy(
        F.desc(F.coalesce("temperature", F.lit(MISSING_IN_RANKING))), "district"
    ).limit(1)


def with_local_day(observations: DataFrame, zone: str = LOCAL_TIME_ZONE) -> DataFrame:
    """U3, flat: the local calendar day of every observation."""
    return observations.withColumn(
        "local_day", F.to_date(F.from_utc_timestamp("observed_at", zone))
    )


def group_by_local_day(observations: DataFrame, zone: str = LOCAL_TIME_ZONE) -> DataFrame:
    """A limited forecast as one ascending list per local day."""
    items = [c for c in observations.columns if c != "observed_at"]
    return (
        with_local_day(observations, zone)
        .groupBy("local_day")
        .agg(
            F.sort_array(F.collect_list(F.struct("observed_at", *items))).alias("observations")
        )
        .orderBy("local_day")
    )


def weather_by_name(snapshot: DataFrame, names: DataFrame) -> DataFrame:
    """U4: snapshot rows under the names of their codes; unmatched names are dropped."""
    return names.join(snapshot, names["adm4"] == snapshot["district"]).drop("adm4")
