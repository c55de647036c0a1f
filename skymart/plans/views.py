"""Warehouse views (V1-V6).

Facts meet the dimensions as late and as small as possible: aggregates group by the fact's own key
before the join, ranked rows are joined after the ranking. ``time_id`` is the timestamp in
microseconds, so no view needs ``dim_time``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymart.config import CODE_PATTERN
from skymart.functions import numeric
from skymart.functions.timeline import SLICE_ROWS, with_trailing
from skymart.operators import rollup
from skymart.sources.warehouse import Warehouse

WEATHER = (
    "temp_classification",
    "humidity_classification",
    "wind_classification",
    "rain_classification",
    "condition_desc",
)


@dataclass(frozen=True)
class Star:
    """The tables of one warehouse snapshot.

    ``days``, ``totals`` and ``covered`` are the aggregates a load keeps of all facts; None where facts
    are only some of them, or the warehouse is older than the aggregates. ``newest`` is the watermark.
    """

    fact: DataFrame
    dim_location: DataFrame
    dim_weather: DataFrame
    days: DataFrame | None = None
    totals: DataFrame | None = None
    covered: DataFrame | None = None
    newest: datetime | None = None

    @classmethod
    def of(cls, warehouse: Warehouse) -> "Star":
        current = warehouse.snapshot()
        names = ["fact_weather", "dim_location", "dim_weather"]
        if "fact_days" in current.tables:
            names += ["fact_days", "location_totals", "time_coverage"]
        tables = [warehouse.table(name, snapshot=current) for name in names]
        return replace(cls(*tables), newest=current.watermark)

    def between(self, first: datetime | None = None, last: datetime | None = None) -> "Star":
        """Only facts in a closed time range; prunes the daily partitions."""
        return self.only(within(self.fact, first, last))

    def only(self, fact: DataFrame) -> "Star":
        """Some of the facts."""
        return Star(fact, self.dim_location, self.dim_weather)

    def at(self, places: DataFrame, keys: list[int] | None) -> "Star":
        """Facts of some locations: by literal ``keys``, or by a join with ``places``."""

        def there(table: DataFrame | None) -> DataFrame | None:
            if table is None:
                return None
            if keys is None:
                return table.join(places, "location_id", "left_semi")
            return table.where(F.col("location_id").isin(keys) if keys else F.lit(False))

        some = {name: there(getattr(self, name)) for name in ("fact", "days", "totals")}
        return replace(self, dim_location=places, covered=None, **some)

    def sums(self) -> DataFrame:
        """One row per location with the sums of its facts."""
        if self.totals is not None:
            return self.totals
        return rollup.by_location(rollup.by_day(self.fact))

    def coverage(self, pattern: str) -> DataFrame:
        """Number of coded districts per timestamp, with its day."""
        if self.covered is not None and pattern == CODE_PATTERN:
            return self.covered
        return rollup.coverage(self.fact, self.dim_location, pattern)


def within(df: DataFrame, first: datetime | None, last: datetime | None) -> DataFrame:
    if first is not None:
        df = df.where((F.col("date") >= F.lit(first.date())) & (F.col("time_id") >= micros(first)))
    if last is not None:
        df = df.where((F.col("date") <= F.lit(last.date())) & (F.col("time_id") <= micros(last)))
    return df


def utc(instant: datetime | None) -> datetime:
    """A given instant, or now, as an aware UTC datetime."""
    if instant is None:
        return datetime.now(UTC)
    return instant.astimezone(UTC) if instant.tzinfo else instant.replace(tzinfo=UTC)


def micros(instant: datetime) -> Column:
    return F.lit((instant - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1))


def observed_at() -> Column:
    return F.timestamp_micros("time_id")


def with_district(facts: DataFrame, star: Star, *columns: str) -> DataFrame:
    """Add ``district`` and further location columns. Size statistics decide about a broadcast."""
    places = star.dim_location.select("location_id", "district", *columns)
    return facts.join(places, "location_id")


def with_weather(facts: DataFrame, star: Star, *columns: str) -> DataFrame:
    return facts.join(star.dim_weather.select("weather_id", *columns), "weather_id")


#: Days before the newest one searched one after the other for the newest rows; None searches all.
NEWEST_DAYS = (2, 32, 512, None)


def newest_days(star: Star, rows: int) -> list[date]:
    """The days that hold the newest ``rows`` facts of every location.

    Days are searched from the watermark backwards. A location is done when the days read hold
    ``rows`` of its facts, or all it has by its total; the search stops when all are done. One small
    job over sums of days per step, and no fact is read.
    """
    wanted = star.totals.select("location_id", F.least("rows", F.lit(rows)).alias("wanted"))
    spans = [n for n in NEWEST_DAYS if n is None or star.newest is not None]
    for span in spans:
        found = star.days
        if span is not None:
            first = star.newest.date() - timedelta(days=span - 1)
            found = found.where((F.col("month") >= F.lit(f"{first:%Y-%m}")) & (F.col("date") >= F.lit(first)))
        # A day of one location may lie in several directories.
        found = found.groupBy("location_id", "date").agg(F.sum("rows").alias("rows"))
        backwards = Window.partitionBy("location_id").orderBy(F.desc("date"))
        newer = F.sum("rows").over(backwards.rowsBetween(Window.unboundedPreceding, -1))
        ranked = found.withColumn("place", F.row_number().over(backwards)).where(F.col("place") <= rows)
        needed = ranked.withColumn("newer", newer).where(F.coalesce("newer", F.lit(0)) < rows)
        own = needed.groupBy("location_id").agg(F.sum("rows").alias("have"), F.collect_list("date").alias("days"))
        short = F.coalesce("have", F.lit(0)) < F.col("wanted")
        state = wanted.join(own, "location_id", "left").agg(
            F.count_if(short).alias("short"), F.array_distinct(F.flatten(F.collect_set("days"))).alias("days")
        )
        result = state.first()
        if not result["short"]:
            break
    return result["days"]


def _newest_facts(star: Star, rows: int) -> DataFrame:
    """Facts of the days that matter, or all facts where sums of days are missing."""
    if star.days is None or star.totals is None:
        return star.fact
    dates = newest_days(star, rows)
    return star.fact.where(F.col("date").isin(dates) if dates else F.lit(False))


def latest_per_district(star: Star, rows: int, *location_columns: str) -> DataFrame:
    """The newest ``rows`` facts per district, ranked 1 upward.

    Only days that hold such facts are read. Facts are ranked by location before the join, so they
    meet neither the dimension nor a shuffle as a whole: the rank filter limits every group in the
    task that reads it. Few rows are ranked again.
    """
    own = Window.partitionBy("location_id").orderBy(F.desc("time_id"))
    newest = Window.partitionBy("district").orderBy(F.desc("time_id"), "location_id")
    facts = _newest_facts(star, rows)
    latest = facts.withColumn("rn", F.row_number().over(own)).where(F.col("rn") <= rows)
    return (
        with_district(latest.drop("rn"), star, *location_columns)
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") <= rows)
    )


def overview(star: Star) -> DataFrame:
    """V1: latest row per district."""
    latest = latest_per_district(star, 1, "latitude", "longitude")
    return with_weather(latest, star, *WEATHER).select(
        "district",
        "latitude",
        "longitude",
        "temperature",
        "humidity",
        "wind_speed",
        "wind_direction",
        "rainfall",
        "cloud_coverage",
        "visibility",
        *WEATHER,
        observed_at().alias("observed_at"),
        "source",
    )


def partial_sums(*names: str) -> list[Column]:
    """Integer sums and counts that a second aggregate can combine."""
    sums = [F.sum(numeric.unscaled(F.col(n))).alias(f"{n}_sum") for n in names]
    return sums + [F.count(n).alias(f"{n}_n") for n in names]


def combined_mean(name: str, places: int) -> Column:
    return numeric.round_half_away(F.sum(f"{name}_sum"), F.sum(f"{name}_n"), places)


def analytics(star: Star) -> DataFrame:
    """V2: counts, averages and extremes per district, from the sums a load keeps per location."""
    return (
        with_district(star.sums(), star)
        .groupBy("district")
        .agg(
            F.sum("rows").alias("total_observations"),
            combined_mean("temperature", 1).alias("avg_temperature"),
            F.round(F.min("low"), 1).alias("min_temperature"),
            F.round(F.max("high"), 1).alias("max_temperature"),
            combined_mean("humidity", 1).alias("avg_humidity"),
            combined_mean("wind_speed", 1).alias("avg_wind_speed"),
            combined_mean("rainfall", 2).alias("avg_rainfall"),
            (F.sum("rainfall_sum").cast("decimal(20,0)") / F.lit(100))
            .cast("decimal(22,2)")
            .alias("total_rainfall"),
            combined_mean("cloud_coverage", 1).alias("avg_cloud_coverage"),
            F.timestamp_micros(F.min("first")).alias("first_observation"),
            F.timestamp_micros(F.max("last")).alias("last_observation"),
        )
    )


def trend_columns(names: tuple[str, str, str]) -> dict:
    """Rounded trailing means of three rows and changes against the previous row."""
    temp, humidity, rain = names

    def trailing(name: str, places: int):
        return lambda w: numeric.round_mean(name, places, w.rowsBetween(-2, 0))

    def change(name: str):
        return lambda w: F.round(F.col(name) - F.lag(name).over(w), 1)

    return {
        temp: trailing("temperature", 1),
        humidity: trailing("humidity", 1),
        rain: trailing("rainfall", 2),
        "temp_delta": change("temperature"),
        "humidity_delta": change("humidity"),
    }


def trend(star: Star, *, ordered: bool = True, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """V3: moving averages and changes along each district's time line."""
    columns = trend_columns(("temp_ma_3h", "humidity_ma_3h", "rainfall_ma_3h"))
    facts = with_district(
        star.fact.select("time_id", "location_id", "temperature", "humidity", "rainfall"), star
    ).withColumn("timestamp", observed_at())
    result = with_trailing(
        facts,
        columns,
        key="district",
        order="timestamp",
        tie=("location_id",),
        lookback=2,
        inputs=("temperature", "humidity", "rainfall"),
        slice_rows=slice_rows,
    ).select(
        "district",
        F.to_date("timestamp").alias("date"),
        F.hour("timestamp").cast("smallint").alias("hour"),
        "timestamp",
        "temperature",
        "humidity",
        "rainfall",
        *columns,
    )
    return result.orderBy("district", "timestamp") if ordered else result


def heatmap(star: Star, *, as_of: datetime | None = None, hours: int = 24) -> DataFrame:
    """V4: averages of the last hours per district, position and temperature class."""
    recent = star.between(utc(as_of) - timedelta(hours=hours))
    per_key = recent.fact.groupBy("location_id", "weather_id").agg(
        F.count(F.lit(1)).alias("rows"), *partial_sums("temperature", "rainfall", "humidity")
    )
    placed = with_district(per_key, star, "latitude", "longitude")
    return (
        with_weather(placed, star, "temp_classification")
        .groupBy("district", "latitude", "longitude", "temp_classification")
        .agg(
            combined_mean("temperature", 1).alias("avg_temperature"),
            combined_mean("rainfall", 2).alias("avg_rainfall"),
            combined_mean("humidity", 1).alias("avg_humidity"),
            F.sum("rows").alias("data_points"),
        )
    )


def prediction(star: Star, *, rows: int = 3, ordered: bool = True) -> DataFrame:
    """V5: the last observations per district."""
    result = with_weather(latest_per_district(star, rows), star, "temp_classification").select(
        "district",
        observed_at().alias("last_observed"),
        F.col("temperature").alias("current_temp"),
        "temp_avg",
        "temp_max",
        "temp_min",
        "temp_classification",
    )
    return result.orderBy("district", F.desc("last_observed")) if ordered else result


def anomaly(star: Star, *, threshold: float = 2.5, ordered: bool = True) -> DataFrame:
    """V6: z-scores against the district's mean and sample deviation.

    Sums and sums of squares are exact integers that a load keeps per location. They are combined to
    districts, then put on the locations: facts join one small table. With sum S, squares Q and count n in hundredths,
    the deviation is sqrt((nQ - S^2) / (n(n - 1))).
    """
    cents = numeric.unscaled(F.col("temperature"))
    per_location = star.sums().select(
        "location_id",
        "rows",
        F.col("temperature_n").alias("n"),
        F.col("temperature_sum").alias("s"),
        F.col(rollup.SQUARES).alias("q"),
    )
    places = star.dim_location.select("location_id", "district")
    per_district = (
        per_location.join(places, "location_id")
        .groupBy("district")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.sum("s").alias("s"),
            F.sum("q").cast("decimal(24,0)").alias("q"),
        )
        .where(F.col("rows") >= 2)
    )
    n, s = F.col("n").cast("decimal(13,0)"), F.col("s").cast("decimal(18,0)")
    squares = (n * F.col("q") - s * s).cast("double")
    spread = F.when(F.col("n") > 1, squares / F.nullif(F.col("n") - 1, F.lit(0)))
    profile = places.join(per_district, "district").select(
        "location_id",
        "district",
        "n",
        "s",
        spread.alias("spread"),
        numeric.round_half_away(F.col("s"), F.col("n"), 1).alias("mean_temp"),
        F.round(F.sqrt(spread / F.nullif(F.col("n"), F.lit(0))) / F.lit(100.0), 1).alias("std_temp"),
    )
    distance = F.abs(cents * F.col("n") - F.col("s")).cast("double")
    z = distance / F.nullif(F.sqrt(F.col("n") * F.col("spread")), F.lit(0.0))
    facts = star.fact.select("time_id", "location_id", "weather_id", "temperature")
    result = with_weather(
        facts.join(profile, "location_id"), star, "temp_classification", "condition_desc"
    ).select(
        "district",
        observed_at().alias("timestamp"),
        "temperature",
        "mean_temp",
        "std_temp",
        F.round(z, 2).alias("z_score"),
        F.coalesce(z > F.lit(threshold), F.lit(False)).alias("is_anomaly"),
        "temp_classification",
        "condition_desc",
    )
    return result.orderBy(F.desc_nulls_last("z_score")) if ordered else result
