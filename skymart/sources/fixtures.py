"""Raw documents, features and stations that Spark derives from the given tables.

They give every operator whole-table input in the shape it expects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.config import DocumentKeys
from skymart.sources.events import observations, read_table

KEYS = DocumentKeys(place="place", entries="entries")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores is dealt out to all cores; a large one is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _text(value: Column, pattern: str) -> Column:
    return F.date_format(value, pattern)


def _provider_entry(instant: Column, temperature: Column) -> Column:
    """Entry of provider A in its own key names."""
    return F.struct(
        F.concat(_text(instant, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("datetime"),
        temperature.alias("t"),
        F.col("humidity").alias("hu"),
        F.lit("sw").alias("wd"),
        F.col("wind_speed").alias("ws"),
        F.col("rainfall").alias("tp"),
        F.col("cloud_coverage").alias("tcc"),
        (F.col("visibility") * 1000).cast("int").alias("vs"),
        F.col("pressure").alias("pressure"),
        F.col("uv_index").alias("uv_index"),
        F.col("condition_code").alias("weather"),
        F.col("condition_desc").alias("weather_desc"),
    )


def _place() -> Column:
    return F.struct(
        F.col("location").alias("adm4"),
        F.lit("Medan").alias("kecamatan"),
        F.when(
            F.col("raw_id") % 7 != 0, F.concat(F.lit("Desa "), (F.col("raw_id") % 3).cast("string"))
        ).alias("desa"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )


def raw_documents(spark: SparkSession, sf_dir: str, *, by_slot: bool = False) -> DataFrame:
    """One stored document per event, in the four known shapes by ``event_id % 4``.

    ``by_slot`` dates the documents by their 3-hour slot.
    """
    rows = spread(observations(spark, sf_dir))
    entry = _provider_entry(F.col("observed_at"), F.col("temperature"))
    flat = F.struct(
        *[
            F.col(name)
            for name in (
                "temperature", "humidity", "pressure", "wind_speed", "rainfall", "uv_index",
                "visibility", "cloud_coverage",
            )
        ],
        F.lit(" sw ").alias("wind_direction"),
        F.struct(
            F.col("condition_code").alias("code"), F.col("condition_desc").alias("description")
        ).alias("weather"),
    )
    place = _place().alias(KEYS.place)
    shape = F.col("raw_id") % 4
    day = F.struct(place, F.array(F.array(entry)).alias(KEYS.entries))
    document = (
        F.when(shape == 0, F.to_json(F.struct(place, entry.alias(KEYS.entries))))
        .when(shape == 1, F.to_json(F.struct(place, F.array(entry).alias(KEYS.entries))))
        .when(shape == 2, F.to_json(F.struct(F.array(day).alias("data"))))
        .otherwise(F.to_json(F.struct("location", flat.alias("data"))))
    )
    return rows.select(
        "raw_id",
        F.when(F.col("raw_id") % 2 == 0, F.lit("Forecast")).otherwise(F.lit("Events")).alias("source"),
        document.alias("raw_json"),
        F.col("slot" if by_slot else "observed_at").alias("observed_at"),
    )


def forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One full forecast per event: two days of two entries, three hours apart.

    The third entry of every fifth event has no time, the second one of every third event only a
    local time.
    """
    start = F.col("observed_at")

    def entry(index: int) -> Column:
        moment = start + F.make_interval(hours=F.lit(3 * index))
        full = _provider_entry(moment, F.col("temperature") + index)
        fields = [full[name].alias(name) for name in (
            "t", "hu", "wd", "ws", "tp", "tcc", "vs", "weather", "weather_desc",
        )]
        utc, local = full["datetime"], F.lit(None).cast("string")
        if index == 1:
            only_local = F.col("raw_id") % 3 == 0
            shifted = moment + F.make_interval(hours=F.lit(7))
            utc = F.when(~only_local, utc)
            local = F.when(only_local, _text(shifted, "yyyy-MM-dd HH:mm:ss"))
        if index == 2:
            utc = F.when(F.col("raw_id") % 5 != 0, utc)
        return F.struct(utc.alias("datetime"), local.alias("local_datetime"), *fields)

    days = F.array(F.array(entry(0), entry(1)), F.array(entry(2), entry(3)))
    document = F.struct(
        F.array(F.struct(_place().alias(KEYS.place), days.alias(KEYS.entries))).alias("data")
    )
    return spread(observations(spark, sf_dir)).select(
        "raw_id", F.lit("Forecast").alias("source"), F.to_json(document).alias("raw_json"), "observed_at"
    )


def openweather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One current-weather document of provider B per event."""
    ids = F.array(*[F.lit(n) for n in (200, 500, 800, 802, 999)])
    document = F.struct(
        F.unix_seconds("observed_at").alias("dt"),
        F.struct(
            F.col("temperature").alias("temp"), F.col("humidity"), F.col("pressure")
        ).alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg")).alias("wind"),
        F.array(
            F.struct(
                F.get(ids, (F.col("raw_id") % 5).cast("int")).alias("id"),
                F.when(F.col("raw_id") % 2 == 0, F.col("condition_desc")).alias("description"),
            )
        ).alias("weather"),
        F.struct(F.col("cloud_coverage").alias("all")).alias("clouds"),
        (F.col("raw_id") % 10 * 1000).alias("visibility"),
        F.struct(
            F.col("rainfall").alias("1h"), (F.col("raw_id") % 3).alias("3h")
        ).alias("rain"),
        F.col("location").alias("name"),
    )
    return spread(observations(spark, sf_dir)).select(
        "raw_id", F.lit("OpenWeather").alias("source"), F.to_json(document).alias("raw_json"),
        "observed_at",
    )


# -- alerts --------------------------------------------------------------------------------------


def _element(name: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>"))


def alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed document per event with two items; every third event is about the region."""
    events = spread(read_table(spark, sf_dir, "events"))
    number = F.col("event_id").cast("string")
    region = F.when(F.col("event_id") % 3 == 0, F.lit(" Rain in the NORTH ")).otherwise(
        F.lit("Jawa Barat")
    )

    def item(suffix: str) -> Column:
        link = F.concat(F.lit("alert/"), number, F.lit(suffix))
        return _element("item", F.concat(_element("title", region), _element("link", link)))

    xml = _element("channel", F.concat(item("/a"), F.lit("\n"), item("/b")))
    return events.select(F.col("event_id").alias("feed_id"), xml.alias("xml"))


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first item's alert of every event not divisible by five: one or two areas."""
    events = spread(read_table(spark, sf_dir, "events"))
    number = F.col("event_id").cast("string")
    severity = (
        F.when(F.col("event_type") == "error", F.lit("Extreme"))
        .when(F.col("event_type") == "click", F.lit("Severe"))
        .when(F.col("event_type") == "view", F.lit("Moderate"))
        .when(F.col("event_type") == "signup", F.lit("Minor"))
        .otherwise(F.lit("Other"))
    )
    lat, lon = (F.col("event_id") % 90).cast("string"), (F.col("event_id") % 180).cast("string")
    ring = _element(
        "polygon", F.concat(lat, F.lit(","), lon, F.lit(" 1.5,2.5  3.5,4.5 "), lat, F.lit(","), lon)
    )

    def area(name: str, rings: Column) -> Column:
        return _element("area", F.concat(_element("areaDesc", F.lit(name)), rings))

    areas = F.concat(
        area("Utara", ring),
        F.when(F.col("event_id") % 2 == 0, area("Selatan", F.concat(ring, ring))).otherwise(
            F.lit("")
        ),
    )
    info = _element(
        "info",
        F.concat(
            _element("event", F.col("event_type")),
            _element("headline", F.concat(F.lit(" Peringatan "), number, F.lit("\n"))),
            _element("severity", severity),
            areas,
        ),
    )
    return events.where(F.col("event_id") % 5 != 0).select(
        F.concat(F.lit("alert/"), number, F.lit("/a")).alias("link"),
        _element("alert", info).alias("xml"),
    )


# -- geometry ------------------------------------------------------------------------------------


def _square(x: Column, y: Column, half: float) -> Column:
    corners = ((-half, -half), (half, -half), (half, half), (-half, half), (-half, -half))
    return F.array(*[F.array(x + F.lit(dx), y + F.lit(dy)) for dx, dy in corners])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per supplier: a square, an L-shape, or a pair of squares of unequal size."""
    key = F.col("s_suppkey")
    x = F.lit(98.5) + (key * 7 % 100) / F.lit(100.0)
    y = F.lit(3.5) + (key * 13 % 100) / F.lit(100.0)
    outline = ((0.0, 0.0), (0.04, 0.0), (0.04, 0.01), (0.01, 0.01), (0.01, 0.04), (0.0, 0.04))
    ell = F.array(*[F.array(x + F.lit(dx), y + F.lit(dy)) for dx, dy in (*outline, outline[0])])
    far_x = x + F.lit(0.1)
    polygons = (
        F.when(key % 3 == 0, F.array(F.array(_square(x, y, 0.02))))
        .when(key % 3 == 1, F.array(F.array(ell)))
        .otherwise(F.array(F.array(_square(x, y, 0.005)), F.array(_square(far_x, y, 0.03))))
    )
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("feature_id"), polygons.alias("polygons")
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per event, off the outlines of the features."""
    key = F.col("event_id")
    return spread(read_table(spark, sf_dir, "events")).select(
        key.alias("point_id"),
        (F.lit(98.40037) + (key * 37 % 1300) / F.lit(1000.0)).alias("lon"),
        (F.lit(3.40037) + (key * 53 % 1300) / F.lit(1000.0)).alias("lat"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per supplier; some points coincide with a station."""
    key = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        key.alias("seq"),
        (F.lit(98.40037) + (key * 29 % 1300) / F.lit(1000.0)).alias("lon"),
        (F.lit(3.40037) + (key * 31 % 1300) / F.lit(1000.0)).alias("lat"),
        (F.lit(20) + key % 15).cast("double").alias("value"),
    )
