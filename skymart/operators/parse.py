"""Provider JSON to normalized observations.

JSON is parsed once per row into a VARIANT, which keeps apart a missing key and a key holding null.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymart.config import DocumentKeys
from skymart.functions import classes
from skymart.session import materialize, shared_dir

UNKNOWN_LOCATION = "Unknown"
NO_NAME = "None"  # how a null prints where the sources print it as text


def field(value: Column, path: str) -> Column:
    """Member of a variant; null if the path is missing, variant null if it holds null."""
    return F.try_variant_get(value, path, "variant")


def text(value: Column, path: str = "$") -> Column:
    """String form of a variant or its member, null for a missing or null one.

    Reading a member as text or number directly saves building it as a variant of its own.
    """
    return F.try_variant_get(value, path, "string")


def as_float(value: Column, path: str = "$") -> Column:
    """Number of a variant, its member or a text, null on failure."""
    return F.try_variant_get(value, path, "double")


def text_as_float(value: Column) -> Column:
    """P6 for plain text."""
    return value.try_cast("double")


def is_object(value: Column) -> Column:
    """Only objects can be read as structs; one without fields takes none of the members."""
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def is_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<struct<>>").isNotNull()


def first_present(read: Callable[[Column, str], Column], entry: Column, key: str, other: str) -> Column:
    """Value of the first key that exists, even if that value is null, read as text or number."""
    absent = field(entry, f"$.{key}").isNull()
    return F.coalesce(read(entry, f"$.{key}"), F.when(absent, read(entry, f"$.{other}")))


def _not_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def visibility_km(entry: Column) -> Column:
    """Metres from ``vs``, else kilometres from ``visibility``."""
    return F.coalesce(
        as_float(entry, "$.vs") / F.lit(1000.0), as_float(entry, "$.visibility")
    )


def condition_code(entry: Column) -> Column:
    """P8"""
    weather = field(entry, "$.weather")
    flat = F.coalesce(
        _not_empty(text(entry, "$.condition_code")),
        _not_empty(text(entry, "$.weather_code")),
    )
    return (
        F.when(is_object(weather), text(weather, "$.code"))
        .when(weather.isNotNull() & ~F.is_variant_null(weather), text(weather))
        .otherwise(flat)
    )


def condition_desc(entry: Column) -> Column:
    """First non-empty text."""
    paths = (
        "$.weather_desc",
        "$.weather.description",
        "$.weather.desc",
        "$.condition_desc",
        "$.weather_description",
    )
    return F.coalesce(*[_not_empty(text(entry, path)) for path in paths])


def _place_name(place: Column) -> Column:
    """``adm4``, else ``kecamatan``; "Unknown" only when that key is missing."""
    district = field(place, "$.kecamatan")
    return F.coalesce(
        _not_empty(text(place, "$.adm4")),
        F.when(district.isNull(), F.lit(UNKNOWN_LOCATION)).otherwise(text(district)),
    )


def _measures(entry: Column) -> dict[str, Column]:
    """P2b"""
    return {
        "temperature": first_present(as_float, entry, "t", "temperature"),
        "humidity": first_present(as_float, entry, "hu", "humidity"),
        "pressure": as_float(entry, "$.pressure"),
        "wind_direction": first_present(text, entry, "wd", "wind_direction"),
        "wind_speed": first_present(as_float, entry, "ws", "wind_speed"),
        "rainfall": first_present(as_float, entry, "tp", "rainfall"),
        "uv_index": as_float(entry, "$.uv_index"),
        "visibility": visibility_km(entry),
        "cloud_coverage": first_present(as_float, entry, "tcc", "cloud_coverage"),
        "condition_code": condition_code(entry),
        "condition_desc": condition_desc(entry),
    }


def keep_present(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column and drop the rows where it is null.

    As a filter the condition would be pushed below the parsing and parse every document again, as
    often as the condition mentions it; a generator is evaluated in place, on the computed column.
    """
    kept = F.col("__kept")
    computed = df.withColumn("__kept", value)
    return computed.withColumn(name, F.explode(F.when(kept.isNotNull(), F.array(kept)))).drop("__kept")


def parse_raw_json(
    raw: DataFrame, keys: DocumentKeys, *, include_openweather: bool = False
) -> DataFrame:
    """One normalized row per raw row of a known shape; other shapes are dropped.

    ``include_openweather`` adds rows in the second provider's own shape, which are otherwise of
    unknown shape.
    """
    doc = F.col("__doc")
    members = {"__doc_place": keys.place, "__doc_entries": keys.entries, "__doc_data": "data"}
    place, forecast, data = (F.col(name) for name in members)
    wrapped = place.isNotNull() & forecast.isNotNull()
    listed = is_list(data) & is_object(field(data, "$[0]"))
    flat = is_object(data)

    inner = field(data, "$.data")
    wrapped_entry = (
        F.when(is_object(forecast), forecast)
        .when(is_list(forecast), F.coalesce(field(forecast, "$[0]"), F.parse_json(F.lit("{}"))))
    )
    flat_entry = F.when(inner.isNull(), data).when(is_object(inner), inner)
    entry = (
        F.when(wrapped, wrapped_entry)
        .when(listed, field(data, f"$[0].{keys.entries}[0][0]"))
        .when(flat, flat_entry)
    )
    # The place object of the row, null for flat rows.
    source_place = F.when(wrapped, place).when(listed, field(data, f"$[0].{keys.place}"))
    flat_name = F.coalesce(field(doc, "$.location"), field(data, "$.location"))
    location = (
        F.when(wrapped | listed, _place_name(F.col("__place")))
        .when(flat_name.isNull(), F.lit(UNKNOWN_LOCATION))
        .otherwise(text(flat_name))
    )
    shaped = F.when(
        entry.isNotNull(), F.struct(entry.alias("entry"), source_place.alias("place"))
    )
    # Members the shape depends on become columns, so that no mention of them reads the document again.
    parsed = raw.withColumn("__doc", F.try_parse_json("raw_json")).withColumns(
        {name: field(doc, f"$.{key}") for name, key in members.items()}
    )
    out = (
        keep_present(parsed, shaped, "__shaped")
        .withColumns({"__entry": F.col("__shaped.entry"), "__place": F.col("__shaped.place")})
        .select(
            "raw_id",
            "observed_at",
            location.alias("location"),
            as_float(F.col("__place"), "$.lat").alias("latitude"),
            as_float(F.col("__place"), "$.lon").alias("longitude"),
            "source",
            *[value.alias(name) for name, value in _measures(F.col("__entry")).items()],
        )
    )
    if include_openweather:
        out = out.unionByName(normalize_openweather(raw))
    return out


# -- provider A: full forecasts ----------------------------------------------------------------


def explode_forecast(raw: DataFrame, keys: DocumentKeys) -> DataFrame:
    """One row per forecast entry, in document order, entries without a time dropped."""
    doc = F.col("__doc")
    days = F.try_variant_get(doc, f"$.data[0].{keys.entries}", "array<array<variant>>")
    entry = F.col("entry")
    timed = F.coalesce(
        _not_empty(text(entry, "$.datetime")),
        _not_empty(text(entry, "$.local_datetime")),
    )
    place = field(doc, f"$.data[0].{keys.place}")
    return (
        keep_present(raw, F.try_parse_json("raw_json"), "__doc")
        .select(
            "raw_id",
            "source",
            place.alias("place"),
            text(doc, f"$.data[0].{keys.place}.adm4").alias("location"),
            F.posexplode(F.flatten(days)).alias("position", "entry"),
        )
        .where(timed.isNotNull())
    )


def parse_observed_at(entry: Column, as_of: Column) -> Column:
    """P5: ``datetime`` with its offset dropped, else ``local_datetime`` at UTC+7, else ``as_of``."""
    utc = _not_empty(text(entry, "$.datetime"))
    local = _not_empty(text(entry, "$.local_datetime"))
    bare = F.regexp_replace(utc, r"(Z|[+-]\d{2}:?\d{2})$", "")
    seven_hours = F.expr("interval 7 hours")
    return (
        F.when(utc.isNotNull(), F.try_to_timestamp(bare))
        .when(
            local.isNotNull(),
            F.try_to_timestamp(local, F.lit("yyyy-MM-dd HH:mm:ss")) - seven_hours,
        )
        .otherwise(as_of)
    )


def normalize_forecast(entries: DataFrame, *, as_of: Column | None = None) -> DataFrame:
    """Entries of P1 as normalized observations; pressure and UV are not reported."""
    entry = F.col("entry")
    as_of = F.current_timestamp() if as_of is None else as_of

    def number(key: str) -> Column:
        return as_float(entry, f"$.{key}")

    return entries.select(
        *[name for name in entries.columns if name != "entry"],
        "entry",
        parse_observed_at(entry, as_of).alias("observed_at"),
        number("t").alias("temperature"),
        number("hu").alias("humidity"),
        F.lit(None).cast("double").alias("pressure"),
        text(entry, "$.wd").alias("wind_direction"),
        number("ws").alias("wind_speed"),
        number("tp").alias("rainfall"),
        F.lit(None).cast("double").alias("uv_index"),
        (number("vs") / F.lit(1000.0)).alias("visibility"),
        number("tcc").alias("cloud_coverage"),
        # A present null prints as text here, unlike a missing key.
        F.when(F.is_variant_null(field(entry, "$.weather")), F.lit(NO_NAME))
        .otherwise(_not_empty(text(entry, "$.weather")))
        .alias("condition_code"),
        text(entry, "$.weather_desc").alias("condition_desc"),
    )


def floor_slot(instant: Column, hours: int = 3) -> Column:
    """Start of the UTC slot of ``hours`` hours holding an instant."""
    width = F.lit(hours * 3600)
    return F.timestamp_seconds(F.call_function("div", F.unix_seconds(instant), width) * width)


def nearest_entry(normalized: DataFrame, *, as_of: Column, key: str = "location") -> DataFrame:
    """Per location the entry nearest to ``as_of``, floored to 3 h; the earliest on a tie."""
    distance = F.abs(F.unix_micros("observed_at") - F.unix_micros(as_of.cast("timestamp")))
    nearest = Window.partitionBy(key).orderBy(distance.asc_nulls_last(), "raw_id", "position")
    return (
        normalized.withColumn("__rank", F.row_number().over(nearest))
        .where(F.col("__rank") == 1)
        .drop("__rank")
        .withColumn("observed_at", floor_slot(F.col("observed_at")))
    )


def match_raw_entry(nearest: DataFrame, entries: DataFrame, *, key: str = "location") -> DataFrame:
    """First raw entry less than 60 s from the floored time, empty object if there is none.

    Both sides meet on (location, minute). The single row per location is repeated for the minute
    before and after, so a location with very many entries still spreads over its minutes. Those
    rows are written first: they are needed twice, and computing them parses every document. Their
    known size lets Spark send them to the entries, which are then not shuffled.
    """
    minute = F.lit(60_000_000)
    chosen = nearest.select(key, "place", "observed_at")
    chosen = materialize(chosen, f"{shared_dir(nearest.sparkSession)}/nearest-{uuid.uuid4().hex}")
    left = chosen.withColumn("__target", F.unix_micros("observed_at"))
    probes = left.select(
        key,
        "__target",
        F.explode(F.array(*[F.floor(F.col("__target") / minute) + F.lit(d) for d in (-1, 0, 1)]))
        .alias("__minute"),
    )
    # Only an own time field counts here, not the local one.
    timed = _not_empty(text(F.col("entry"), "$.datetime"))
    moment = F.unix_micros(parse_observed_at(F.col("entry"), F.lit(None).cast("timestamp")))
    candidates = keep_present(
        entries.select(key, "entry", F.struct("raw_id", "position").alias("__order")),
        F.when(timed.isNotNull(), moment),
        "__time",
    ).withColumn("__minute", F.floor(F.col("__time") / minute))
    first = (
        candidates.join(probes, [key, "__minute"])
        .where(F.abs(F.col("__time") - F.col("__target")) < minute)
        .select(key, "__order", F.to_json("entry").alias("raw_entry"))  # of the few matches only
        .groupBy(key)
        .agg(F.min_by("raw_entry", "__order").alias("raw_entry"))
    )
    return left.drop("__target").join(first, key, "left").withColumn(
        "raw_entry", F.coalesce("raw_entry", F.lit("{}"))
    )


def wrap_entry(matched: DataFrame, keys: DocumentKeys) -> DataFrame:
    """Rebuild the stored document around one entry."""
    document = F.struct(
        F.coalesce("place", F.parse_json(F.lit("{}"))).alias(keys.place),
        F.array(F.parse_json("raw_entry")).alias(keys.entries),
    )
    return matched.withColumn("raw_json", F.to_json(document))


# -- provider B: current weather ---------------------------------------------------------------

OPENWEATHER = (
    "dt bigint, main struct<temp:double,humidity:double,pressure:double>, "
    "wind struct<speed:double,deg:double>, weather array<struct<id:bigint,description:string>>, "
    "clouds struct<all:double>, visibility double, rain struct<`1h`:double,`3h`:double>, "
    "name string"
)


def normalize_openweather(raw: DataFrame) -> DataFrame:
    """Rows holding a ``dt``; zero degrees, zero metres and zero rain in 1 h count as absent."""
    def member(path: str) -> Column:
        return F.col(f"__doc.{path}")

    weather = F.get(member("weather"), F.lit(0))
    degrees = F.nullif(member("wind.deg"), F.lit(0.0))
    document = F.from_json("raw_json", OPENWEATHER)
    parsed = raw.withColumn("__parsed", document)
    dated = F.when(F.col("__parsed.dt").isNotNull(), F.col("__parsed"))
    return (
        keep_present(parsed, dated, "__doc")
        .select(
            "raw_id",
            F.timestamp_seconds(member("dt")).alias("observed_at"),
            member("name").alias("location"),
            F.lit(None).cast("double").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
            "source",
            member("main.temp").alias("temperature"),
            member("main.humidity").alias("humidity"),
            member("main.pressure").alias("pressure"),
            classes.deg_to_compass(degrees).alias("wind_direction"),
            member("wind.speed").alias("wind_speed"),
            F.coalesce(F.nullif(member("rain.`1h`"), F.lit(0.0)), member("rain.`3h`"), F.lit(0.0)).alias(
                "rainfall"
            ),
            F.lit(None).cast("double").alias("uv_index"),
            (F.nullif(member("visibility"), F.lit(0.0)) / F.lit(1000.0)).alias("visibility"),
            member("clouds.all").alias("cloud_coverage"),
            weather["id"].cast("string").alias("condition_code"),
            F.coalesce(
                _not_empty(weather["description"]), classes.owm_condition_text(weather["id"])
            ).alias("condition_desc"),
        )
    )


# -- names -------------------------------------------------------------------------------------


def location_names(raw: DataFrame, source: str, keys: DocumentKeys) -> DataFrame:
    """One name per code; the greatest one where a code carries several."""
    return (
        raw.where(F.col("source") == source)
        .select(
            F.get_json_object("raw_json", f"$.{keys.place}.adm4").alias("adm4"),
            F.get_json_object("raw_json", f"$.{keys.place}.desa").alias("desa"),
        )
        .where(F.col("adm4").isNotNull() & F.col("desa").isNotNull())
        .groupBy("adm4")
        .agg(F.max("desa").alias("desa"))
    )
