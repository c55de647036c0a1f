"""Registered queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymart.operators import clean, enrich, load, parse, quality, spatial
from skymart.plans import alerts, pages, queries, transform, views
from skymart.plans import oracle_sql as sql
from skymart.session import configure, materialize, shared_dir
from skymart.sources import admin, events, fixtures, raw
from skymart.sources.warehouse import Warehouse
from skymart.streaming import ingest

KEYS = fixtures.KEYS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = datetime(2024, 1, 20, 10, 0, 0)
AS_OF_SQL = "timestamp '2024-01-20 10:00:00'"
DISTRICT = "12.71.09.1001"
PARENT = "12.71.09"
CUT = datetime.fromisoformat(sql.CUT)


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share, independent of time zones."""
    wide = {
        T.DecimalType: "double",
        T.ShortType: "bigint",
        T.IntegerType: "bigint",
        T.DateType: "string",
        T.TimestampType: "timestamp_ntz",
    }
    return df.select(
        *[
            F.col(f.name).cast(wide[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in wide
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(function(spark, sf_dir.rstrip("/")))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# -- prepared inputs -----------------------------------------------------------------------------

_PREPARED: dict[tuple[str, str, str], object] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, build: Callable[[], object]):
    """Build an input once per application; later queries read the written tables."""
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _PREPARED:
        _PREPARED[key] = build()
    return _PREPARED[key]


def _new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.observations(spark, sf_dir).drop("slot")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).transform(clean.clean).transform(clean.standardize)


def slotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned observations dated by their 3-hour slot, written once.

    Every load reads them twice, for the features of a location and for the rows themselves.
    """

    def build() -> DataFrame:
        dated = events.observations(spark, sf_dir).withColumn("observed_at", F.col("slot")).drop("slot")
        rows = dated.transform(clean.clean).transform(clean.standardize)
        return materialize(rows, _new_path(spark, "slotted"))

    return _once("slotted", spark, sf_dir, build)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse after one load of all slotted observations."""

    def build() -> Warehouse:
        target = Warehouse(spark, _new_path(spark, "warehouse"))
        load.load(transform.loadable(slotted(spark, sf_dir)), target)
        return target

    return _once("warehouse", spark, sf_dir, build)


def star(spark: SparkSession, sf_dir: str) -> views.Star:
    return views.Star.of(warehouse(spark, sf_dir))


def staging(spark: SparkSession, sf_dir: str) -> str:
    """Staging area holding one raw document per event."""

    def build() -> str:
        path = _new_path(spark, "staging")
        raw.append_raw(fixtures.raw_documents(spark, sf_dir), path)
        return path

    return _once("staging", spark, sf_dir, build)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_raw_observations(spark, staging(spark, sf_dir))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged full forecasts, one per event."""

    def build() -> str:
        path = _new_path(spark, "forecasts")
        raw.append_raw(fixtures.forecast_documents(spark, sf_dir), path)
        return path

    return raw.read_raw_observations(spark, _once("forecasts", spark, sf_dir, build))


MEASURES = (
    "temperature", "humidity", "pressure", "wind_speed", "rainfall", "uv_index", "visibility",
    "cloud_coverage",
)
OBS = f"with {sql.OBS}"
CLEANED = f"with {sql.OBS}, {sql.cleaned()}"

# -- sources and sinks ---------------------------------------------------------------------------

_RAW_SQL = f"""{OBS} select raw_id, case when raw_id % 2 = 0 then 'Forecast' else 'Events' end as source,
  observed_at, cast(raw_id % 4 as bigint) as shape from obs"""


def _shape(df: DataFrame) -> DataFrame:
    has = {name: F.get_json_object("raw_json", f"$.{name}").isNotNull() for name in (KEYS.place, "location")}
    shape = (
        F.when(has[KEYS.place] & F.col("raw_json").contains(f'"{KEYS.entries}":['), F.lit(1))
        .when(has[KEYS.place], F.lit(0))
        .when(has["location"], F.lit(3))
        .otherwise(F.lit(2))
    )
    return df.select("raw_id", "source", "observed_at", shape.cast("bigint").alias("shape"))


@query("s1_read_raw_observations", _RAW_SQL)
def _(spark, sf):
    return _shape(documents(spark, sf))


@query(
    "s2_append_raw",
    f"""{OBS} select case when raw_id % 2 = 0 then 'Forecast' else 'Events' end as source, observed_at,
    false as processed, cast(count(*) as bigint) as n from (select * from obs union all
    select * from obs) d group by all""",
)
def _(spark, sf):
    path = _new_path(spark, "append")
    rows = fixtures.raw_documents(spark, sf).drop("raw_id")
    raw.append_raw(rows, path)
    raw.append_raw(rows, path, first_id=raw.next_raw_id(spark, path))
    stored = spark.read.parquet(path)
    unique = stored.groupBy("raw_id", "source", "observed_at", "processed").count()
    return unique.groupBy("source", "observed_at", "processed").agg(F.sum("count").alias("n"))


_SEEDS = ", ".join(
    f"('{name}', {lat}, {lon})" for name, (lat, lon) in admin.SEED_LOCATIONS.items()
)


@query(
    "s3_seed_locations",
    f"""{OBS} select 'Medan' as city, location as district, {sql.doubles("latitude", "longitude")},
    'kecamatan' as region_level from (select distinct location, latitude, longitude from obs) d
    union all select 'Medan', name, cast(lat as double), cast(lon as double), 'kecamatan'
    from (values {_SEEDS}) v(name, lat, lon)""",
)
def _(spark, sf):
    dim = warehouse(spark, sf).table("dim_location")
    seeded = admin.seed_locations(admin.seed_locations(dim))
    return seeded.drop("location_id")


_DISTRICTS = ", ".join(
    f"('12.71.{code}', '{name}', {len(codes)})" for code, (name, codes) in admin.DISTRICTS.items()
)


@query(
    "s4_admin_codes",
    f"""{OBS}, codes as (select adm3, name, unnest(range(1001, 1001 + n)) as child
    from (values {_DISTRICTS}) v(adm3, name, n))
    select c.adm3 || '.' || c.child as adm4, c.name, count(o.raw_id) as observations
    from codes c left join obs o on o.location = c.adm3 || '.' || c.child group by all""",
)
def _(spark, sf):
    counts = observations(spark, sf).groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    codes = admin.admin_codes(spark)
    return codes.join(counts, codes["adm4"] == counts["location"], "left").select(
        "adm4", "name", F.coalesce("n", F.lit(0)).alias("observations")
    )


@query(
    "s5_admin_adm3",
    f"""{OBS} select v.adm3, v.name, count(o.raw_id) as observations
    from (values {_DISTRICTS}) v(adm3, name, n)
    left join obs o on substr(o.location, 1, 8) = v.adm3 group by all""",
)
def _(spark, sf):
    rows = observations(spark, sf)
    counts = rows.groupBy(F.substring("location", 1, 8).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )
    parents = admin.admin_adm3(spark)
    return parents.join(counts, parents["adm3"] == counts["prefix"], "left").select(
        "adm3", "name", F.coalesce("n", F.lit(0)).alias("observations")
    )


@query(
    "s6_read_warehouse",
    f"""{sql.FACT} select observed_at, cast(cast(observed_at as date) as varchar) as date, location as district,
    condition_code, temp_class as temp_classification, rainfall_class as rain_classification,
    {sql.doubles(*MEASURES, "temp_avg", "temp_max", "temp_min")} from fact""",
)
def _(spark, sf):
    warehouse(spark, sf).register_views()
    return spark.sql(
        f"""select t.timestamp as observed_at, f.date, l.district, w.condition_code,
        w.temp_classification, w.rain_classification, {", ".join("f." + m for m in MEASURES)},
        f.temp_avg, f.temp_max, f.temp_min
        from fact_weather f join dim_time t using (time_id) join dim_location l using (location_id)
        join dim_weather w using (weather_id)"""
    )


@query(
    "s7_name_code_map",
    """select name, value as adm4, count(*) as n from (
    select unnest(json_keys(props)) as name, props from events) d,
    lateral (select json_extract_string(props, name) as value) v group by all""",
)
def _(spark, sf):
    rows = admin.name_code_rows(events.read_table(spark, sf, "events"), "props")
    return rows.groupBy("name", "adm4").agg(F.count(F.lit(1)).alias("n"))


# -- parsing -------------------------------------------------------------------------------------

_FORECAST_SQL = f"""{OBS}, entries as (
  select raw_id, location, i as position, temperature + i as t, humidity, wind_speed, rainfall,
    visibility, cloud_coverage, condition_code, condition_desc, latitude,
    observed_at + to_hours(3 * i) as moment, i = 1 and raw_id % 3 = 0 as only_local
  from obs, (select unnest([0, 1, 2, 3]) as i) n where not (i = 2 and raw_id % 5 = 0)
), timed as (
  select *, date_trunc('second', moment) as observed_at from entries
)"""


@query(
    "p1_explode_forecast",
    f"""{_FORECAST_SQL} select raw_id, location, cast(position as bigint) as position,
    cast(t as double) as t from timed""",
)
def _(spark, sf):
    entries = parse.explode_forecast(forecasts(spark, sf), KEYS)
    t = parse.as_float(parse.field(F.col("entry"), "$.t"))
    return entries.select("raw_id", "location", "position", t.alias("t"))


_FLAT = "raw_id % 4 = 3"
_PARSED = f"""select raw_id, observed_at, location,
  case when {_FLAT} then null else cast(latitude as double) end as latitude,
  case when {_FLAT} then null else cast(longitude as double) end as longitude,
  case when raw_id % 2 = 0 then 'Forecast' else 'Events' end as source,
  case when {_FLAT} then ' sw ' else 'sw' end as wind_direction, condition_code, condition_desc,
  {sql.doubles(*MEASURES)} from obs"""


@query("p2_parse_raw_json", f"{OBS} {_PARSED}")
def _(spark, sf):
    return parse.parse_raw_json(documents(spark, sf), KEYS)


@query(
    "p2a_location_pick",
    f"""{OBS} select location, count(*) as rows,
    count(case when {_FLAT} then null else latitude end) as placed from obs group by location""",
)
def _(spark, sf):
    parsed = parse.parse_raw_json(documents(spark, sf), KEYS)
    return parsed.groupBy("location").agg(
        F.count(F.lit(1)).alias("rows"), F.count("latitude").alias("placed")
    )


@query(
    "p2b_measure_aliasing",
    f"""{OBS} select location, {", ".join(f"count({m}) as {m}_n, cast(max({m}) as double) as {m}_max"
    for m in MEASURES)} from obs group by location""",
)
def _(spark, sf):
    parsed = parse.parse_raw_json(documents(spark, sf), KEYS)
    wanted = [
        part for m in MEASURES for part in (F.count(m).alias(f"{m}_n"), F.max(m).alias(f"{m}_max"))
    ]
    return parsed.groupBy("location").agg(*wanted)


@query(
    "p3_normalize_forecast",
    f"""{_FORECAST_SQL} select raw_id, cast(position as bigint) as position, observed_at,
    cast(t as double) as temperature, cast(humidity as double) as humidity,
    cast(null as double) as pressure, 'sw' as wind_direction,
    {sql.doubles("wind_speed", "rainfall", "visibility", "cloud_coverage")},
    condition_code, condition_desc from timed""",
)
def _(spark, sf):
    entries = parse.explode_forecast(forecasts(spark, sf), KEYS)
    return parse.normalize_forecast(entries).select(
        "raw_id", "position", "observed_at", "temperature", "humidity", "pressure",
        "wind_direction", "wind_speed", "rainfall", "visibility", "cloud_coverage",
        "condition_code", "condition_desc",
    )


_COMPASS = "['" + "','".join(("N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW").split()) + "']"


def _compass(column: str) -> str:
    return f"{_COMPASS}[cast(floor(({column} + 11.25) / 22.5) as int) % 16 + 1]"


@query(
    "p4_normalize_openweather",
    f"""{OBS} select raw_id, date_trunc('second', observed_at) as observed_at, location,
    {sql.doubles("temperature", "humidity", "pressure", "wind_speed", "cloud_coverage")},
    case when wind_deg <> 0 then {_compass("wind_deg")} end as wind_direction,
    cast(case when rainfall <> 0 then rainfall else raw_id % 3 end as double) as rainfall,
    cast(nullif(raw_id % 10, 0) as double) as visibility,
    cast([200, 500, 800, 802, 999][raw_id % 5 + 1] as varchar) as condition_code,
    case when raw_id % 2 = 0 then condition_desc else ['Thunderstorm with light rain', 'Light rain',
      'Clear sky', 'Scattered clouds', null][raw_id % 5 + 1] end as condition_desc from obs""",
)
def _(spark, sf):
    rows = parse.normalize_openweather(fixtures.openweather_documents(spark, sf))
    return rows.drop("latitude", "longitude", "source", "uv_index")


@query(
    "p5_parse_observed_at",
    f"""{_FORECAST_SQL} select raw_id, cast(position as bigint) as position, observed_at,
    only_local from timed""",
)
def _(spark, sf):
    entries = parse.explode_forecast(forecasts(spark, sf), KEYS)
    moment = parse.parse_observed_at(F.col("entry"), F.current_timestamp())
    no_utc = parse.field(F.col("entry"), "$.datetime").isNull()
    return entries.select(
        "raw_id", "position", moment.alias("observed_at"), no_utc.alias("only_local")
    )


@query(
    "p6_as_float",
    """select event_id, try_cast(case when event_id % 3 = 0 then event_type
    else cast(event_id % 100 as varchar) || '.5' end as double) as number from events""",
)
def _(spark, sf):
    rows = events.read_table(spark, sf, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
        F.concat((F.col("event_id") % 100).cast("string"), F.lit(".5"))
    )
    return rows.select("event_id", parse.text_as_float(text).alias("number"))


def _of_entry(spark, sf, name, value) -> DataFrame:
    parsed = fixtures.raw_documents(spark, sf).withColumn("doc", F.try_parse_json("raw_json"))
    doc = F.col("doc")
    entry = F.coalesce(
        parse.field(doc, f"$.data[0].{KEYS.entries}[0][0]"),
        parse.field(doc, f"$.{KEYS.entries}[0]"),
        parse.field(doc, f"$.{KEYS.entries}"),
        parse.field(doc, "$.data"),
    )
    return parsed.select("raw_id", entry.alias("entry")).select(
        "raw_id", value(F.col("entry")).alias(name)
    )


@query("p7_visibility_km", f"{OBS} select raw_id, {sql.doubles('visibility')} from obs")
def _(spark, sf):
    return _of_entry(spark, sf, "visibility", parse.visibility_km)


@query("p8_condition_code", f"{OBS} select raw_id, condition_code from obs")
def _(spark, sf):
    return _of_entry(spark, sf, "condition_code", parse.condition_code)


@query("p9_condition_desc", f"{OBS} select raw_id, condition_desc from obs")
def _(spark, sf):
    return _of_entry(spark, sf, "condition_desc", parse.condition_desc)


@query("p10_deg_to_compass", f"{OBS} select raw_id, {_compass('wind_deg')} as compass from obs")
def _(spark, sf):
    from skymart.functions.classes import deg_to_compass

    return observations(spark, sf).select(
        "raw_id", deg_to_compass(F.col("wind_deg")).alias("compass")
    )


@query(
    "p11_owm_condition_lookup",
    """select event_id, case event_id % 1000 when 200 then 'Thunderstorm with light rain'
    when 201 then 'Thunderstorm with rain' when 202 then 'Thunderstorm with heavy rain'
    when 300 then 'Light drizzle' when 301 then 'Drizzle' when 500 then 'Light rain'
    when 501 then 'Moderate rain' when 502 then 'Heavy rain' when 600 then 'Light snow'
    when 701 then 'Mist' when 721 then 'Haze' when 800 then 'Clear sky' when 801 then 'Few clouds'
    when 802 then 'Scattered clouds' when 803 then 'Broken clouds' when 804 then 'Overcast clouds'
    end as description from events""",
)
def _(spark, sf):
    from skymart.functions.classes import owm_condition_text

    rows = events.read_table(spark, sf, "events")
    return rows.select(
        "event_id", owm_condition_text(F.col("event_id") % 1000).alias("description")
    )


NEAREST_AS_OF = datetime(2024, 1, 16, 1, 10, 0)
_NEAREST_SQL = f"""{_FORECAST_SQL}, ranked as (
  select *, row_number() over (partition by location order by
    abs(epoch_us(observed_at) - epoch_us(timestamp '2024-01-16 01:10:00')), raw_id, position) as rn
  from timed
), nearest as (
  select raw_id, position, location, t, time_bucket(interval '3 hours', observed_at) as observed_at
  from ranked where rn = 1
), matched as (
  select n.location, n.observed_at, arg_min(e.t, e.raw_id * 10 + e.position) as t
  from nearest n left join timed e on e.location = n.location and not e.only_local
    and abs(epoch_us(e.observed_at) - epoch_us(n.observed_at)) < 60000000
  group by all
)"""


def _nearest(spark, sf):
    entries = parse.explode_forecast(forecasts(spark, sf), KEYS)
    return parse.nearest_entry(parse.normalize_forecast(entries), as_of=F.lit(NEAREST_AS_OF)), entries


@query(
    "p12_nearest_entry",
    f"""{_NEAREST_SQL} select location, raw_id, cast(position as bigint) as position, observed_at,
    cast(t as double) as temperature from nearest""",
)
def _(spark, sf):
    return _nearest(spark, sf)[0].select(
        "location", "raw_id", "position", "observed_at", "temperature"
    )


@query(
    "p13_match_raw_entry",
    f"{_NEAREST_SQL} select location, observed_at, cast(t as double) as t from matched",
)
def _(spark, sf):
    matched = parse.match_raw_entry(*_nearest(spark, sf))
    return matched.select(
        "location", "observed_at",
        F.get_json_object("raw_entry", "$.t").cast("double").alias("t"),
    )


@query(
    "p14_wrap_entry",
    f"""{_NEAREST_SQL} select location as adm4, cast(t as double) as t, 1::bigint as entries
    from matched""",
)
def _(spark, sf):
    wrapped = parse.wrap_entry(parse.match_raw_entry(*_nearest(spark, sf)), KEYS)
    stored = F.from_json("raw_json", f"{KEYS.place} struct<adm4:string>, {KEYS.entries} array<struct<t:double>>")
    return wrapped.select(stored.alias("d")).select(
        f"d.{KEYS.place}.adm4", F.get(f"d.{KEYS.entries}.t", F.lit(0)).alias("t"),
        F.size(f"d.{KEYS.entries}").alias("entries"),
    )


@query(
    "p15_location_names",
    f"""{OBS} select location as adm4, max('Desa ' || (raw_id % 3)) as desa from obs
    where raw_id % 2 = 0 and raw_id % 4 in (0, 1) and raw_id % 7 <> 0 group by location""",
)
def _(spark, sf):
    return parse.location_names(documents(spark, sf), "Forecast", KEYS)


_SEVERITY = """case event_type when 'error' then 'Extreme' when 'click' then 'Severe'
  when 'view' then 'Moderate' when 'signup' then 'Minor' else 'Other' end"""
_ALERTS = f"""with alerts as (select event_id, event_type as event,
  'Peringatan ' || event_id as headline, {_SEVERITY} as severity from events
  where event_id % 3 = 0 and event_id % 5 <> 0)"""


def _alerts(spark, sf):
    return alerts.parse_alerts(fixtures.alert_feed(spark, sf), fixtures.alert_documents(spark, sf), "north")


@query(
    "p16_parse_alerts",
    f"""{_ALERTS} select event_id as feed_id, 0::bigint as position, event, headline,
    '' as description, severity, case when event_id % 2 = 0 then 2 else 1 end::bigint as areas,
    case when event_id % 2 = 0 then 3 else 1 end::bigint as polygons from alerts""",
)
def _(spark, sf):
    return _alerts(spark, sf).select(
        "feed_id", "position", "event", "headline", "description", "severity",
        F.size("areas").alias("areas"), F.size(F.flatten("areas.polygons")).alias("polygons"),
    )


# -- cleaning ------------------------------------------------------------------------------------


@query(
    "c1_drop_missing_required",
    f"""{OBS} select raw_id, observed_at, location from obs
    where condition_code <> 'error' and raw_id % 3 <> 0""",
)
def _(spark, sf):
    rows = observations(spark, sf).withColumns(
        {
            "observed_at": F.when(F.col("raw_id") % 3 != 0, F.col("observed_at")),
            "location": F.when(F.col("condition_code") != "error", F.col("location")),
        }
    )
    return clean.drop_missing_required(rows).select("raw_id", "observed_at", "location")


@query(
    "c2_dedupe_keep_first",
    f"""{OBS} select raw_id, slot as observed_at, location from (select *, row_number() over
    (partition by slot, location order by raw_id) as rn from obs) d where rn = 1""",
)
def _(spark, sf):
    rows = events.observations(spark, sf).withColumn("observed_at", F.col("slot"))
    return clean.dedupe_keep_first(rows).select("raw_id", "observed_at", "location")


@query("c3_null_out_of_range", f"{CLEANED} select raw_id, {sql.doubles(*MEASURES)} from cleaned")
def _(spark, sf):
    return clean.null_out_of_range(observations(spark, sf)).select("raw_id", *MEASURES)


@query(
    "c4_to_utc",
    """select event_id, case when event_id % 4 <> 0 then date_trunc('second', ts) end as observed_at
    from events""",
)
def _(spark, sf):
    rows = events.read_table(spark, sf, "events")
    text = F.when(
        F.col("event_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.lit("not a time"))
    return rows.select("event_id", clean.to_utc(text, T.StringType()).alias("observed_at"))


@query(
    "c5_trim_nullify",
    """select event_id, case event_id % 5 when 0 then null when 1 then null when 2 then null
    else event_type end as value from events""",
)
def _(spark, sf):
    rows = events.read_table(spark, sf, "events")
    kind = F.col("event_id") % 5
    padded = F.concat(F.lit(" \t"), F.col("event_type"), F.lit("\n "))
    text = (
        F.when(kind == 0, F.lit("  ")).when(kind == 1, F.lit("None")).when(kind == 2, F.lit(" nan"))
        .otherwise(padded)
    )
    return rows.select("event_id", clean.trim_nullify(text).alias("value"))


@query("c6_upper_wind", "select event_id, upper(event_type) as wind_direction from events")
def _(spark, sf):
    rows = events.read_table(spark, sf, "events")
    return clean.upper_wind(rows.select("event_id", F.col("event_type").alias("wind_direction")))


@query(
    "c7_clean_standardize",
    f"""{CLEANED} select raw_id, observed_at, location, condition_code, condition_desc,
    {sql.doubles(*MEASURES)} from cleaned""",
)
def _(spark, sf):
    return cleaned(spark, sf).select(
        "raw_id", "observed_at", "location", "condition_code", "condition_desc", *MEASURES
    )


# -- enrichment ----------------------------------------------------------------------------------

_ALL = "over (partition by location)"


@query(
    "f1_add_features",
    f"""{CLEANED} select raw_id, {sql.mean("temperature", _ALL)} as temp_avg,
    cast(max(temperature) {_ALL} as double) as temp_max,
    cast(min(temperature) {_ALL} as double) as temp_min,
    {sql.mean("humidity", _ALL)} as humidity_avg, {sql.mean("pressure", _ALL)} as pressure_avg
    from cleaned""",
)
def _(spark, sf):
    return enrich.add_features(cleaned(spark, sf)).select("raw_id", *enrich.FEATURES)


def _class_query(name: str, column: str, case: str) -> None:
    @query(name, f"{CLEANED} select raw_id, {case} as {column} from cleaned")
    def _(spark, sf):
        return enrich.classify(cleaned(spark, sf)).select("raw_id", column)


_class_query("k1_classify_temperature", "temp_class", sql.TEMP_CLASS)
_class_query("k2_classify_humidity", "humidity_class", sql.HUMIDITY_CLASS)
_class_query("k3_classify_wind", "wind_class", sql.WIND_CLASS)
_class_query("k4_classify_rainfall", "rainfall_class", sql.RAIN_CLASS)


@query("k5_classify", f"{CLEANED} select raw_id, {sql.CLASSES} from cleaned")
def _(spark, sf):
    return enrich.classify(cleaned(spark, sf)).select(
        "raw_id", "temp_class", "humidity_class", "wind_class", "rainfall_class"
    )


@query(
    "k6_temp_band",
    f"""{CLEANED} select raw_id, case when temperature is null then null
    when temperature >= 38 then 'Sangat Panas' when temperature >= 33 then 'Panas'
    when temperature >= 28 then 'Hangat' when temperature >= 20 then 'Normal' else 'Dingin' end
    as map_band, case when temperature is null then null when temperature >= 35 then '35'
    when temperature >= 32 then '32' when temperature >= 28 then '28' when temperature >= 24
    then '24' else '<24' end as card_band from cleaned""",
)
def _(spark, sf):
    from skymart.functions.classes import CARD_BANDS, CARD_BELOW, temp_band

    return cleaned(spark, sf).select(
        "raw_id",
        temp_band(F.col("temperature")).alias("map_band"),
        temp_band(F.col("temperature"), CARD_BANDS, CARD_BELOW).alias("card_band"),
    )


@query(
    "k7_condition_desc_to_code",
    f"""{OBS} select raw_id, cast(case condition_desc when 'Cerah' then 0 when 'Cerah Berawan' then 2
    when 'Hujan Sedang' then 63 when 'Hujan Petir' then 95 else 3 end as bigint) as icon from obs""",
)
def _(spark, sf):
    from skymart.functions.classes import condition_icon

    return observations(spark, sf).select(
        "raw_id", condition_icon(F.col("condition_desc")).alias("icon")
    )


@query(
    "k8_is_daytime",
    f"""{OBS} select raw_id, hour(observed_at + interval 7 hours) between 6 and 17 as is_day
    from obs""",
)
def _(spark, sf):
    from skymart.functions.classes import is_daytime

    return observations(spark, sf).select("raw_id", is_daytime(F.col("observed_at")).alias("is_day"))


_LINE = "over (partition by location order by observed_at, raw_id {frame})"
_MA = _LINE.format(frame="rows between 2 preceding and current row")
_AHEAD = _LINE.format(frame="rows between 3 preceding and 1 preceding")
_STEP = _LINE.format(frame="")
_T1 = f"{sql.mean('temperature', _MA)} as temp_ma, {sql.mean('humidity', _MA)} as humidity_ma"
_T2 = f"""cast(temperature - lag(temperature) {_STEP} as double) as temp_delta,
  cast(humidity - lag(humidity) {_STEP} as double) as humidity_delta"""
_A1 = f"""coalesce(count(temperature) {_ALL} >= 2 and stddev_samp(temperature::double) {_ALL} > 0
  and abs(temperature::double - avg(temperature::double) {_ALL})
  / nullif(stddev_samp(temperature::double) {_ALL}, 0) > 2.5, false) as is_anomaly"""
_PR1 = f"{sql.mean('temperature', _AHEAD)} as predicted_temp"


@query("t1_moving_average", f"{CLEANED} select raw_id, {_T1} from cleaned")
def _(spark, sf):
    return enrich.moving_average(cleaned(spark, sf)).select("raw_id", "temp_ma", "humidity_ma")


@query("t2_delta", f"{CLEANED} select raw_id, {_T2} from cleaned")
def _(spark, sf):
    return enrich.delta(cleaned(spark, sf)).select("raw_id", "temp_delta", "humidity_delta")


@query("a1_detect_anomalies", f"{CLEANED} select raw_id, {_A1} from cleaned")
def _(spark, sf):
    return enrich.detect_anomalies(cleaned(spark, sf)).select("raw_id", "is_anomaly")


@query("pr1_predict", f"{CLEANED} select raw_id, {_PR1} from cleaned")
def _(spark, sf):
    return enrich.predict(cleaned(spark, sf)).select("raw_id", "predicted_temp")


@query(
    "r1_run_transform",
    f"""{CLEANED} select raw_id, observed_at, location,
    case when raw_id % 2 = 0 then 'Forecast' else 'Events' end as source, 'SW' as wind_direction,
    {sql.doubles(*MEASURES)}, {sql.mean("temperature", _ALL)} as temp_avg, {sql.CLASSES},
    {_T1}, {_T2}, {_A1}, {_PR1} from cleaned""",
)
def _(spark, sf):
    result = transform.run_transform(
        documents(spark, sf), KEYS, stage=_new_path(spark, "cleaned"), exact=True
    )
    return result.select(
        "raw_id", "observed_at", "location", "source", "wind_direction", *MEASURES, "temp_avg",
        "temp_class", "humidity_class", "wind_class", "rainfall_class", "temp_ma", "humidity_ma",
        "temp_delta", "humidity_delta", "is_anomaly", "predicted_temp",
    )


# -- quality and load ----------------------------------------------------------------------------

_CHECKED_COLUMNS = ("observed_at", "location", "temperature", "humidity", "wind_speed", "rainfall",
                    "source")


@query(
    "q1_quality_check",
    CLEANED
    + " union all ".join(
        f""" select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls,
        round((count(*) - count({c})) * 100.0 / count(*), 1) as pct from cleaned"""
        for c in _CHECKED_COLUMNS
    ),
)
def _(spark, sf):
    return quality.null_profile(cleaned(spark, sf))


@query(
    "q2_quality_gate",
    f"""{OBS} select location, false as blocked, count(*) - count(visibility) as nulls from obs
    group by location""",
)
def _(spark, sf):
    rows = observations(spark, sf)
    blocked = quality.blocks_load(quality.quality_check(rows))
    return rows.groupBy("location").agg(
        F.lit(blocked).alias("blocked"), F.count_if(F.col("visibility").isNull()).alias("nulls")
    )


@query("l1_watermark", f"{OBS} select max(slot) as last_loaded_at from obs")
def _(spark, sf):
    state = warehouse(spark, sf)
    facts = state.table("fact_weather").agg(F.max("time_id").alias("last"))
    mark = F.lit(state.snapshot().watermark_us)
    return facts.where(F.col("last") == mark).select(
        F.timestamp_micros(mark).alias("last_loaded_at")
    )


@query(
    "l2_filter_new",
    f"""{CLEANED} select raw_id, observed_at from cleaned
    where observed_at > timestamp '{sql.CUT}'""",
)
def _(spark, sf):
    return load.filter_new(cleaned(spark, sf), CUT).select("raw_id", "observed_at")


@query(
    "l3_build_dim_time",
    f"""{CLEANED} select distinct observed_at as timestamp, cast(cast(observed_at as date) as varchar) as date,
    hour(observed_at) as hour, day(observed_at) as day, month(observed_at) as month,
    year(observed_at) as year, isodow(observed_at) - 1 as day_of_week,
    isodow(observed_at) >= 6 as is_weekend from cleaned where observed_at > timestamp '{sql.CUT}'""",
)
def _(spark, sf):
    rows = cleaned(spark, sf)
    known = load.build_dim_time(rows.where(F.col("observed_at") <= F.lit(CUT)))
    return load.new_dim_time(known, rows).drop("time_id")


@query(
    "l4_upsert_dim_location",
    f"""{CLEANED}, old as (select location, arg_min(latitude + 1, raw_id) as lat from cleaned
      where observed_at <= timestamp '{sql.CUT}' group by location),
    new as (select location, case when raw_id % 2 = 0 then latitude end as lat from (select *,
        row_number() over (partition by location order by observed_at, raw_id) as rn from cleaned
        where observed_at > timestamp '{sql.CUT}') d where rn = 1)
    select 'Medan' as city, coalesce(n.location, o.location) as district,
      cast(coalesce(n.lat, o.lat) as double) as latitude, 'kecamatan' as region_level
    from new n full join old o on n.location = o.location""",
)
def _(spark, sf):
    rows = cleaned(spark, sf)
    early, late = (rows.where(c) for c in (F.col("observed_at") <= F.lit(CUT), F.col("observed_at") > F.lit(CUT)))
    early = early.withColumn("latitude", F.col("latitude") + 1)
    late = late.withColumn("latitude", F.when(F.col("raw_id") % 2 == 0, F.col("latitude")))
    empty = spark.createDataFrame([], warehouse(spark, sf).table("dim_location").schema)
    old = load.upsert_dim_location(empty, early)
    return load.upsert_dim_location(old, late).select("city", "district", "latitude", "region_level")


@query(
    "l5_extend_dim_weather",
    f"""{CLEANED}, combos as (select observed_at, condition_code,
      case when raw_id % 3 <> 0 then condition_desc end as condition_desc, {sql.CLASSES}
      from cleaned)
    select distinct condition_code, condition_desc, temp_class as temp_classification,
      humidity_class as humidity_classification, wind_class as wind_classification,
      rainfall_class as rain_classification from combos where observed_at > timestamp '{sql.CUT}'
    except select condition_code, condition_desc, temp_class, humidity_class, wind_class,
      rainfall_class from combos where observed_at <= timestamp '{sql.CUT}'""",
)
def _(spark, sf):
    rows = enrich.classify(cleaned(spark, sf)).withColumn(
        "condition_desc", F.when(F.col("raw_id") % 3 != 0, F.col("condition_desc"))
    )
    known = load.build_dim_weather(rows.where(F.col("observed_at") <= F.lit(CUT)))
    return load.extend_dim_weather(known, rows.where(F.col("observed_at") > F.lit(CUT))).drop(
        "weather_id"
    )


@query(
    "l6_upsert_fact",
    f"""{OBS} select slot as observed_at, {sql.doubles("temperature", "humidity", "wind_speed")},
    first_half as created_first from (select *, row_number() over (partition by slot, location
      order by raw_id % 2 desc, raw_id desc) as rn,
      bool_or(raw_id % 2 = 0) over (partition by slot, location) as first_half from obs) d
    where rn = 1""",
)
def _(spark, sf):
    rows = events.observations(spark, sf).withColumn("observed_at", F.col("slot"))
    first, second = datetime(2024, 6, 1), datetime(2024, 6, 2)
    even = load.fact_rows(rows.where(F.col("raw_id") % 2 == 0), created_at=F.lit(first))
    odd = load.fact_rows(rows.where(F.col("raw_id") % 2 == 1), created_at=F.lit(second))
    facts = load.upsert_fact(odd, load.upsert_fact(even))
    return facts.select(
        F.timestamp_micros("time_id").alias("observed_at"), "temperature", "humidity", "wind_speed",
        (F.col("created_at") == F.lit(first)).alias("created_first"),
    )


@query(
    "l6a_safe_num",
    """select event_id, case when event_id % 6 <> 0 then cast(cast(event_id % 1000 as double) / 8
    as decimal(5,2))::double end as value from events""",
)
def _(spark, sf):
    rows = events.read_table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 6 == 0, F.lit(float("nan")))
        .otherwise(F.col("event_id") % 1000 / F.lit(8.0))
        .alias("value"),
    )
    return rows.select("event_id", load.safe_num(rows, "value", "decimal(5,2)").alias("value"))


_FACT_COLUMNS = (
    "observed_at, district, condition_code, temp_class as temp_classification, "
    + sql.doubles(*MEASURES, "temp_avg", "temp_max", "temp_min")
)


def _facts(target: Warehouse) -> DataFrame:
    stored = views.Star.of(target)
    placed = views.with_district(stored.fact, stored)
    return views.with_weather(placed, stored, "condition_code", "temp_classification").select(
        views.observed_at().alias("observed_at"), "district", "condition_code",
        "temp_classification", *MEASURES, "temp_avg", "temp_max", "temp_min",
    )


@query("l7_load", f"{sql.FACT_IN_STEPS} select {_FACT_COLUMNS} from fact")
def _(spark, sf):
    target = Warehouse(spark, _new_path(spark, "warehouse"))
    rows = slotted(spark, sf)
    load.load(transform.loadable(rows.where(F.col("observed_at") <= F.lit(CUT))), target)
    load.load(transform.loadable(rows), target)
    load.load(transform.loadable(rows), target)  # nothing new
    return _facts(target)


_BROKEN = {
    "unique fact (time_id, location_id)": "count(*) filter (where temperature >= 30)",
    "fact time_id exists": "count(distinct observed_at) filter (where hour(observed_at) = 3)",
    "unique time_id": "0",
    "fact location_id exists": f"count(distinct district) filter (where district like '{PARENT}.%')",
    "unique location_id": "0",
    "fact weather_id exists": "0",
    "unique weather_id": "count(distinct (condition_code, condition_desc, temp_class, "
    "humidity_class, wind_class, rainfall_class)) filter (where condition_code = 'view')",
}


@query(
    "l8_fact_key_check",
    sql.FACT
    + " union all ".join(
        f" select '{rule}' as rule, cast({count} as bigint) as violations from fact"
        if count != "0"
        else f" select '{rule}', 0::bigint"
        for rule, count in _BROKEN.items()
    ),
)
def _(spark, sf):
    """The check over tables broken on purpose; the intact ones have no violation."""
    fact, time, place, weather = (
        warehouse(spark, sf).table(name)
        for name in ("fact_weather", "dim_time", "dim_location", "dim_weather")
    )
    return quality.fact_key_check(
        fact.unionByName(fact.where(F.col("temperature") >= 30)),
        time.where(F.col("hour") != 3),
        place.where(~queries.under(PARENT)),
        weather.unionByName(weather.where(F.col("condition_code") == "view")),
    )


# -- views ---------------------------------------------------------------------------------------

_WEATHER_SQL = """temp_class as temp_classification, humidity_class as humidity_classification,
  wind_class as wind_classification, rainfall_class as rain_classification, condition_desc"""
_PLACE = sql.doubles("latitude", "longitude")


@query(
    "v1_overview",
    f"""{sql.FACT} select district, {_PLACE}, {sql.doubles("temperature", "humidity", "wind_speed")},
    cast(null as varchar) as wind_direction, {sql.doubles("rainfall", "cloud_coverage", "visibility")},
    {_WEATHER_SQL}, observed_at, source from (select *, row_number() over
      (partition by district order by observed_at desc) as rn from fact) d where rn = 1""",
)
def _(spark, sf):
    return views.overview(star(spark, sf))


@query(
    "v2_analytics",
    f"""{sql.FACT} select district, count(*) as total_observations,
    {sql.rounded_mean("temperature", 1)} as avg_temperature,
    cast(round(min(temperature), 1) as double) as min_temperature,
    cast(round(max(temperature), 1) as double) as max_temperature,
    {sql.rounded_mean("humidity", 1)} as avg_humidity,
    {sql.rounded_mean("wind_speed", 1)} as avg_wind_speed,
    {sql.rounded_mean("rainfall", 2)} as avg_rainfall,
    cast(round(sum(rainfall), 2) as double) as total_rainfall,
    {sql.rounded_mean("cloud_coverage", 1)} as avg_cloud_coverage,
    min(observed_at) as first_observation, max(observed_at) as last_observation
    from fact group by district""",
)
def _(spark, sf):
    return views.analytics(star(spark, sf))


_DLINE = "over (partition by district order by observed_at {frame})"
_DMA = _DLINE.format(frame="rows between 2 preceding and current row")
_DSTEP = _DLINE.format(frame="")


def _trend_sql(names: tuple[str, str, str]) -> str:
    return f"""{sql.rounded_mean("temperature", 1, _DMA)} as {names[0]},
    {sql.rounded_mean("humidity", 1, _DMA)} as {names[1]},
    {sql.rounded_mean("rainfall", 2, _DMA)} as {names[2]},
    cast(round(temperature - lag(temperature) {_DSTEP}, 1) as double) as temp_delta,
    cast(round(humidity - lag(humidity) {_DSTEP}, 1) as double) as humidity_delta"""


@query(
    "v3_trend",
    f"""{sql.FACT} select district, cast(cast(observed_at as date) as varchar) as date, hour(observed_at) as hour,
    observed_at as timestamp, {sql.doubles("temperature", "humidity", "rainfall")},
    {_trend_sql(("temp_ma_3h", "humidity_ma_3h", "rainfall_ma_3h"))} from fact""",
)
def _(spark, sf):
    return views.trend(star(spark, sf))


@query(
    "v4_heatmap",
    f"""{sql.FACT} select district, {_PLACE}, temp_class as temp_classification,
    {sql.rounded_mean("temperature", 1)} as avg_temperature,
    {sql.rounded_mean("rainfall", 2)} as avg_rainfall,
    {sql.rounded_mean("humidity", 1)} as avg_humidity, count(*) as data_points from fact
    where observed_at >= {AS_OF_SQL} - interval 24 hours
    group by district, latitude, longitude, temp_class""",
)
def _(spark, sf):
    return views.heatmap(star(spark, sf), as_of=AS_OF)


@query(
    "v5_prediction",
    f"""{sql.FACT} select district, observed_at as last_observed,
    cast(temperature as double) as current_temp, {sql.doubles("temp_avg", "temp_max", "temp_min")},
    temp_class as temp_classification from (select *, row_number() over
      (partition by district order by observed_at desc) as rn from fact) d where rn <= 3""",
)
def _(spark, sf):
    return views.prediction(star(spark, sf))


@query(
    "v6_anomaly",
    f"""{sql.FACT}, stats as (select district, count(*) as rows, count(temperature) as n,
      sum({sql.cents("temperature")}) as s,
      sum({sql.cents("temperature")} * {sql.cents("temperature")}) as q from fact group by district),
    spread as (select *, case when n > 1 then cast(n * q - s * s as double) / (n - 1) end as v
      from stats where rows >= 2),
    scored as (select f.*, s.n, s.s, s.v, abs({sql.cents("temperature")} * s.n - s.s)::double
      / nullif(sqrt(s.n * s.v), 0) as z from fact f join spread s using (district))
    select district, observed_at as timestamp, cast(temperature as double) as temperature,
      cast(round(cast(cast(s as double) / n / 100 as decimal(18,8)), 1) as double) as mean_temp,
      round(sqrt(v / n) / 100, 1) as std_temp, round(z, 2) as z_score,
      coalesce(z > 2.5, false) as is_anomaly, temp_class as temp_classification, condition_desc
    from scored""",
)
def _(spark, sf):
    return views.anomaly(star(spark, sf))


# -- parameterized queries -----------------------------------------------------------------------

_CLOSEST = f"""{sql.FACT}, closest as (select observed_at as ts, count(distinct district) as n
  from fact where regexp_matches(district, '^12\\.71\\.\\d{{2}}\\.\\d{{4}}$') group by observed_at
  having count(distinct district) >= 10
  order by abs(epoch_us(observed_at) - epoch_us({AS_OF_SQL})), observed_at limit 1)"""
_SNAPSHOT_SQL = f"""district, {_PLACE},
  {sql.doubles("temperature", "humidity", "pressure", "wind_speed", "rainfall", "visibility",
               "cloud_coverage")},
  cast(null as varchar) as wind_direction, {_WEATHER_SQL}, observed_at, source"""


@query(
    "g1_closest_timestamp", f"{_CLOSEST} select ts as timestamp, n as locations from closest"
)
def _(spark, sf):
    return queries.closest_timestamp(star(spark, sf), as_of=AS_OF)


@query("g2_current", f"{_CLOSEST} select {_SNAPSHOT_SQL} from fact, closest where observed_at = ts")
def _(spark, sf):
    return queries.current(star(spark, sf), as_of=AS_OF)


@query(
    "g3_current_district",
    f"""{_CLOSEST}, one as (select min(district) as d from fact, closest where observed_at = ts)
    select {_SNAPSHOT_SQL} from fact, closest, one where observed_at = ts and district = d""",
)
def _(spark, sf):
    at_hand = queries.current(star(spark, sf), as_of=AS_OF).agg(F.min("district")).first()[0]
    return queries.current(star(spark, sf), as_of=AS_OF, district=at_hand or "")


_PARENT_NAME = (
    "case substr(district, 1, 8) "
    + " ".join(f"when '12.71.{c}' then '{n}'" for c, (n, _n) in admin.DISTRICTS.items())
    + " else {missing} end"
)


@query(
    "g4_map",
    f"""{_CLOSEST} select {_SNAPSHOT_SQL}, {_PARENT_NAME.format(missing="'Unknown'")} as kecamatan
    from fact, closest where observed_at = ts
    and regexp_matches(district, '^12\\.71\\.\\d{{2}}\\.\\d{{4}}$')""",
)
def _(spark, sf):
    return queries.weather_map(star(spark, sf), as_of=AS_OF)


_FORECAST_COLUMNS = f"""district,
  {sql.doubles("temperature", "humidity", "rainfall", "wind_speed", "cloud_coverage")},
  condition_desc, temp_class as temp_classification, observed_at,
  {sql.doubles("temp_avg", "temp_max", "temp_min")}"""


@query(
    "g5_forecast_adm4",
    f"""{sql.FACT} select {_FORECAST_COLUMNS} from fact where district = '{DISTRICT}'
    order by observed_at desc limit 24""",
)
def _(spark, sf):
    return queries.forecast(star(spark, sf), adm4=DISTRICT)


@query(
    "g6_forecast_kecamatan",
    f"""{sql.FACT} select {_FORECAST_COLUMNS} from fact where district like '{PARENT}.%'
    order by fact.observed_at desc, fact.district limit 48""",
)
def _(spark, sf):
    return queries.forecast(star(spark, sf), kecamatan=PARENT, limit="48")


@query(
    "g7_forecast",
    f"""{sql.FACT} select {_FORECAST_COLUMNS} from fact
    order by fact.district, fact.observed_at desc limit 96""",
)
def _(spark, sf):
    return queries.forecast(star(spark, sf), limit=500)


@query(
    "g8_forecast_nested",
    f"""{sql.FACT}, top as (select * from fact where district like '{PARENT}.%'
      order by observed_at desc, district limit 24)
    select district, cast(row_number() over (partition by district order by observed_at desc) - 1
      as bigint) as pos, observed_at, cast(temperature as double) as temperature,
      condition_desc as condition, cast(temp_avg as double) as temp_avg from top""",
)
def _(spark, sf):
    nested = queries.forecast_nested(queries.forecast(star(spark, sf), kecamatan=PARENT))
    return nested.select("district", F.posexplode("observations")).select(
        "district", "pos", "col.observed_at", "col.temperature", "col.condition",
        "col.aggregates.temp_avg",
    )


_TREND_SQL = f"""{sql.FACT}, lined as (select district,
  {sql.doubles("temperature", "humidity", "rainfall")}, observed_at, {_trend_sql(queries.TREND_NAMES)},
  row_number() over (partition by district order by observed_at desc) as rn from fact {{where}})"""


@query("g9_trend", f"{_TREND_SQL.format(where='')} select * from lined where rn <= 24")
def _(spark, sf):
    return queries.trend(star(spark, sf))


@query(
    "g9_trend_adm4",
    f"""{_TREND_SQL.format(where=f"where district = '{DISTRICT}'")} select * from lined
    where rn <= 10""",
)
def _(spark, sf):
    return queries.trend(star(spark, sf), adm4=DISTRICT, limit=10)


@query(
    "g9_trend_kecamatan",
    f"""{_TREND_SQL.format(where=f"where district like '{PARENT}.%'")} select * from lined
    where rn <= 96""",
)
def _(spark, sf):
    return queries.trend(star(spark, sf), kecamatan=PARENT, limit=100)


@query(
    "g10_trend_nested",
    f"""{_TREND_SQL.format(where='')} select district, rn - 1 as pos, observed_at, temperature,
    temp_ma, humidity_delta from lined where rn <= 24""",
)
def _(spark, sf):
    nested = queries.trend_nested(queries.trend(star(spark, sf), ordered=False))
    return nested.select("district", F.posexplode("trend")).select(
        "district", "pos", "col.observed_at", "col.temperature",
        F.col("col.moving_averages.temperature").alias("temp_ma"),
        F.col("col.deltas.humidity").alias("humidity_delta"),
    )


@query(
    "g11_heatmap",
    f"""{sql.FACT} select district, {_PLACE}, {sql.rounded_mean("temperature", 1)} as avg_temperature,
    {sql.rounded_mean("rainfall", 2)} as avg_rainfall, {sql.rounded_mean("humidity", 1)} as avg_humidity,
    {sql.rounded_mean("cloud_coverage", 1)} as avg_cloud_coverage, count(*) as data_points from fact
    where observed_at >= {AS_OF_SQL} - interval 168 hours group by district, latitude, longitude""",
)
def _(spark, sf):
    return queries.heatmap(star(spark, sf), as_of=AS_OF, hours=1000)


@query(
    "g12_locations",
    f"""{OBS}, names as (select location, max('Desa ' || (raw_id % 3)) as desa from obs
      where raw_id % 2 = 0 and raw_id % 4 in (0, 1) and raw_id % 7 <> 0 group by location),
    coded as (select distinct location as district from obs)
    select {_PARENT_NAME.format(missing="substr(district, 1, 8)")} as kecamatan,
      cast(row_number() over (partition by {_PARENT_NAME.format(missing="substr(district, 1, 8)")}
        order by district) - 1 as bigint) as pos, district as adm4, coalesce(desa, district) as name
    from coded left join names on location = district""",
)
def _(spark, sf):
    names = parse.location_names(documents(spark, sf), "Forecast", KEYS)
    nested = queries.locations(warehouse(spark, sf).table("dim_location"), names)
    return nested.select("kecamatan", F.posexplode("kelurahan")).select(
        "kecamatan", "pos", "col.adm4", "col.name"
    )


# -- page data -----------------------------------------------------------------------------------


@query(
    "u1_hottest_per_parent",
    f"""{_CLOSEST} select {_PARENT_NAME.format(missing="substr(district, 1, 8)")} as kecamatan,
    district, cast(temperature as double) as temperature from (select *, row_number() over
      (partition by substr(district, 1, 8) order by coalesce(temperature, -999) desc, district)
      as rn from fact, closest where observed_at = ts) d where rn = 1""",
)
def _(spark, sf):
    snapshot = queries.current(star(spark, sf), as_of=AS_OF)
    return pages.hottest_per_parent(snapshot).select("kecamatan", "district", "temperature")


@query(
    "u2_hottest_overall",
    f"""{_CLOSEST} select district, cast(temperature as double) as temperature from fact, closest
    where observed_at = ts order by coalesce(fact.temperature, -999) desc, district limit 1""",
)
def _(spark, sf):
    snapshot = queries.current(star(spark, sf), as_of=AS_OF)
    return pages.hottest_overall(snapshot).select("district", "temperature")


@query(
    "u3_group_by_local_day",
    f"""{sql.FACT}, top as (select * from fact where district = '{DISTRICT}'
      order by observed_at desc limit 96)
    select cast(cast(observed_at + interval 7 hours as date) as varchar) as local_day,
      cast(row_number() over (partition by cast(observed_at + interval 7 hours as date)
        order by observed_at) - 1 as bigint) as pos, observed_at,
      cast(temperature as double) as temperature from top""",
)
def _(spark, sf):
    rows = queries.forecast(star(spark, sf), adm4=DISTRICT, limit=96)
    return pages.group_by_local_day(rows).select("local_day", F.posexplode("observations")).select(
        "local_day", "pos", "col.observed_at", "col.temperature"
    )


@query(
    "u4_weather_by_name",
    f"""{_CLOSEST} select 'Desa ' || d.district as name, f.district,
    cast(f.temperature as double) as temperature from (select distinct district from fact) d
    join fact f on f.district = d.district join closest on f.observed_at = ts""",
)
def _(spark, sf):
    snapshot = queries.current(star(spark, sf), as_of=AS_OF)
    codes = warehouse(spark, sf).table("dim_location").select("district")
    as_json = codes.select(
        F.to_json(F.create_map(F.concat(F.lit("Desa "), "district"), F.col("district"))).alias("j")
    )
    names = admin.name_code_rows(as_json, "j")
    return pages.weather_by_name(snapshot, names).select("name", "district", "temperature")


@query(
    "u5_top_alert",
    f"""{_ALERTS} select event_id as feed_id, headline, severity from alerts
    order by case severity when 'Extreme' then 1 when 'Severe' then 2 when 'Moderate' then 3
    when 'Minor' then 4 else 0 end, event_id limit 1""",
)
def _(spark, sf):
    return alerts.top_alert(_alerts(spark, sf)).select("feed_id", "headline", "severity")


@query(
    "u6_alert_polygons",
    f"""{_ALERTS} select event_id as feed_id, severity, (case when n = 0 then 'Utara' else 'Selatan'
      end) as "areaDesc", cast(case when n = 2 then 1 else 0 end as bigint) as polygon_position,
      4::bigint as points, cast(event_id % 180 as double) as first_lon,
      cast(event_id % 90 as double) as first_lat
    from alerts, (select unnest([0, 1, 2]) as n) k where n = 0 or event_id % 2 = 0""",
)
def _(spark, sf):
    first = F.get("polygon", F.lit(0))
    return alerts.alert_polygons(_alerts(spark, sf)).select(
        "feed_id", "severity", "areaDesc", "polygon_position", F.size("polygon").alias("points"),
        F.get(first, 0).alias("first_lon"), F.get(first, 1).alias("first_lat"),
    )


# -- spatial -------------------------------------------------------------------------------------

WIDTH, HEIGHT, RADIUS = 800.0, 600.0, 10.0

_SHAPES = """base as (select s_suppkey as k, 98.5 + (s_suppkey * 7 % 100) / 100.0 as x,
  3.5 + (s_suppkey * 13 % 100) / 100.0 as y from supplier),
square(dx, dy, i) as (values (-1.0, -1.0, 0), (1.0, -1.0, 1), (1.0, 1.0, 2), (-1.0, 1.0, 3),
  (-1.0, -1.0, 4)),
ell(dx, dy, i) as (values (0.0, 0.0, 0), (0.04, 0.0, 1), (0.04, 0.01, 2), (0.01, 0.01, 3),
  (0.01, 0.04, 4), (0.0, 0.04, 5), (0.0, 0.0, 6)),
vertex as (
  select k, 0 as p, i, x::double + (dx * 0.02)::double as lon, y::double + (dy * 0.02)::double as lat
    from base, square where k % 3 = 0
  union all select k, 0, i, x::double + dx::double, y::double + dy::double from base, ell
    where k % 3 = 1
  union all select k, 0, i, x::double + (dx * 0.005)::double, y::double + (dy * 0.005)::double
    from base, square where k % 3 = 2
  union all select k, 1, i, x::double + 0.1::double + (dx * 0.03)::double,
    y::double + (dy * 0.03)::double from base, square where k % 3 = 2
)"""
_BOX = """box as (select min(lon) as min_lon, max(lon) as max_lon, min(lat) as min_lat,
  max(lat) as max_lat from vertex)"""
_POINTS = """points as (select event_id as point_id, 98.40037::double
  + (event_id * 37 % 1300)::double / 1000 as lon,
  3.40037::double + (event_id * 53 % 1300)::double / 1000 as lat from events)"""


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 9) as {n}" for n in names)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


@query(
    "x1_bbox",
    f"""with {_SHAPES}, {_BOX}, wide as (select min_lon - (max_lon - min_lon) * 0.02 as min_lon,
      max_lon + (max_lon - min_lon) * 0.02 as max_lon, min_lat - (max_lat - min_lat) * 0.02 as min_lat,
      max_lat + (max_lat - min_lat) * 0.02 as max_lat from box)
    select {_round("min_lon", "max_lon", "min_lat", "max_lat")} from wide""",
)
def _(spark, sf):
    box = spatial.expand_bbox(spatial.bbox(fixtures.features(spark, sf)), 0.02)
    return _rounded(box, "min_lon", "max_lon", "min_lat", "max_lat")


@query(
    "x2_centroid",
    f"""with {_SHAPES} select k as feature_id, round(avg(lon), 9) as lon, round(avg(lat), 9) as lat
    from vertex group by k""",
)
def _(spark, sf):
    return _rounded(spatial.centroid(fixtures.features(spark, sf)), "lon", "lat")


def _merc(lat: str) -> str:
    return f"ln(tan(pi() / 4 + ({lat} * pi() / 180) / 2))"


_PROJECT = f"""floor((lon - min_lon) / (max_lon - min_lon) * 800 * 100 + 0.5) / 100 as x,
  floor(({_merc("max_lat")} - {_merc("lat")}) / ({_merc("max_lat")} - {_merc("min_lat")})
    * 600 * 100 + 0.5) / 100 as y"""


@query(
    "x3_mercator_project",
    f"""with {_SHAPES}, {_BOX}, {_POINTS} select point_id, {_PROJECT} from points, box""",
)
def _(spark, sf):
    box = spatial.bbox(fixtures.features(spark, sf))
    projected = spatial.mercator_project(fixtures.points(spark, sf), box, WIDTH, HEIGHT)
    return projected.select("point_id", "x", "y")


_UNPROJECT = f"""min_lon + x / 800 * (max_lon - min_lon) as lon,
  atan(sinh({_merc("min_lat")} + (1 - y / 600) * ({_merc("max_lat")} - {_merc("min_lat")})))
    * 180 / pi() as lat"""


@query(
    "x3_mercator_inverse",
    f"""with {_SHAPES}, {_BOX}, {_POINTS}, placed as (select point_id, {_PROJECT} from points, box),
    back as (select point_id, {_UNPROJECT} from placed, box)
    select point_id, {_round("lon", "lat")} from back""",
)
def _(spark, sf):
    box = spatial.bbox(fixtures.features(spark, sf))
    projected = spatial.mercator_project(fixtures.points(spark, sf), box, WIDTH, HEIGHT)
    back = spatial.mercator_unproject(projected.drop("lon", "lat"), box, WIDTH, HEIGHT)
    return _rounded(back.select("point_id", "lon", "lat"), "lon", "lat")


_INSIDE = """edge as (select k, p, lon as x1, lat as y1, lag(lon) over w as x0, lag(lat) over w as y0
  from vertex window w as (partition by k, p order by i)),
crossings as (select t.{key}, e.k, e.p, count(*) as n from {points} t join edge e
  on e.y0 is not null and (e.y1 > t.lat) <> (e.y0 > t.lat)
  and t.lon < (e.x0 - e.x1) * (t.lat - e.y1) / nullif(e.y0 - e.y1, 0) + e.x1 group by all),
hit as (select distinct {key} from crossings where n % 2 = 1)"""


@query(
    "x4_points_in_polygons",
    f"""with {_SHAPES}, {_POINTS}, {_INSIDE.format(key="point_id", points="points")}
    select point_id, hit.point_id is not null as inside from points left join hit using (point_id)""",
)
def _(spark, sf):
    flagged = spatial.flag_points(
        fixtures.points(spark, sf), fixtures.features(spark, sf), key="point_id"
    )
    return flagged.select("point_id", "inside")


@query(
    "x5_hex_grid",
    f"""with {_SHAPES}, {_BOX}, lattice as (select r as row, c as col,
      c * 15.0::double + (case when r % 2 <> 0 then 15.0 else 0 end)::double as x,
      r * (sqrt(3) * 10) as y from (select unnest(range(-1, 40)) as r) a,
      (select unnest(range(-1, 60)) as c) b),
    placed as (select row || ':' || col as cell, x, y, {_UNPROJECT} from lattice, box
      where y <= 600 + sqrt(3) * 10 and c_ok),
    {_INSIDE.format(key="cell", points="placed")}
    select placed.cell, round(x, 6) as cx, round(y, 6) as cy, {_round("lon", "lat")}
    from placed join hit using (cell)""".replace("and c_ok", "and x <= 800 + 15.0"),
)
def _(spark, sf):
    shapes = fixtures.features(spark, sf)
    grid = spatial.hex_grid(
        spatial.bbox(shapes), shapes, radius=RADIUS, width=WIDTH, height=HEIGHT
    )
    return grid.select(
        "cell", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"),
        F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"),
    )


@query(
    "x6_idw",
    f"""with {_POINTS}, stations as (select s_suppkey as seq,
      98.40037::double + (s_suppkey * 29 % 1300)::double / 1000 as slon,
      3.40037::double + (s_suppkey * 31 % 1300)::double / 1000 as slat,
      (20 + s_suppkey % 15)::double as v from supplier),
    pairs as (select point_id, seq, v,
      sqrt((lon - slon) * (lon - slon) + (lat - slat) * (lat - slat)) as d from points, stations)
    select point_id, round(coalesce(arg_min(v, seq) filter (where d < 0.0001),
      sum(v / (d * d)) filter (where d >= 0.0001) / sum(1 / (d * d)) filter (where d >= 0.0001)), 6)
      as value from pairs group by point_id""",
)
def _(spark, sf):
    values = spatial.idw(fixtures.points(spark, sf), fixtures.stations(spark, sf))
    return values.select("point_id", F.round("value", 6).alias("value"))


# -- streaming -----------------------------------------------------------------------------------


def _streamed(spark, sf) -> Warehouse:
    """Two runs of the stream: files up to the cut, then the rest."""
    source, checkpoint = _new_path(spark, "incoming"), _new_path(spark, "offsets")
    target = Warehouse(spark, _new_path(spark, "warehouse"))
    rows = fixtures.raw_documents(spark, sf, by_slot=True)
    for part in (F.col("observed_at") <= F.lit(CUT), F.col("observed_at") > F.lit(CUT)):
        raw.append_raw(rows.where(part), source)
        ingest.ingest_stream(spark, source, target, KEYS, checkpoint=checkpoint).awaitTermination()
    return target


@query("st1_ingest_stream", f"{sql.FACT_IN_STEPS} select {_FACT_COLUMNS} from fact")
def _(spark, sf):
    return _facts(_streamed(spark, sf))


@query(
    "st2_late_rows",
    f"""{CLEANED} select location, count(*) as late from cleaned
    where observed_at <= timestamp '{sql.CUT}' group by location""",
)
def _(spark, sf):
    late = ingest.late_rows(cleaned(spark, sf), CUT)
    return late.groupBy("location").agg(F.count(F.lit(1)).alias("late"))


@query(
    "st3_slot_3h",
    f"{OBS} select slot, count(*) as observations from obs group by slot",
)
def _(spark, sf):
    return ingest.slot_counts(observations(spark, sf))
