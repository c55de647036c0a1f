"""Table schemas as DDL strings."""

RAW = (
    "raw_id bigint, source string, raw_json string, observed_at timestamp, "
    "ingested_at timestamp, processed boolean"
)

OBSERVATION = (
    "raw_id bigint, observed_at timestamp, location string, latitude double, longitude double, "
    "source string, temperature double, humidity double, pressure double, wind_direction string, "
    "wind_speed double, rainfall double, uv_index double, visibility double, "
    "cloud_coverage double, condition_code string, condition_desc string"
)

DIM_TIME = (
    "time_id bigint, timestamp timestamp, date date, hour smallint, day smallint, month smallint, "
    "year smallint, day_of_week smallint, is_weekend boolean"
)

DIM_LOCATION = (
    "location_id bigint, city string, district string, latitude decimal(9,6), "
    "longitude decimal(9,6), region_level string"
)

DIM_WEATHER = (
    "weather_id bigint, condition_code string, condition_desc string, temp_classification string, "
    "humidity_classification string, wind_classification string, rain_classification string"
)

#: Decimal type of every fact measure.
FACT_MEASURES = {
    "temperature": "decimal(5,2)",
    "humidity": "decimal(5,2)",
    "pressure": "decimal(7,2)",
    "wind_speed": "decimal(5,2)",
    "rainfall": "decimal(6,2)",
    "uv_index": "decimal(4,2)",
    "visibility": "decimal(5,2)",
    "cloud_coverage": "decimal(5,2)",
    "temp_avg": "decimal(5,2)",
    "temp_max": "decimal(5,2)",
    "temp_min": "decimal(5,2)",
}

FACT_WEATHER = (
    "time_id bigint, location_id bigint, weather_id bigint, "
    + ", ".join(f"{name} {kind}" for name, kind in FACT_MEASURES.items())
    + ", wind_direction string, source string, created_at timestamp, date date"
)

_ROLLUP = (
    "rows bigint, first bigint, last bigint, low decimal(5,2), high decimal(5,2), "
    + ", ".join(
        f"{name}_sum bigint, {name}_n bigint"
        for name in ("temperature", "humidity", "wind_speed", "rainfall", "cloud_coverage")
    )
    + ", temperature_squares decimal(24,0)"
)

#: Sums of the facts kept by the load: per location and day, and per location.
FACT_DAYS = f"location_id bigint, date date, {_ROLLUP}, month string"
LOCATION_TOTALS = f"location_id bigint, {_ROLLUP}, bucket int"

#: Number of coded districts per timestamp, kept by the load.
TIME_COVERAGE = "time_id bigint, date date, districts bigint, month string"

#: Running per-location totals kept by the incremental ingest.
LOCATION_STATS = (
    "location string, rows bigint, temp_count bigint, temp_sum double, temp_max double, "
    "temp_min double, humidity_count bigint, humidity_sum double, pressure_count bigint, "
    "pressure_sum double, bucket int"
)

#: (location, observed_at) pairs already part of the history.
SEEN_KEYS = "location string, observed_at timestamp, date date"

TABLES = {
    "dim_time": DIM_TIME,
    "dim_location": DIM_LOCATION,
    "dim_weather": DIM_WEATHER,
    "fact_weather": FACT_WEATHER,
    "fact_days": FACT_DAYS,
    "location_totals": LOCATION_TOTALS,
    "time_coverage": TIME_COVERAGE,
    "location_stats": LOCATION_STATS,
    "seen_keys": SEEN_KEYS,
}
