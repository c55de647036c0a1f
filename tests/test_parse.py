import json
from datetime import datetime

from pyspark.sql import functions as F

from skymart.operators import parse
from skymart.plans import transform
from skymart.sources import admin, raw
from skymart.sources.fixtures import KEYS

RAW = "raw_id long, source string, raw_json string, observed_at timestamp"
ENTRY = {
    "datetime": "2026-07-11T03:00:00Z", "t": 31, "tcc": 100, "tp": 0, "weather": 3,
    "weather_desc": "Berawan", "wd_deg": 254, "wd": "SW", "ws": 4.1, "hu": 63, "vs": 5994,
    "local_datetime": "2026-07-11 10:00:00",
}
PLACE = {"adm4": "12.71.01.1001", "kecamatan": "Medan Kota", "desa": "Pasar Baru", "lat": 3.5, "lon": 98.6}


def documents(spark, *docs, source="Forecast"):
    text = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return spark.createDataFrame(
        [(i, source, t, datetime(2026, 7, 11)) for i, t in enumerate(text)], RAW
    )


def parsed(spark, *docs, **options):
    return parse.parse_raw_json(documents(spark, *docs), KEYS, **options).orderBy("raw_id").collect()


def test_four_shapes_give_the_same_measures(spark):
    flat = {"location": "X", "data": {"temperature": 31, "humidity": 63, "wind_direction": "SW",
            "wind_speed": 4.1, "rainfall": 0, "visibility": 5.994, "cloud_coverage": 100,
            "weather": {"code": "3", "description": "Berawan"}}}
    nested = {"location": "X", "data": {"data": flat["data"]}}
    got = parsed(
        spark, {"place": PLACE, "entries": ENTRY}, {"place": PLACE, "entries": [ENTRY, {}]},
        {"data": [{"place": PLACE, "entries": [[ENTRY], []]}]}, flat, nested,
    )
    measured = [
        (r.temperature, r.humidity, r.wind_direction, r.wind_speed, r.rainfall, r.visibility,
         r.cloud_coverage, r.condition_code, r.condition_desc) for r in got
    ]
    assert measured == [(31.0, 63.0, "SW", 4.1, 0.0, 5.994, 100.0, "3", "Berawan")] * 5
    assert [r.location for r in got] == ["12.71.01.1001"] * 3 + ["X"] * 2
    assert [r.latitude for r in got] == [3.5] * 3 + [None] * 2


def test_unknown_shapes_are_dropped(spark):
    docs = [{"x": 1}, {"data": []}, {"data": [1]}, {"data": 3}, {"data": {"data": None}},
            {"data": {"data": [1]}}, {"data": [{"entries": [[]]}]}, {"data": [{"entries": []}]}, "{broken", "[1]", "7"]
    assert parsed(spark, *docs) == []


def test_location_rules(spark):
    got = parsed(
        spark, {"place": {"adm4": "", "kecamatan": "K"}, "entries": ENTRY},
        {"place": {}, "entries": ENTRY}, {"place": {"kecamatan": None}, "entries": ENTRY},
        {"data": {"location": "inner", "temperature": 1}}, {"data": {"temperature": 1}},
        {"location": None, "data": {"location": "inner", "temperature": 1}},
    )
    assert [r.location for r in got] == ["K", "Unknown", None, "inner", "Unknown", None]


def test_present_null_does_not_fall_back(spark):
    got = parsed(
        spark, {"data": {"t": None, "temperature": 5}}, {"data": {"temperature": 5}},
        {"data": {"hu": "61.5", "humidity": 1}}, {"data": {"vs": None, "visibility": 7}},
    )
    assert [r.temperature for r in got] == [None, 5.0, None, None]
    assert got[2].humidity == 61.5 and got[3].visibility == 7.0


def test_condition_rules(spark):
    def pair(entry):
        row = parsed(spark, {"data": entry})[0]
        return row.condition_code, row.condition_desc

    assert pair({"weather": {"code": "BC01", "desc": "Cerah"}}) == ("BC01", "Cerah")
    assert pair({"weather": {"code": None}, "condition_code": "C"}) == (None, None)
    assert pair({"weather": None, "condition_code": "", "weather_code": "W"}) == ("W", None)
    assert pair({"condition_code": "C", "weather_desc": "", "condition_desc": "D"}) == ("C", "D")
    assert pair({"weather_description": "E"}) == (None, "E")


def test_empty_forecast_list_keeps_an_empty_row(spark):
    assert parsed(spark, {"place": PLACE, "entries": []})[0].temperature is None


def test_openweather(spark):
    full = {"dt": 1700000000, "main": {"temp": 30.1, "humidity": 70, "pressure": 1009},
            "wind": {"speed": 3.6, "deg": 225}, "weather": [{"id": 802, "description": "awan"}],
            "clouds": {"all": 40}, "visibility": 10000, "rain": {"1h": 0.4}}
    bare = {"dt": 1700000000}
    zeros = {"dt": 1, "wind": {"deg": 0}, "visibility": 0, "rain": {"1h": 0, "3h": 2}, "weather": [{"id": 802}]}
    rows = parse.normalize_openweather(documents(spark, full, bare, zeros)).orderBy("raw_id").collect()
    a, b, c = rows
    assert (a.wind_direction, a.visibility, a.condition_code, a.condition_desc, a.rainfall) == ("SW", 10.0, "802", "awan", 0.4)
    assert (b.temperature, b.rainfall, b.condition_code, b.condition_desc) == (None, 0.0, None, None)
    assert (c.wind_direction, c.visibility, c.rainfall, c.condition_desc) == (None, None, 2.0, "Scattered clouds")
    assert parsed(spark, full) == [] and len(parsed(spark, full, include_openweather=True)) == 1


def _forecast(*days):
    return {"data": [{"place": PLACE, "entries": list(days)}]}


def test_forecast_entries_and_times(spark):
    docs = documents(
        spark,
        _forecast([ENTRY, {"t": 1}], [{**ENTRY, "datetime": "2026-07-11T06:10:00+07:00"}, {"local_datetime": "2026-07-12 10:00:00"}]),
        {"data": []}, {"data": [{"entries": []}]},
    )
    entries = parse.explode_forecast(docs, KEYS)
    got = parse.normalize_forecast(entries).orderBy("position").collect()
    assert [r.position for r in got] == [0, 2, 3]
    assert [r.observed_at for r in got] == [
        datetime(2026, 7, 11, 3), datetime(2026, 7, 11, 6, 10), datetime(2026, 7, 12, 3)]
    assert (got[0].temperature, got[0].pressure, got[0].uv_index, got[0].visibility, got[0].condition_code) == (31.0, None, None, 5.994, "3")


def _stored(spark, as_of, *entries):
    exploded = parse.explode_forecast(documents(spark, _forecast(list(entries))), KEYS)
    near = parse.nearest_entry(parse.normalize_forecast(exploded), as_of=F.lit(as_of).cast("timestamp"))
    row = parse.wrap_entry(parse.match_raw_entry(near, exploded), KEYS).first()
    return row.observed_at, json.loads(row.raw_json)


def test_nearest_entry_is_stored_with_its_own_document(spark):
    later = {**ENTRY, "datetime": "2026-07-11T06:00:00Z", "t": 33}
    when, stored = _stored(spark, "2026-07-11 05:00:00", ENTRY, later)
    assert when == datetime(2026, 7, 11, 6) and stored["place"]["desa"] == "Pasar Baru"
    assert [e["t"] for e in stored["entries"]] == [33]


def test_first_entry_wins_a_tie_and_off_grid_entries_match_nothing(spark):
    later = {**ENTRY, "datetime": "2026-07-11T06:00:00Z", "t": 33}
    assert _stored(spark, "2026-07-11 04:30:00", ENTRY, later)[1]["entries"][0]["t"] == 31
    odd = {**ENTRY, "datetime": "2026-07-11T04:00:00Z"}
    when, stored = _stored(spark, "2026-07-11 04:00:00", odd)
    assert when == datetime(2026, 7, 11, 3) and stored["entries"] == [{}]


def test_documents_of_the_nearest_entries_are_parsed_once_before_the_match(spark):
    entries = parse.explode_forecast(documents(spark, {"data": [{"place": PLACE, "entries": [[ENTRY]]}]}), KEYS)
    near = parse.nearest_entry(parse.normalize_forecast(entries), as_of=F.lit(datetime(2026, 7, 11, 3)))
    matched = parse.match_raw_entry(near, entries)
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and "row_number" not in plan
    assert json.loads(matched.first().raw_entry)["t"] == 31


def test_location_names_take_one_name_per_code(spark):
    other = {**PLACE, "desa": "Zeta"}
    docs = documents(spark, {"place": PLACE, "entries": ENTRY}, {"place": other, "entries": ENTRY},
                     {"place": {**PLACE, "adm4": None}, "entries": ENTRY})
    assert [tuple(r) for r in parse.location_names(docs, "Forecast", KEYS).collect()] == [("12.71.01.1001", "Zeta")]


def test_run_transform_end_to_end(spark, tmp_path):
    docs = documents(spark, *[{"location": "A", "data": {"temperature": 20 + i}} for i in range(3)])
    docs = docs.withColumn("observed_at", F.col("observed_at") + F.make_interval(hours=F.col("raw_id")))
    for stage in (None, str(tmp_path / "stage")):
        got = transform.run_transform(docs, KEYS, stage=stage).orderBy("raw_id").collect()
        assert [r.temp_ma for r in got] == [20.0, 20.5, 21.0]
        assert {r.temp_avg for r in got} == {21.0} and not any(r.is_anomaly for r in got)
    empty = transform.run_transform(docs.limit(0), KEYS)
    assert empty.count() == 0 and "predicted_temp" in empty.columns


def test_staging_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    docs = documents(spark, {"a": 1}, {"a": 2}).drop("raw_id")
    raw.append_raw(docs, path)
    raw.append_raw(docs, path, first_id=raw.next_raw_id(spark, path))
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.select("raw_id").distinct().count() == 4
    assert stored.where("processed or ingested_at is null").count() == 0
    assert raw.read_raw_observations(spark, path).columns == ["raw_id", "source", "raw_json", "observed_at"]


def test_admin_codes(spark, tmp_path):
    codes = [r.adm4 for r in admin.admin_codes(spark).collect()]
    assert len(codes) == len(set(codes)) == 151
    assert all(len(c) == 13 and c.startswith("12.71.") for c in codes)
    assert "12.71.20.1011" in codes and admin.admin_adm3(spark).count() == 21
    (tmp_path / "map.json").write_text(json.dumps({"Amplas": "12.71.09.1001", "Timbang Deli": "12.71.09.1006"}))
    got = {tuple(r) for r in admin.name_code_map(spark, str(tmp_path / "map.json")).collect()}
    assert got == {("Amplas", "12.71.09.1001"), ("Timbang Deli", "12.71.09.1006")}


def test_members_of_documents_are_read_once(spark):
    """Shapes are told without building maps, lists or lambda rows of the members."""
    text = '{"place": {"adm4": "12.71.01.1001"}, "entries": [{"t": null, "temperature": 30, "hu": "x"}]}'
    rows = documents(spark, text)
    parsed = parse.parse_raw_json(rows, KEYS)
    row = parsed.first()
    # The first key counts where it exists, also if it holds null or no number.
    assert (row.location, row.temperature, row.humidity) == ("12.71.01.1001", None, None)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "map<string" not in plan.lower() and "maptype" not in plan.lower()
