from datetime import UTC, datetime, timedelta

import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from skymart.operators import load, quality
from skymart.plans import transform, views
from skymart.plans.catalog import _facts
from skymart.sources import admin
from skymart.sources.warehouse import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def batch(frame):
    def make(data):
        return transform.loadable(frame(data))

    return make


def count(warehouse, name="fact_weather"):
    return warehouse.table(name).count()


def violations(warehouse):
    names = ("fact_weather", "dim_time", "dim_location", "dim_weather")
    checks = quality.fact_key_check(*[warehouse.table(n) for n in names]).collect()
    return sum(r.violations for r in checks)


def test_quality_issues(frame):
    data = rows(4)
    data[0]["temperature"], data[1]["wind_speed"] = None, float("nan")
    df = frame(data)
    nulls = [quality.Issue(quality.NULLS, name, 1, 4) for name in ("temperature", "wind_speed")]
    assert quality.quality_check(frame(rows(2))) == []
    assert quality.quality_check(df) == nulls
    assert quality.quality_check(df.drop("temperature"))[0] == quality.Issue(quality.NO_COLUMN, "temperature")
    assert quality.blocks_load(quality.quality_check(df.limit(0)))
    assert not quality.blocks_load(quality.quality_check(df))
    with pytest.raises(quality.QualityError):
        quality.quality_gate(df.drop("source"))


def test_names_and_words_do_not_decide(frame):
    odd = frame(rows(2)).selectExpr("*", "cast(null as string) as missing_reason")
    issues = quality.quality_check(odd, ["temperature", "missing_reason"])
    assert [i.column for i in issues] == ["missing_reason"] and not quality.blocks_load(issues)


def test_facts_stay_unique_when_the_watermark_is_moved_back(batch, warehouse):
    data = rows(12)
    load.load(batch(data), warehouse)
    first = {r.time_id: r.created_at for r in warehouse.table("fact_weather").collect()}
    warehouse.set_watermark(data[3]["observed_at"])
    changed = [{**r, "temperature": 1.0} for r in data] + rows(3, start=data[-1]["observed_at"] + timedelta(hours=1))
    assert load.load(batch(changed), warehouse).inserted == 11
    facts = warehouse.table("fact_weather").collect()
    assert len(facts) == 15 and violations(warehouse) == 0
    assert {r.time_id: r.created_at for r in facts if r.time_id in first} == first
    assert sum(float(r.temperature) == 1.0 for r in facts) == 8


def test_blocked_loads_publish_nothing(batch, warehouse):
    for bad in (batch(rows(2)).drop("rainfall"), batch(rows(2)).limit(0)):
        with pytest.raises(quality.QualityError):
            load.load(bad, warehouse)
    assert warehouse.snapshot().version == 0


def test_quality_can_be_skipped(batch, warehouse):
    assert load.load(batch(rows(2)).drop("rainfall"), warehouse, skip_quality=True).inserted == 2
    assert warehouse.table("fact_weather").where("rainfall is not null").count() == 0


def test_second_load_inserts_nothing(batch, warehouse):
    data = batch(rows(3))
    first = load.load(data, warehouse)
    assert (first.inserted, first.skipped) == (3, 0)
    assert warehouse.get_watermark() == START + timedelta(hours=6)
    again = load.load(data, warehouse)
    assert (again.inserted, again.skipped) == (0, 0)
    assert (count(warehouse), warehouse.snapshot().version) == (3, 1)
    assert violations(warehouse) == 0


def test_late_rows_are_dropped_for_every_location(batch, warehouse):
    load.load(batch(rows(3)), warehouse)
    mixed = rows(2, "B", first_id=10) + rows(1, "B", first_id=20, start=START + timedelta(days=1))
    assert load.load(batch(mixed), warehouse).inserted == 1
    assert count(warehouse) == 4


def test_features_are_a_snapshot_of_their_load(batch, warehouse):
    data = rows(4, temp=20.0)
    load.load(batch(data[:2]), warehouse)
    load.load(batch(data), warehouse)
    averages = [float(r.temp_avg) for r in warehouse.table("fact_weather").orderBy("time_id").collect()]
    assert averages == [20.5, 20.5, 21.5, 21.5]


def test_last_copy_wins_and_all_copies_count(batch, warehouse):
    data = rows(1) + [dict(rows(1)[0], raw_id=1, temperature=1.0)]
    assert load.load(batch(data), warehouse).inserted == 2
    assert [float(r.temperature) for r in warehouse.table("fact_weather").collect()] == [1.0]


def test_unresolved_rows_are_skipped(batch, warehouse):
    data = rows(2)
    data[1]["location"] = None
    result = load.load(batch(data), warehouse)
    assert (result.inserted, result.skipped) == (1, 1)


def test_overflow_fails_the_whole_load(batch, warehouse):
    data = rows(3)
    data[1]["temperature"] = 5000.0
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        load.load(batch(data), warehouse)
    assert warehouse.snapshot().version == 0 and count(warehouse) == 0


def test_facts_without_a_watermark_are_updated_in_place(spark, batch, warehouse):
    load.load(batch(rows(2)), warehouse)
    created = {r.time_id: r.created_at for r in warehouse.table("fact_weather").collect()}
    state = warehouse.snapshot()
    warehouse.publish(state, {}, None)
    changed = [dict(r, temperature=5.0) for r in rows(3)]
    load.load(batch(changed), warehouse)
    facts = warehouse.table("fact_weather").collect()
    assert len(facts) == 3 and {float(f.temperature) for f in facts} == {5.0}
    assert all(f.created_at == created.get(f.time_id, f.created_at) for f in facts)
    assert violations(warehouse) == 0


def test_a_second_writer_of_the_same_version_fails(batch, warehouse):
    base = warehouse.snapshot()
    load.load(batch(rows(1)), warehouse)
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        warehouse.publish(base, {}, 1)


def test_watermark_can_be_set(warehouse):
    assert warehouse.get_watermark() is None
    warehouse.set_watermark(datetime(2024, 1, 1))
    assert warehouse.get_watermark() == datetime(2024, 1, 1, tzinfo=UTC)


def test_time_dimension(frame):
    saturday = datetime(2024, 6, 15, 10, tzinfo=UTC)
    row = load.build_dim_time(frame(rows(1, start=saturday))).first()
    assert (row.hour, row.day, row.month, row.year, row.day_of_week, row.is_weekend) == (10, 15, 6, 2024, 5, True)


def test_coordinates_update_unless_null(frame):
    def placed(lat):
        return frame(rows(1)).withColumns({"latitude": F.lit(lat).cast("double"), "longitude": F.lit(98.6)})

    empty = admin.seed_rows(placed(1.0).sparkSession).limit(0)
    dim = load.upsert_dim_location(empty, placed(3.5))
    assert float(load.upsert_dim_location(dim, placed(None)).first().latitude) == 3.5
    assert float(load.upsert_dim_location(dim, placed(4.5)).first().latitude) == 4.5


def test_seeding_twice_adds_once(spark):
    empty = admin.seed_rows(spark).limit(0)
    assert admin.seed_locations(admin.seed_locations(empty)).count() == 21


def test_weather_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a")], "x string, y string")
    assert df.select(load.weather_key(F.col("x"), F.col("y"))).distinct().count() == 3


def test_key_check_finds_violations(batch, warehouse):
    load.load(batch(rows(2)), warehouse)
    fact, time, place, weather = (warehouse.table(n) for n in ("fact_weather", "dim_time", "dim_location", "dim_weather"))
    broken = quality.fact_key_check(fact.union(fact), time.limit(0), place, weather.union(weather))
    assert {r.rule: r.violations for r in broken.collect()} == {
        "unique fact (time_id, location_id)": 2, "fact time_id exists": 2, "unique time_id": 0,
        "fact location_id exists": 0, "unique location_id": 0, "fact weather_id exists": 0,
        "unique weather_id": weather.count()}


def test_views_over_sql_names(spark, batch, warehouse):
    load.load(batch(rows(3)), warehouse)
    warehouse.register_views()
    assert spark.sql("select count(*) from fact_weather join dim_time using (time_id)").first()[0] == 3
    star = views.Star.of(warehouse)
    latest = views.overview(star).collect()
    assert [(r.district, float(r.temperature)) for r in latest] == [("Medan Kota", 30.0)]
    assert _facts(warehouse).count() == 3


def test_dimensions_are_compacted(batch, warehouse, monkeypatch):
    monkeypatch.setattr(load, "MAX_DIRECTORIES", 2)
    for i, row in enumerate(rows(5)):
        load.load(batch([row]), warehouse)
    assert len(warehouse.snapshot().tables["dim_time"]) <= 2
    assert count(warehouse, "dim_time") == 5 and violations(warehouse) == 0
