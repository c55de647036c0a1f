from datetime import UTC, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skymart.functions import numeric
from skymart.operators import load
from skymart.plans import pages, queries, transform, views
from skymart.sources.warehouse import Warehouse

AS_OF = datetime(2024, 1, 15, 11, tzinfo=UTC)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    from conftest import SCHEMA

    data = []
    for n in range(12):
        data += rows(6, f"12.71.{n % 3 + 1:02d}.{1001 + n}", temp=20.0 + n, first_id=100 * n)
    data += rows(6, "Medan Kota", temp=50.0, first_id=5000)
    for row in data:
        if row["location"].endswith("1005"):
            row["temperature"] = None
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in data], SCHEMA)
    target = Warehouse(spark, str(tmp_path_factory.mktemp("views") / "wh"))
    load.load(transform.loadable(df), target)
    return views.Star.of(target)


@pytest.mark.parametrize(
    "value,expected",
    [(None, 24), ("", 24), ("12", 12), ("12abc", 12), ("abc", 24), ("0", 24), ("-5", 1), ("999", 96), (7, 7)],
)
def test_limits_are_clamped(value, expected):
    assert queries.clamp(value) == expected
    assert queries.clamp("999", high=168) == 168


def test_means_round_ties_away_from_zero(spark):
    df = spark.createDataFrame([(5, 100), (-5, 100), (2105, 2), (0, 0), (995, 10)], "s bigint, n bigint")
    got = [r[0] for r in df.select(numeric.round_half_away(F.col("s"), F.col("n"), 1)).collect()]
    assert [None if v is None else float(v) for v in got] == [0.0, 0.0, 10.5, None, 1.0]


def test_closest_timestamp_needs_enough_coded_districts(star):
    hit = queries.closest_timestamp(star, as_of=AS_OF).first()
    assert (hit.timestamp, hit.locations) == (datetime(2024, 1, 15, 10), 12)
    tie = queries.closest_timestamp(star, as_of=AS_OF + timedelta(minutes=30)).first()
    assert tie.timestamp == datetime(2024, 1, 15, 10)
    far = queries.closest_timestamp(star, as_of=AS_OF + timedelta(days=5000)).first()
    assert far.timestamp == datetime(2024, 1, 16, 1)
    assert queries.closest_timestamp(star, as_of=AS_OF, min_locations=13).count() == 0
    assert queries.current(star, as_of=AS_OF, min_locations=13).count() == 0


def test_current_keeps_other_districts_and_map_does_not(star):
    assert queries.current(star, as_of=AS_OF).count() == 13
    mapped = queries.weather_map(star, as_of=AS_OF).collect()
    assert len(mapped) == 12 and {r.kecamatan for r in mapped} == {"Medan Kota", "Medan Sunggal", "Medan Helvetia"}
    assert queries.current(star, as_of=AS_OF, district="Medan Kota").count() == 1


def test_forecast_limits_are_global(star):
    assert queries.forecast(star, limit=5).select("district").distinct().count() == 1
    newest = queries.forecast(star, kecamatan="12.71.01", limit=4).collect()
    assert {r.observed_at for r in newest} == {datetime(2024, 1, 16, 1)}
    one = queries.forecast(star, adm4="12.71.01.1001", limit=2).collect()
    assert [float(r.temperature) for r in one] == [25.0, 24.0]
    nested = queries.forecast_nested(queries.forecast(star, kecamatan="12.71.01", limit=6)).collect()
    assert sum(len(r.observations) for r in nested) == 6
    assert queries.forecast(star, adm4="nowhere").count() == 0


def test_long_key_lists_become_a_join(star, monkeypatch):
    short = queries.trend(star, kecamatan="12.71.01", limit=3).collect()
    monkeypatch.setattr(queries, "MAX_LITERAL_KEYS", 1)
    assert queries.trend(star, kecamatan="12.71.01", limit=3).collect() == short


def test_trend_windows_see_rows_beyond_the_limit(star):
    got = queries.trend(star, adm4="12.71.01.1001", limit=1).first()
    assert (float(got.temp_ma), float(got.temp_delta), got.rn) == (24.0, 1.0, 1)
    nested = queries.trend_nested(queries.trend(star, limit=2)).collect()
    assert {len(r.trend) for r in nested} == {2} and len(nested) == 13
    assert nested[0].trend[0].observed_at > nested[0].trend[1].observed_at


@pytest.mark.parametrize("slice_rows", [2, 1_000_000])
def test_trend_view_for_short_and_cut_time_lines(star, slice_rows):
    got = views.trend(star, slice_rows=slice_rows).where("district = '12.71.01.1001'").collect()
    assert [float(r.temp_ma_3h) for r in got] == [20.0, 20.5, 21.0, 22.0, 23.0, 24.0]
    assert [r.hour for r in got] == [10, 13, 16, 19, 22, 1]


def test_other_views(star):
    assert views.prediction(star).count() == 39
    stats = {r.district: r for r in views.analytics(star).collect()}
    assert float(stats["12.71.01.1001"].avg_temperature) == 22.5
    assert stats["12.71.02.1005"].avg_temperature is None and stats["12.71.02.1005"].total_observations == 6
    late = datetime(2024, 1, 16, 20, tzinfo=UTC)
    assert sum(r.data_points for r in views.heatmap(star, as_of=late).collect()) == 13 * 2
    assert sum(r.data_points for r in queries.heatmap(star, as_of=late, hours=25).collect()) == 13 * 3
    scored = views.anomaly(star).collect()
    assert len(scored) == 78 and not any(r.is_anomaly for r in scored)
    assert scored[0].z_score == 1.34 and scored[-1].z_score is None


def test_pages(star):
    snapshot = queries.current(star, as_of=AS_OF)
    hottest = pages.hottest_per_parent(snapshot).collect()
    assert [(r.kecamatan, r.district) for r in hottest] == [
        ("Medan Ko", "Medan Kota"), ("Medan Helvetia", "12.71.03.1012"),
        ("Medan Sunggal", "12.71.02.1011"), ("Medan Kota", "12.71.01.1010")]
    assert pages.hottest_overall(snapshot).first().district == "Medan Kota"
    days = pages.group_by_local_day(queries.forecast(star, adm4="12.71.01.1001")).collect()
    assert [len(r.observations) for r in days] == [3, 3]
    names = snapshot.sparkSession.createDataFrame([("Satu", "12.71.01.1001"), ("X", "nowhere")], "name string, adm4 string")
    assert [r.name for r in pages.weather_by_name(snapshot, names).collect()] == ["Satu"]


def test_locations_fall_back_to_codes(star):
    names = star.fact.sparkSession.createDataFrame([("12.71.01.1001", "Pasar")], "adm4 string, desa string")
    got = queries.locations(star.dim_location, names).collect()
    assert [r.kecamatan for r in got] == ["Medan Helvetia", "Medan Kota", "Medan Sunggal"]
    assert got[1].kelurahan[0].name == "Pasar" and got[1].kelurahan[1].name == "12.71.01.1004"


def test_recent_queries_prune_days(star):
    plan = views.heatmap(star, as_of=AS_OF)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
