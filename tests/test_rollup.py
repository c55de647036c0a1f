"""Aggregates kept by the load, and the queries that read them instead of the facts."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import SCHEMA, rows
from pyspark.sql import functions as F

from skymart.operators import load, rollup
from skymart.plans import queries, transform, views
from skymart.schemas import TABLES
from skymart.sources.warehouse import KEPT_MANIFESTS, Warehouse, partition_value

START = datetime(2024, 1, 15, 10)


def batch(spark, data):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return transform.loadable(spark.createDataFrame([tuple(r[c] for c in names) for r in data], SCHEMA))


def days_of(first, n, where, temp=20.0, step=24):
    start = START + timedelta(days=first)
    return [
        dict(r, observed_at=start + timedelta(hours=step * i))
        for i, r in enumerate(rows(n, where, temp=temp, humidity=90.0))
    ]


def contents(df):
    names = sorted(df.columns)
    return sorted(map(str, df.select(names).collect()))


def assert_kept(target):
    """The published aggregates are those of all facts."""
    star = views.Star.of(target)
    days = rollup.by_day(star.fact)
    summed = star.days.groupBy("location_id", "date").agg(F.sum("rows").alias("rows"), F.max("last").alias("last"))
    assert contents(summed) == contents(days.select("location_id", "date", "rows", "last"))
    assert contents(star.totals.drop("bucket")) == contents(rollup.by_location(days))
    assert contents(star.covered) == contents(rollup.coverage(star.fact, star.dim_location))
    whole = replace(star, days=None, totals=None, covered=None)
    assert contents(views.analytics(star)) == contents(views.analytics(whole))
    assert contents(views.overview(star)) == contents(views.overview(whole))
    return star


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A load, a second one behind it, the watermark moved back, and a reload of changed rows."""
    target = Warehouse(spark, str(tmp_path_factory.mktemp("rollup") / "wh"))
    codes = [f"12.71.01.{1000 + n}" for n in range(3)]
    first = [r for n, c in enumerate([*codes, "Medan Kota"]) for r in days_of(0, 4, c, temp=20.0 + n)]
    load.load(batch(spark, first), target)
    load.load(batch(spark, days_of(4, 3, codes[0], temp=45.0)), target)
    assert_kept(target)
    target.set_watermark(START + timedelta(days=1))
    changed = days_of(2, 2, codes[1], temp=-5.0) + days_of(5, 1, codes[2], temp=33.0)
    load.load(batch(spark, changed), target)
    return target


def test_aggregates_after_load_rewind_and_reload(loaded):
    star = assert_kept(loaded)
    low = {r.district: float(r.min_temperature) for r in views.analytics(star).collect()}
    assert low["12.71.01.1001"] == -5.0


def test_extremes_that_a_merge_takes_away(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path / "wh"))
    load.load(batch(spark, days_of(0, 2, "A", temp=48.0) + days_of(0, 2, "B")), target)
    target.set_watermark(START - timedelta(days=1))
    load.load(batch(spark, days_of(0, 2, "A", temp=1.0)), target)
    star = assert_kept(target)
    assert {r.district: float(r.max_temperature) for r in views.analytics(star).collect()} == {"A": 2.0, "B": 21.0}



def test_totals_answer_without_facts(loaded):
    star = views.Star.of(loaded)
    no_facts = replace(star, fact=star.fact.where(F.raise_error(F.lit("facts were read")).isNull()))
    assert views.analytics(no_facts).count() == 4
    hit = queries.closest_timestamp(no_facts, as_of=START, min_locations=3).first()
    assert (hit.timestamp, hit.locations) == (START, 3)
    whole = replace(star, covered=None)
    for pattern, least in ((r"^12\.71", 1), (".*", 4)):
        one = queries.closest_timestamp(star, as_of=START, min_locations=least, pattern=pattern).collect()
        assert one == queries.closest_timestamp(whole, as_of=START, min_locations=least, pattern=pattern).collect()


def test_newest_rows_read_needed_days_only(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path / "wh"))
    silent, busy = days_of(-400, 1, "silent", temp=7.0), days_of(-30, 31, "busy", temp=10.0)
    load.load(batch(spark, silent + busy + days_of(-2, 3, "late", temp=30.0)), target)
    star = views.Star.of(target)
    day = lambda n: (START + timedelta(days=n)).date()
    days = {("silent", day(-400)), ("busy", day(0)), ("busy", day(-1)), ("late", day(0)), ("late", day(-1))}
    wanted = {day(n) for n in (-400, -1, 0)}
    assert set(views.newest_days(star, 2)) == wanted
    assert set(views.newest_days(star.at(star.dim_location.where("district = 'busy'"), None), 1)) == {day(0)}
    # The search may start anywhere.
    for start in (START - timedelta(days=700), START + timedelta(days=700), None):
        assert set(views.newest_days(replace(star, newest=start), 2)) == wanted
    # Facts of any other day must not be touched.
    trap = F.when(F.col("date").isin(list(wanted)), F.col("time_id")).otherwise(
        F.raise_error(F.concat(F.lit("read "), F.col("date").cast("string"))).cast("bigint")
    )
    guarded = replace(star, fact=star.fact.withColumn("time_id", trap))
    got = views.prediction(guarded, rows=2).collect()
    assert {(r.district, r.last_observed.date()) for r in got} == days
    assert {r.district for r in views.overview(guarded).collect()} == {"silent", "busy", "late"}


def test_newest_rows_equal_ranking_all_facts(loaded):
    star = views.Star.of(loaded)
    whole = replace(star, days=None, totals=None)
    for n in (1, 2, 3, 50):
        assert contents(views.prediction(star, rows=n)) == contents(views.prediction(whole, rows=n))
    for how in ({}, {"adm4": "12.71.01.1000"}, {"kecamatan": "12.71.01"}, {"adm4": "nowhere"}):
        assert contents(queries.trend(star, limit=2, **how)) == contents(queries.trend(whole, limit=2, **how))
        assert contents(queries.forecast(star, limit=6, **how)) == contents(queries.forecast(whole, limit=6, **how))


def test_forecast_reads_the_first_districts_only(loaded):
    star = views.Star.of(loaded)
    first = star.dim_location.where("district = '12.71.01.1000'").first().location_id
    trap = F.when(F.col("location_id") == first, F.col("time_id")).otherwise(
        F.raise_error(F.lit("another district was read")).cast("bigint")
    )
    guarded = replace(star, fact=star.fact.withColumn("time_id", trap))
    assert queries.forecast(guarded, limit=5).count() == 5


def test_many_small_loads(spark, tmp_path, monkeypatch):
    """Days stay in few directories, and no directory is left that no kept manifest names."""
    monkeypatch.setattr(load, "MAX_DAY_DIRECTORIES", 3)
    target = Warehouse(spark, str(tmp_path / "wh"))
    n, want = load.MAX_DAY_DIRECTORIES + KEPT_MANIFESTS + 1, []
    for i in range(n):
        data = [dict(r, observed_at=START + timedelta(minutes=i)) for r in rows(1, f"L{i % 2}", temp=10.0 + i)]
        load.load(batch(spark, data), target)
        want.append((START + timedelta(minutes=i), 10.0 + i))
    star = assert_kept(target)
    facts = star.fact.select(views.observed_at().alias("t"), "temperature").collect()
    assert sorted((r.t, float(r.temperature)) for r in facts) == want
    current = target.snapshot()
    for table in ("fact_weather", "fact_days", "time_coverage"):
        parts = [partition_value(p) for p in current.tables[table]]
        assert max(map(parts.count, parts), default=0) <= load.MAX_DAY_DIRECTORIES
    named = set()
    for version in range(current.version - KEPT_MANIFESTS + 1, current.version + 1):
        named |= target._directories(version)
    for table in TABLES:
        for made in target._children(f"{target.root}/{table}"):
            path = f"{target.root}/{table}/{made}"
            below = [f"{path}/{c}" for c in target._children(path) if "=" in c]
            assert set(below or [path]) <= named, path


def test_a_small_batch_rewrites_few_buckets(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path / "wh"))
    load.load(batch(spark, [r for n in range(200) for r in days_of(0, 1, f"place {n}")]), target)
    before = set(target.snapshot().tables["location_totals"])
    load.load(batch(spark, days_of(1, 1, "place 7")), target)
    after = set(target.snapshot().tables["location_totals"])
    assert len(after - before) == len(before - after) == 1
    assert_kept(target)
