import numpy as np
import pandas as pd
import pytest
from conftest import column, rows
from pyspark.sql import functions as F

from skymart.config import Settings
from skymart.functions import classes, timeline
from skymart.operators import enrich
from skymart.plans.transform import observed


def test_features_per_location(frame):
    data = rows(3, "A", temp=20.0) + rows(3, "B", temp=30.0, first_id=10)
    result = enrich.add_features(frame(data))
    assert column(result, "temp_avg") == [21.0] * 3 + [31.0] * 3
    assert column(result, "temp_max") == [22.0] * 3 + [32.0] * 3
    assert column(result, "temp_min") == [20.0] * 3 + [30.0] * 3


def test_features_overwrite_and_skip_null_locations(frame):
    data = rows(3)
    data[2]["location"] = None
    result = enrich.add_features(frame(data).withColumn("temp_avg", F.lit(-1.0)))
    assert column(result, "temp_avg") == [28.5, 28.5, None]


@pytest.mark.parametrize(
    "name,value,expected",
    [
        ("temp", 38.0, "Sangat Panas"), ("temp", 37.9, "Panas"), ("temp", 33.0, "Panas"),
        ("temp", 32.9, "Normal"), ("temp", 20.0, "Normal"), ("temp", 19.9, "Dingin"),
        ("humidity", 85.0, "Sangat Lembap"), ("humidity", 84.9, "Lembap"),
        ("humidity", 70.0, "Lembap"), ("humidity", 40.0, "Normal"), ("humidity", 39.9, "Kering"),
        ("wind", 40.0, "Kencang"), ("wind", 20.0, "Sedang"), ("wind", 5.0, "Ringan"),
        ("wind", 4.9, "Tenang"), ("rain", 20.0, "Hujan Lebat"), ("rain", 7.5, "Hujan Sedang"),
        ("rain", 0.5, "Hujan Ringan"), ("rain", 0.4, "Tidak Hujan"),
        ("temp", None, "Tidak Diketahui"), ("temp", float("nan"), "Tidak Diketahui"),
    ],
)
def test_class_boundaries(spark, name, value, expected):
    rule = {
        "temp": classes.temperature_class, "humidity": classes.humidity_class,
        "wind": classes.wind_class, "rain": classes.rainfall_class,
    }[name]
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(rule(F.col("v"))).first()[0] == expected


def test_thresholds_come_from_the_environment(frame):
    settings = Settings.from_env({"TEMP_PANAS": "25", "MOVING_AVG_WINDOW": "5"})
    assert settings.moving_avg_window == 5
    assert set(column(enrich.classify(frame(rows(2)), settings), "temp_class")) == {"Panas"}


def test_compass_icons_and_bands(spark):
    df = spark.createDataFrame([(0.0,), (45.0,), (90.0,), (180.0,), (270.0,), (359.0,), (None,)], "d double")
    got = [r[0] for r in df.select(classes.deg_to_compass(F.col("d"))).collect()]
    assert got == ["N", "NE", "E", "S", "W", "N", None]
    text = spark.createDataFrame([("Kabut",), ("?",), (None,)], "t string")
    assert [r[0] for r in text.select(classes.condition_icon(F.col("t"))).collect()] == [45, 3, 3]


def test_moving_average_delta_and_prediction(frame):
    df = frame(rows(4, temp=20.0))
    trends = enrich.compute_trends(df)
    assert column(trends, "temp_ma") == [20.0, 20.5, 21.0, 22.0]
    assert column(trends, "temp_delta") == [None, 1.0, 1.0, 1.0]
    assert column(trends, "humidity_delta") == [None, -2.0, -2.0, -2.0]
    assert column(enrich.predict(df), "predicted_temp") == [None, 20.0, 20.5, 21.0]
    assert column(enrich.moving_average(df, 1), "temp_ma") == [20.0, 21.0, 22.0, 23.0]
    assert column(enrich.moving_average(df, 0), "temp_ma") == column(trends, "temp_ma")


def test_nulls_are_skipped_by_means_and_spread_by_deltas(frame):
    data = rows(4, temp=20.0)
    data[1]["temperature"] = None
    result = enrich.compute_trends(frame(data))
    assert column(result, "temp_ma") == [20.0, 20.0, 21.0, 22.5]
    assert column(result, "temp_delta") == [None, None, None, 1.0]


def test_spike_is_an_anomaly(frame):
    data = rows(20, temp=28.0)
    for row in data:
        row["temperature"] = 28.0
    data[2]["temperature"] = 100.0
    assert [i for i, flag in enumerate(column(enrich.detect_anomalies(frame(data)), "is_anomaly")) if flag] == [2]


def test_no_anomaly_in_flat_linear_or_single_data(frame):
    flat = rows(5)
    for row in flat:
        row["temperature"] = 3.0
    for data in (flat, rows(10), rows(1), [dict(rows(1)[0], location=None)]):
        assert set(column(enrich.detect_anomalies(frame(data)), "is_anomaly")) == {False}


def _many(seed=5, n=400):
    """One location with most of the rows, nulls in keys and values, irregular times."""
    rng = np.random.default_rng(seed)
    base = rows(1)[0]
    data = []
    for i in range(n):
        where = rng.choice(["hot", "hot", "hot", "cold", "tiny", None], p=[0.3, 0.3, 0.2, 0.1, 0.05, 0.05])
        shift = float(rng.exponential(1.0) ** 3 * 1000)
        data.append(
            dict(
                base, raw_id=i, location=where,
                observed_at=base["observed_at"] + pd.Timedelta(seconds=round(shift, 3)).to_pytimedelta(),
                temperature=None if rng.random() < 0.1 else float(rng.integers(0, 400)) / 8,
                humidity=float(rng.integers(0, 100)),
            )
        )
    return data


@pytest.mark.parametrize("slice_rows", [3, 25, 1_000_000])
@pytest.mark.parametrize("window", [1, 3, 7])
def test_trailing_windows_equal_pandas_however_keys_are_cut(frame, slice_rows, window):
    data = _many()
    got = (
        frame(data)
        .transform(enrich.compute_trends, window, slice_rows=slice_rows)
        .transform(enrich.predict, window, slice_rows=slice_rows)
        .select("raw_id", "temp_ma", "temp_delta", "predicted_temp")
        .toPandas().set_index("raw_id").sort_index()
    )
    pdf = pd.DataFrame(data).sort_values(["observed_at", "raw_id"])
    pdf["temperature"] = pdf["temperature"].astype(float)
    by = pdf.groupby("location")["temperature"]
    ma = by.transform(lambda s: s.rolling(window, min_periods=1).mean())
    want = pd.DataFrame(
        {
            "raw_id": pdf["raw_id"], "temp_ma": ma, "temp_delta": by.diff(),
            "predicted_temp": by.transform(lambda s: s.rolling(window, min_periods=1).mean().shift(1)),
        }
    ).set_index("raw_id").sort_index()
    want.loc[pdf.set_index("raw_id")["location"].isna()] = np.nan
    pd.testing.assert_frame_equal(got.astype(float), want.astype(float), check_names=False, atol=1e-9)


def _burst(spark, n=100_000):
    """One old row, then ``n`` rows within a tenth of a second."""
    late = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id"))
    old = F.lit("1999-01-01 00:00:00").cast("timestamp")
    return spark.range(n + 1).select(
        F.col("id").alias("raw_id"),
        F.when(F.col("id") == 0, old).otherwise(late).alias("observed_at"),
        F.lit("hot").alias("location"),
        (F.col("id") % 400 / 8).alias("temperature"),
        (F.col("id") % 90).cast("double").alias("humidity"),
    )


def test_a_burst_is_cut_into_even_slices(spark):
    target = 4_000
    df = _burst(spark).withColumn(timeline.TIME, F.unix_micros("observed_at"))
    cut, _ = timeline.sliced(df, key="location", sort_keys=[timeline.TIME, "raw_id"], slice_rows=target)
    sizes = [r["count"] for r in cut.groupBy(timeline.SLICE).count().collect()]
    assert sum(sizes) == 100_001 and max(sizes) <= 2 * target and len(sizes) >= 20


def test_equal_times_are_cut_by_the_tie(spark):
    same = _burst(spark, 20_000).withColumn("observed_at", F.lit("2024-01-01").cast("timestamp"))
    df = same.withColumn(timeline.TIME, F.unix_micros("observed_at"))
    cut, _ = timeline.sliced(df, key="location", sort_keys=[timeline.TIME, "raw_id"], slice_rows=1_000)
    assert max(r["count"] for r in cut.groupBy(timeline.SLICE).count().collect()) <= 2_000
    got = enrich.delta(same, slice_rows=1_000).agg(F.count("temp_delta"), F.sum(F.abs("temp_delta"))).first()
    want = enrich.delta(same).agg(F.count("temp_delta"), F.sum(F.abs("temp_delta"))).first()
    assert got == want and got[0] == 20_000


def test_cuts_are_bounded_without_leaving_out_keys(spark, monkeypatch):
    monkeypatch.setattr(timeline, "MAX_CUTS", 10)
    df = _burst(spark, 9_000).withColumn("location", F.concat(F.lit("k"), F.col("raw_id") % 3))
    df = df.withColumn(timeline.TIME, F.unix_micros("observed_at"))
    cut, cuts = timeline.sliced(df, key="location", sort_keys=[timeline.TIME, "raw_id"], slice_rows=100)
    sizes = cut.groupBy("location", timeline.SLICE).count().collect()
    assert cuts.selectExpr(f"sum(size({timeline.CUTS}))").first()[0] <= 10
    assert len({r.location for r in sizes}) == 3 and max(r["count"] for r in sizes) < 1_500


def test_building_a_plan_starts_no_job(spark):
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        _burst(spark).transform(enrich.compute_trends).transform(enrich.predict)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_enrich_equals_the_single_steps(frame):
    df = frame(_many())
    together = enrich.enrich(df, slice_rows=20)
    apart = (
        df.transform(enrich.add_features).transform(enrich.classify)
        .transform(enrich.compute_trends).transform(enrich.detect_anomalies).transform(enrich.predict)
    )
    names = sorted(apart.columns)
    assert sorted(together.columns) == names
    left, right = (d.select(names).toPandas().sort_values("raw_id", ignore_index=True) for d in (together, apart))
    pd.testing.assert_frame_equal(left, right)


def test_empty_frames_get_all_columns(frame):
    result = enrich.enrich(frame([]))
    assert result.count() == 0
    assert {"temp_avg", "temp_class", "temp_ma", "temp_delta", "is_anomaly", "predicted_temp"} <= set(result.columns)


def test_counters_are_observed(frame):
    watched, counters = observed(enrich.enrich(frame(rows(5))))
    watched.collect()
    assert counters.get() == {"rows": 5, "anomalies": 0}
