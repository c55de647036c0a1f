import json
from datetime import datetime, timedelta

import pandas as pd
import pytest

from skymart.operators import load
from skymart.plans import transform
from skymart.plans.catalog import _facts
from skymart.sources import raw
from skymart.sources.fixtures import KEYS
from skymart.sources.warehouse import Warehouse
from skymart.streaming import ingest

T0 = datetime(2024, 1, 1)
RAW = "raw_id long, source string, raw_json string, observed_at timestamp"


def doc(i, location, hours, temp):
    body = json.dumps({"location": location, "data": {"temperature": temp, "humidity": 50, "wind_speed": 1, "rainfall": 0}})
    return (i, "Mock", body, T0 + timedelta(hours=hours))


BATCHES = [
    [doc(1, "A", 0, 20.25), doc(2, "A", 3, 21.5), doc(3, "B", 3, 30.0), doc(4, "A", 3, 99.0)],
    [doc(5, "A", 1, 10.0), doc(6, "A", 0, 55.0), doc(7, "A", 6, 22.0), doc(8, "B", 6, 31.0)],
    [doc(9, "B", 2, 12.5), doc(9, "A ", 3, 41.0)],
    [doc(10, "B", 9, 33.0), doc(11, "A", 9, 18.0), doc(12, "A", 1, 11.0)],
]


def contents(warehouse):
    return _facts(warehouse).toPandas().sort_values(["observed_at", "district"], ignore_index=True)


@pytest.fixture
def expected(spark, tmp_path):
    """Full recomputation before every load, as a batch run does it."""
    target, seen = Warehouse(spark, str(tmp_path / "batch")), []
    for part in BATCHES:
        seen += part
        df = spark.createDataFrame(seen, RAW)
        load.load(transform.loadable(transform.cleaned_observations(df, KEYS)), target)
    return contents(target)


def test_running_totals_equal_full_recomputation(spark, tmp_path, expected):
    target = Warehouse(spark, str(tmp_path / "wh"))
    late = [ingest.ingest_batch(spark.createDataFrame(part, RAW), target, KEYS).late for part in BATCHES]
    assert late == [0, 2, 2, 1]
    pd.testing.assert_frame_equal(contents(target), expected)


def test_replaying_a_batch_changes_nothing(spark, tmp_path, expected):
    target = Warehouse(spark, str(tmp_path / "wh"))
    for part in BATCHES:
        ingest.ingest_batch(spark.createDataFrame(part, RAW), target, KEYS)
        version = target.snapshot().version
        again = ingest.ingest_batch(spark.createDataFrame(part, RAW), target, KEYS)
        assert again.load.inserted == 0 and target.snapshot().version == version
    pd.testing.assert_frame_equal(contents(target), expected)


def test_stream_of_files_equals_batch(spark, tmp_path, expected):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "offsets")
    target = Warehouse(spark, str(tmp_path / "wh"))
    for part in BATCHES:
        raw.append_raw(spark.createDataFrame(part, RAW), source)
        ingest.ingest_stream(spark, source, target, KEYS, checkpoint=checkpoint).awaitTermination()
    ingest.ingest_stream(spark, source, target, KEYS, checkpoint=checkpoint).awaitTermination()
    pd.testing.assert_frame_equal(contents(target), expected)


def test_slots(spark):
    times = [(T0 + timedelta(hours=h),) for h in (0, 2, 3, 23)]
    df = spark.createDataFrame(times, "observed_at timestamp")
    got = [r.slot.hour for r in df.select(ingest.slot_3h(df.observed_at).alias("slot")).collect()]
    assert got == [0, 0, 3, 21]
    assert {r.slot.hour: r.observations for r in ingest.slot_counts(df).collect()} == {0: 2, 3: 1, 21: 1}
