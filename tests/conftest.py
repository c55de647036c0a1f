from __future__ import annotations

import os
import sys
from datetime import UTC, datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from skymart.session import local_session  # noqa: E402

START = datetime(2024, 1, 15, 10, tzinfo=UTC)
SCHEMA = (
    "raw_id bigint, observed_at timestamp, location string, source string, temperature double, "
    "humidity double, pressure double, wind_direction string, wind_speed double, rainfall double, "
    "uv_index double, visibility double, cloud_coverage double, condition_code string, "
    "condition_desc string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session("4", "skymart-tests", **shared)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


def rows(n=5, location="Medan Kota", temp=28.0, humidity=70.0, first_id=0, start=START):
    """Observation rows three hours apart, measures rising row by row."""
    return [
        dict(
            raw_id=first_id + i,
            observed_at=start + timedelta(hours=3 * i),
            location=location,
            source="Mock",
            temperature=temp + i,
            humidity=humidity - 2 * i,
            pressure=1010.0 + i,
            wind_direction=("NE", "SW", "E", "N", "W")[i % 5],
            wind_speed=5.0 + 3 * i,
            rainfall=(0.0, 0.0, 2.5, 10.0, 25.0)[i % 5],
            uv_index=5.0 + i,
            visibility=10.0 - i,
            cloud_coverage=40.0 + 10 * i,
            condition_code=("01", "02", "03", "60", "95")[i % 5],
            condition_desc=("Cerah", "Cerah Berawan", "Berawan", "Hujan Sedang", "Hujan Lebat")[i % 5],
        )
        for i in range(n)
    ]


@pytest.fixture
def frame(spark):
    def make(data):
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(r[c] for c in names) for r in data], SCHEMA)

    return make


def column(df, name, order="raw_id"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]
