import math

import pytest
from conftest import column, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from skymart.operators import clean


def test_drops_rows_without_time_or_location(frame):
    data = rows(4)
    data[0]["observed_at"] = None
    data[1]["location"] = None
    assert column(clean.clean(frame(data)), "raw_id") == [2, 3]


def test_keeps_the_first_of_copies(frame):
    data = rows(3) + [dict(rows(1)[0], raw_id=9, temperature=1.0)]
    result = clean.clean(frame(data))
    assert result.count() == 3
    assert column(result, "temperature")[0] == 28.0


def test_same_time_elsewhere_is_no_copy(frame):
    assert clean.clean(frame(rows(2) + rows(2, "B", first_id=5))).count() == 4


@pytest.mark.parametrize(
    "name,bad,edge",
    [
        ("humidity", 150.0, 100.0), ("humidity", -10.0, 0.0), ("temperature", 100.0, 60.0),
        ("temperature", -100.0, -90.0), ("pressure", 200.0, 300.0), ("pressure", 1200.0, 1100.0),
        ("wind_speed", -1.0, 0.0), ("rainfall", -0.1, 0.0), ("uv_index", 17.0, 16.0),
        ("visibility", -1.0, 0.0), ("cloud_coverage", 101.0, 100.0),
    ],
)
def test_out_of_range_becomes_null_and_bounds_stay(frame, name, bad, edge):
    data = rows(3)
    data[0][name], data[1][name], data[2][name] = bad, edge, math.nan
    assert column(clean.clean(frame(data)), name) == [None, edge, None]


def test_row_counts_are_observed(frame):
    before, after = Observation(), Observation()
    clean.clean(frame(rows(3) + rows(1)), rows_in=before, rows_out=after).collect()
    assert (before.get["rows"], after.get["rows"]) == (4, 3)


def test_trims_and_nullifies_text(frame):
    data = rows(5)
    for row, text in zip(data, ["  sw\t", "", "None", "nan", None]):
        row["wind_direction"] = text
    assert column(clean.standardize(frame(data)), "wind_direction") == ["SW", None, None, None, None]


def test_copies_differing_in_blanks_survive_cleaning(frame):
    data = rows(1) + [dict(rows(1)[0], raw_id=1, location=" Medan Kota ")]
    result = frame(data).transform(clean.clean).transform(clean.standardize)
    assert column(result, "location") == ["Medan Kota", "Medan Kota"]


def test_text_times_are_parsed_or_null(frame):
    df = frame(rows(2)).withColumn(
        "observed_at", F.when(F.col("raw_id") == 0, "2024-01-15T10:00:00Z").otherwise("nonsense")
    )
    first, second = column(clean.standardize(df), "observed_at")
    assert first.isoformat() == "2024-01-15T10:00:00" and second is None


def test_empty_frames_keep_their_columns(frame):
    empty = frame([])
    assert clean.standardize(clean.clean(empty)).columns == empty.columns
    assert clean.clean(empty).count() == 0
