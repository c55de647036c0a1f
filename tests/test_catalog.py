"""Every registered query against its check SQL on the smallest tables."""

from datetime import datetime

import pytest
from compare import difference, duck

import __spark_entry__ as contract
from skymart.plans import catalog

SF = "/root/testdata/sf0.001"
SLOW = ("l7_load", "st1_ingest_stream")  # their behavior has tests of its own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SLOW])
def test_query(spark, con, name):
    result = contract.queries()[name](spark, SF).toPandas()
    assert difference(result, con.execute(contract.oracle_sql()[name]).df()) is None


def test_contract(spark):
    assert contract.entry(spark).columns[:2] == ["district", "date"]
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_loads_read_cleaned_rows_that_were_written_once(spark, tmp_path):
    made = [(i, datetime(2024, 1, 15, 10, i % 3), 7, "click", 1.5 + i, '{"k": 20}') for i in range(6)]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(made, kinds).write.parquet(f"{tmp_path}/events.parquet")
    rows = catalog.slotted(spark, str(tmp_path))
    assert [r.raw_id for r in rows.collect()] == [0]  # one slot of one place
    plan = catalog.slotted(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "get_json_object" not in plan
