from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    """documents with an extra column of a clashing name; rows are (doc_id, text)."""

    def make(rows):
        data = [(i, t, "x", 1) for i, t in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, ids string, kept int")

    return make
