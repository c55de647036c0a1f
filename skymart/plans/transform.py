"""The batch transform."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skymart.config import DEFAULTS, DocumentKeys, Settings
from skymart.operators.clean import clean, exact_measures, standardize
from skymart.operators.enrich import add_features, classify, enrich
from skymart.operators.parse import parse_raw_json
from skymart.session import materialize

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunCounters:
    """Filled once the transformed frame has been computed by an action."""

    observation: Observation

    def get(self) -> dict:
        return self.observation.get


def observed(df: DataFrame) -> tuple[DataFrame, RunCounters]:
    """Count rows and anomalies while the frame is computed."""
    counters = Observation("transform")
    watched = df.observe(
        counters,
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_anomaly").alias("anomalies"),
    )
    return watched, RunCounters(counters)


def cleaned_observations(
    raw: DataFrame, keys: DocumentKeys, *, include_openweather: bool = False, given: str | None = None
) -> DataFrame:
    """P2 and C7. ``given`` names a further column: the location as the source wrote it."""
    cleaned = parse_raw_json(raw, keys, include_openweather=include_openweather).transform(clean)
    if given is not None:
        cleaned = cleaned.withColumn(given, F.col("location"))
    return cleaned.transform(standardize)


def run_transform(
    raw: DataFrame,
    keys: DocumentKeys,
    settings: Settings = DEFAULTS,
    *,
    stage: str | None = None,
    include_openweather: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Raw documents to enriched observations; an empty input gives an empty, typed output.

    With a ``stage`` folder the cleaned rows are written there once, so that the statistics and
    the rows themselves do not parse the documents twice. Large runs should set it. ``exact``
    makes the measures decimals, so that averages do not depend on the order of the rows.
    """
    rows = cleaned_observations(raw, keys, include_openweather=include_openweather)
    if exact:
        rows = exact_measures(rows)
    return enrich(rows if stage is None else materialize(rows, stage), settings)


def loadable(cleaned: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The part of the transform the warehouse stores: features and classes, no row windows."""
    return classify(add_features(cleaned), settings)
