"""Data quality and warehouse integrity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymart.config import REQUIRED_FACT_COLUMNS


class QualityError(ValueError):
    """The data must not be loaded."""


#: Kinds of issues; the first two block a load.
NO_ROWS, NO_COLUMN, NULLS = "no rows", "no column", "nulls"


@dataclass(frozen=True)
class Issue:
    """Something the check found: of the frame, or of one required column."""

    kind: str
    column: str | None = None
    nulls: int = 0
    rows: int = 0

    @property
    def blocks(self) -> bool:
        return self.kind != NULLS

    def __str__(self) -> str:
        where = "" if self.column is None else f" in {self.column}"
        share = f": {self.nulls} of {self.rows} rows" if self.kind == NULLS else ""
        return self.kind + where + share


def _is_null(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] = REQUIRED_FACT_COLUMNS) -> DataFrame:
    """Q1: rows, nulls and null percentage per required column, in one pass.

    A missing column has null counts.
    """
    present = [name for name in columns if name in df.columns]

    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_is_null(df, name)).alias(name) for name in present],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            (F.col(name) if name in present else F.lit(None).cast("bigint")).alias("nulls"),
        )
        for name in columns
    ]
    return counts.select("rows", F.inline(F.array(*rows))).select(
        "column",
        "rows",
        "nulls",
        F.round(F.col("nulls") / F.nullif("rows", F.lit(0)) * 100, 1).alias("pct"),
    )


def quality_check(df: DataFrame, columns: Sequence[str] = REQUIRED_FACT_COLUMNS) -> list[Issue]:
    """Q1 as a list; it is empty if all is well."""
    profile = null_profile(df, columns).collect()  # one row per required column
    return issues_of(profile[0]["rows"], {r["column"]: r["nulls"] for r in profile})


def issues_of(rows: int, nulls: dict[str, int | None]) -> list[Issue]:
    """Issues by null counts per column; None stands for a column that isn't there."""
    if rows == 0:
        return [Issue(NO_ROWS)]
    absent = [Issue(NO_COLUMN, name) for name, count in nulls.items() if count is None]
    return absent + [Issue(NULLS, name, count, rows) for name, count in nulls.items() if count]


class QualityWatch:
    """Q1 gathered while another action computes the frame, instead of by a pass of its own.

    Counts may be too high if an executor was lost on the way; no decision but "empty" uses them.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str] = REQUIRED_FACT_COLUMNS):
        self._columns = columns
        self._present = [name for name in columns if name in df.columns]
        self._observation = Observation()
        counts = [F.count_if(_is_null(df, name)).alias(name) for name in self._present]
        self.frame = df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def missing(self) -> list[str]:
        return [name for name in self._columns if name not in self._present]

    def issues(self) -> list[Issue]:
        """Call after the action."""
        seen = self._observation.get
        return issues_of(seen.get("rows", 0), {name: seen.get(name) for name in self._columns})


def blocks_load(issues: Sequence[Issue]) -> bool:
    """Q2: no rows or a column that isn't there block a load, nulls only warn."""
    return any(issue.blocks for issue in issues)


def refusal(issues: Sequence[Issue]) -> QualityError:
    return QualityError("not loadable: " + "; ".join(map(str, issues)))


def quality_gate(df: DataFrame) -> list[Issue]:
    """Q2: the issues, or ``QualityError``."""
    issues = quality_check(df)
    if blocks_load(issues):
        raise refusal(issues)
    return issues


def fact_key_check(
    fact: DataFrame, dim_time: DataFrame, dim_location: DataFrame, dim_weather: DataFrame
) -> DataFrame:
    """Number of violations per rule; hash collisions show as duplicate dimension keys."""

    def counted(rule: str, violations: DataFrame) -> DataFrame:
        return violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(rule).alias("rule"), "violations"
        )

    def repeated(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

    checks = [counted("unique fact (time_id, location_id)", repeated(fact, "time_id", "location_id"))]
    for dim, key in (
        (dim_time, "time_id"), (dim_location, "location_id"), (dim_weather, "weather_id"),
    ):
        # Distinct keys first: the anti join then meets each key once, however hot it is.
        used = fact.select(key).distinct()
        checks.append(counted(f"fact {key} exists", used.join(dim, key, "left_anti")))
        checks.append(counted(f"unique {key}", repeated(dim, key)))
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
