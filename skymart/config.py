"""Thresholds, value ranges and constants that fix the meaning of results."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

@dataclass(frozen=True)
class DocumentKeys:
    """Names that a provider's documents give to the place and to the list of entries."""

    place: str
    entries: str


# Measure and text columns of a normalized observation.
MEASURES = (
    "temperature",
    "humidity",
    "pressure",
    "wind_speed",
    "rainfall",
    "uv_index",
    "visibility",
    "cloud_coverage",
)
TEXT_COLUMNS = ("location", "source", "wind_direction", "condition_code", "condition_desc")

# Inclusive valid range per measure, None = unbounded.
VALID_RANGES = {
    "humidity": (0, 100),
    "cloud_coverage": (0, 100),
    "wind_speed": (0, None),
    "rainfall": (0, None),
    "temperature": (-90, 60),
    "pressure": (300, 1100),
    "uv_index": (0, 16),
    "visibility": (0, None),
}

# Columns checked before a load.
REQUIRED_FACT_COLUMNS = (
    "observed_at",
    "location",
    "temperature",
    "humidity",
    "wind_speed",
    "rainfall",
    "source",
)

#: Sub-district code, e.g. 12.71.01.1001. A parameter of the queries; this is its default.
CODE_PATTERN = r"^12\.71\.\d{2}\.\d{4}$"
LOCAL_TIME_ZONE = "Asia/Jakarta"
CITY = "Medan"
REGION_LEVEL = "kecamatan"
UNKNOWN_CLASS = "Tidak Diketahui"


@dataclass(frozen=True)
class Settings:
    """Tunable parameters. Field names in upper case are the environment variables."""

    temp_sangat_panas: float = 38.0
    temp_panas: float = 33.0
    temp_normal: float = 20.0
    humidity_sangat_lembap: float = 85.0
    humidity_lembap: float = 70.0
    humidity_normal: float = 40.0
    wind_kencang: float = 40.0
    wind_sedang: float = 20.0
    wind_ringan: float = 5.0
    rain_lebat: float = 20.0
    rain_sedang: float = 7.5
    rain_ringan: float = 0.5
    moving_avg_window: int = 3
    anomaly_zscore_threshold: float = 2.5

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "Settings":
        env = os.environ if env is None else env
        given = {}
        for field in fields(cls):
            text = env.get(field.name.upper())
            if text is not None:
                given[field.name] = int(text) if field.name == "moving_avg_window" else float(text)
        return cls(**given)


DEFAULTS = Settings()
