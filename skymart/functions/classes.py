"""Value-to-label expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from skymart.config import DEFAULTS, LOCAL_TIME_ZONE, UNKNOWN_CLASS, Settings


def banded(value: Column, bands: Sequence[tuple[float, object]], below, missing) -> Column:
    """Label of the first band whose inclusive lower bound the value reaches."""
    label = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(missing))
    for bound, name in bands:
        label = label.when(value >= F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(below))


def temperature_class(value: Column, s: Settings = DEFAULTS) -> Column:
    """K1"""
    bands = [
        (s.temp_sangat_panas, "Sangat Panas"), (s.temp_panas, "Panas"), (s.temp_normal, "Normal"),
    ]
    return banded(value, bands, "Dingin", UNKNOWN_CLASS)


def humidity_class(value: Column, s: Settings = DEFAULTS) -> Column:
    """K2"""
    bands = [
        (s.humidity_sangat_lembap, "Sangat Lembap"),
        (s.humidity_lembap, "Lembap"),
        (s.humidity_normal, "Normal"),
    ]
    return banded(value, bands, "Kering", UNKNOWN_CLASS)


def wind_class(value: Column, s: Settings = DEFAULTS) -> Column:
    """K3"""
    bands = [(s.wind_kencang, "Kencang"), (s.wind_sedang, "Sedang"), (s.wind_ringan, "Ringan")]
    return banded(value, bands, "Tenang", UNKNOWN_CLASS)


def rainfall_class(value: Column, s: Settings = DEFAULTS) -> Column:
    """K4"""
    bands = [
        (s.rain_lebat, "Hujan Lebat"),
        (s.rain_sedang, "Hujan Sedang"),
        (s.rain_ringan, "Hujan Ringan"),
    ]
    return banded(value, bands, "Tidak Hujan", UNKNOWN_CLASS)


# Legend bands of the map, and the bands of the forecast cards.
MAP_BANDS = ((38, "Sangat Panas"), (33, "Panas"), (28, "Hangat"), (20, "Normal"))
MAP_BELOW = "Dingin"
CARD_BANDS = ((35, "35"), (32, "32"), (28, "28"), (24, "24"))
CARD_BELOW = "<24"


def temp_band(value: Column, bands=MAP_BANDS, below: str = MAP_BELOW) -> Column:
    """K6: legend band of a temperature, null without data."""
    return banded(value, bands, below, None)


# Icon code of a condition text.
ICON_CODES = {
    "Cerah": 0,
    "Cerah Berawan": 2,
    "Berawan": 3,
    "Berawan Tebal": 4,
    "Udara Kabur": 10,
    "Kabut": 45,
    "Hujan Ringan": 61,
    "Hujan Sedang": 63,
    "Hujan Lebat": 65,
    "Hujan Lokal": 80,
    "Hujan Petir": 95,
}
DEFAULT_ICON = 3


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(part) for pair in entries.items() for part in pair])


def condition_icon(desc: Column) -> Column:
    """K7"""
    return F.coalesce(literal_map(ICON_CODES)[desc], F.lit(DEFAULT_ICON))


def is_daytime(instant: Column, zone: str = LOCAL_TIME_ZONE) -> Column:
    """K8: local hour from 6 up to, not including, 18."""
    return F.hour(F.from_utc_timestamp(instant, zone)).between(6, 17)


# 16-point compass, clockwise from north.
COMPASS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)


def deg_to_compass(degrees: Column) -> Column:
    """P10: sector of 22.5 degrees centred on each point; truncates toward zero like an int cast."""
    sector = ((degrees.cast("double") + F.lit(11.25)) / F.lit(22.5)).cast("int")
    index = F.pmod(sector, F.lit(len(COMPASS)))
    point = F.get(F.array(*[F.lit(point) for point in COMPASS]), index)
    return F.when(degrees.isNotNull(), point)  # a null index would read as a position


# Weather condition ids of the second provider.
OWM_CONDITIONS = {
    200: "Thunderstorm with light rain",
    201: "Thunderstorm with rain",
    202: "Thunderstorm with heavy rain",
    300: "Light drizzle",
    301: "Drizzle",
    500: "Light rain",
    501: "Moderate rain",
    502: "Heavy rain",
    600: "Light snow",
    701: "Mist",
    721: "Haze",
    800: "Clear sky",
    801: "Few clouds",
    802: "Scattered clouds",
    803: "Broken clouds",
    804: "Overcast clouds",
}


def owm_condition_text(code: Column) -> Column:
    """Text of a condition id, null when unknown."""
    return literal_map(OWM_CONDITIONS)[code.cast("int")]
