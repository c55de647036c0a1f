"""Column expressions on coordinates.

A feature is an array of polygons, a polygon an array of rings, a ring an array of [lon, lat].
Only the first ring of a polygon, its outline, decides about containment.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Bounding box as four columns of the row at hand."""

    min_lon: Column
    max_lon: Column
    min_lat: Column
    max_lat: Column

    @classmethod
    def columns(cls, prefix: str = "") -> "Box":
        return cls(*[F.col(prefix + n) for n in ("min_lon", "max_lon", "min_lat", "max_lat")])


def vertices(polygons: Column) -> Column:
    """All [lon, lat] of a feature, closing vertices included."""
    return F.flatten(F.flatten(polygons))


def axis(points: Column, index: int) -> Column:
    return F.transform(points, lambda p: F.get(p, index))


def mean_of(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return total / F.nullif(F.size(values), F.lit(0))


def mercator(lat: Column) -> Column:
    radians = lat * F.lit(math.pi) / F.lit(180.0)
    return F.log(F.tan(F.lit(math.pi / 4) + radians / F.lit(2.0)))


def inverse_mercator(y: Column) -> Column:
    return F.atan(F.sinh(y)) * F.lit(180.0) / F.lit(math.pi)


def round_2(value: Column) -> Column:
    """Two decimals, ties upward."""
    return F.floor(value * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def project(lon: Column, lat: Column, box: Box, width: float, height: float):
    """X and y of a position on a canvas covering the box, y downward."""
    top, bottom = mercator(box.max_lat), mercator(box.min_lat)
    x = (lon - box.min_lon) / (box.max_lon - box.min_lon) * F.lit(float(width))
    y = (top - mercator(lat)) / (top - bottom) * F.lit(float(height))
    return round_2(x), round_2(y)


def unproject(x: Column, y: Column, box: Box, width: float, height: float):
    """X3 inverse: lon and lat of a canvas position."""
    top, bottom = mercator(box.max_lat), mercator(box.min_lat)
    lon = box.min_lon + x / F.lit(float(width)) * (box.max_lon - box.min_lon)
    lat = inverse_mercator(bottom + (F.lit(1.0) - y / F.lit(float(height))) * (top - bottom))
    return lon, lat


def crossing(lat: Column, x1: Column, y1: Column, x0: Column, y0: Column) -> Column:
    """Longitude at which the edge from 0 to 1 meets a latitude; null for a level edge."""
    return (x0 - x1) * (lat - y1) / F.nullif(y0 - y1, F.lit(0.0)) + x1


def crosses(lon: Column, lat: Column, x1: Column, y1: Column, x0: Column, y0: Column) -> Column:
    """Whether a ray eastward meets the edge. A point is inside if it meets an odd number of edges."""
    return ((y1 > lat) != (y0 > lat)) & (lon < crossing(lat, x1, y1, x0, y0))
