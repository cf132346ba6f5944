"""Great-circle distance, and the boxes and cells that let files and joins skip what is far away."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_METERS = 6_371_008.8
_DEGREE = EARTH_METERS * math.pi / 180
#: Boxes are wider than the circle by this share, so rounding never cuts it.
_MARGIN = 1.000001


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Meters between two points (haversine)."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * EARTH_METERS * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def degrees_around(latitude: float, meters: float) -> tuple[float, float | None]:
    """Half the height and width, in degrees, of a box around a circle; no width where the circle reaches a pole."""
    high = meters / _DEGREE * _MARGIN
    if abs(latitude) + high >= 90:
        return high, None
    wide = math.degrees(math.asin(min(1.0, math.sin(math.radians(high)) / math.cos(math.radians(latitude)))))
    return high, wide * _MARGIN


def in_box(lat: Column, lon: Column, latitude: float, longitude: float, meters: float) -> Column:
    """A plain range filter that a scan can use. It holds for every point within `meters`."""
    high, wide = degrees_around(latitude, meters)
    near = lat.between(latitude - high, latitude + high)
    if wide is None or wide >= 180:
        return near
    low, top = longitude - wide, longitude + wide
    if low < -180:
        return near & (lon.between(low + 360, 180) | lon.between(-180, top))
    if top > 180:
        return near & (lon.between(low, 180) | lon.between(-180, top - 360))
    return near & lon.between(low, top)


def cell_rows(meters: int) -> float:
    """Height of a grid cell in degrees, such that a circle meets three rows of cells at most."""
    return meters / _DEGREE * _MARGIN


def cell_row(lat: Column, meters: int) -> Column:
    return F.floor((lat + 90) / cell_rows(meters)).cast("long")


def cells_in_row(row: Column, meters: int) -> Column:
    """Cells around the globe in a row, each as wide, at the row's side nearer the pole, as a circle's radius, or more."""
    edge = F.greatest(F.abs(row * cell_rows(meters) - 90), F.abs((row + 1) * cell_rows(meters) - 90))
    around = F.cos(F.radians(F.least(edge, F.lit(90.0)))) * (2 * math.pi * EARTH_METERS) / (meters * 1.001)
    return F.greatest(F.lit(1), F.floor(around)).cast("long")


def cell_column(lon: Column, cells: Column) -> Column:
    return F.least(F.floor((lon + 180) / 360 * cells), cells - 1).cast("long")
