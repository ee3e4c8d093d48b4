"""Distances, grids and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The earth's radius, kilometres in a degree, and the commuting speed in km/h.
EARTH_KM = 6371.0
KM_PER_DEGREE = 111.2
SPEED_KMH = 35.0
_SPHERE = 6378137.0


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    return F.lit(EARTH_KM) * 2 * F.asin(F.sqrt(h))


def planar2(lon1: Column, lat1: Column, lon2: Column, lat2: Column, scale: Column) -> Column:
    """Squared distance in km on a plane, with longitudes shortened by ``scale``. Ranks, no more."""
    x = (lon1 - lon2) * scale * KM_PER_DEGREE
    y = (lat1 - lat2) * KM_PER_DEGREE
    return x * x + y * y


def bucket(x: Column, size: float) -> Column:
    """Grid index, toward minus infinity."""
    return F.floor(x / F.lit(size)).cast("long")


def inside(lon: Column, lat: Column, bbox) -> Column:
    """Whether a point is in a box, borders included; NaN is outside."""
    west, south, east, north = bbox
    return (lon >= west) & (lon <= east) & ~F.isnan(lon) & (lat >= south) & (lat <= north) & ~F.isnan(lat)


def overlaps(bounds: Column, bbox) -> Column:
    """Whether bounds (west, south, east, north) and a box share a point."""
    west, south, east, north = bbox
    return ~((bounds.getField("east") < west) | (bounds.getField("west") > east) | (bounds.getField("north") < south) | (bounds.getField("south") > north))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def to_wgs84_lon(x: Column) -> Column:
    return F.degrees(x / _SPHERE)


def to_wgs84_lat(y: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(y / _SPHERE)) - F.pi() / 2)


def to_wgs84(rings: Column) -> Column:
    """Rings of Web Mercator points as longitude and latitude."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(to_wgs84_lon(p[0]), to_wgs84_lat(p[1]))))


def bounds(rings: Column) -> Column:
    points = F.flatten(rings)
    side = lambda i: F.transform(points, lambda p: p[i])
    return F.struct(
        F.array_min(side(0)).alias("west"), F.array_min(side(1)).alias("south"),
        F.array_max(side(0)).alias("east"), F.array_max(side(1)).alias("north"),
    )


def gravity(km: Column, decay_km: float) -> Column:
    return F.exp(-km / decay_km)


def driving_seconds(km: Column) -> Column:
    return F.rint(km / SPEED_KMH * 3600).cast("long")


def driving_metres(km: Column) -> Column:
    return F.rint(km * 1000).cast("long")
