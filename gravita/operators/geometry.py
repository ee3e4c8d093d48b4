"""Geometry that column expressions cannot say: vectorised functions over batches of rings."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Semi-axes of the WGS84 ellipsoid in metres.
_A, _B = 6378137.0, 6356752.314245179


def _ring_area(p: np.ndarray) -> float:
    """Signed planar area."""
    x, y = p[:, 0], p[:, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def inner_point(rings: list[np.ndarray]) -> tuple[float, float]:
    """A point inside: on the horizontal line through the middle of the outline that passes no vertex, the
    middle of the widest stretch inside (crossings counted over all rings, equal ones once)."""
    rings = list({r.tobytes(): r for r in rings}.values())
    ys = np.unique(np.concatenate([r[:, 1] for r in rings]))
    if len(ys) < 2:
        return float(rings[0][0, 0]), float(rings[0][0, 1])
    gap = np.abs((ys[:-1] + ys[1:]) / 2 - (ys[0] + ys[-1]) / 2).argmin()
    y = float((ys[gap] + ys[gap + 1]) / 2)
    cuts: list[float] = []
    for r in rings:
        a, b = r[:-1], r[1:]
        hit = (a[:, 1] > y) != (b[:, 1] > y)
        a, b = a[hit], b[hit]
        cuts += (a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])).tolist()
    cuts.sort()
    spans = list(zip(cuts[::2], cuts[1::2], strict=False))
    west, east = max(spans, key=lambda s: s[1] - s[0])
    return (west + east) / 2, y


def _rings(value) -> list[np.ndarray]:
    return [np.array([list(p) for p in ring], float).reshape(-1, 2) for ring in value]


def _inner(values: pd.Series) -> pd.DataFrame:
    found = [inner_point(_rings(v)) if v is not None and len(v) else (None, None) for v in values]
    return pd.DataFrame(found, columns=["lon", "lat"], dtype=float)


def interior_point(rings: str) -> Column:
    """lon and lat of a point inside a polygon; null without one."""
    return F.pandas_udf(_inner, "struct<lon:double,lat:double>")(F.col(rings))


def authalic_area(ring: np.ndarray) -> float:
    """Area in square metres of a ring of longitudes and latitudes, on the sphere of equal area."""
    e2 = 1 - (_B / _A) ** 2
    e = np.sqrt(e2)
    s = np.sin(np.radians(ring[:, 1]))
    q = lambda t: (1 - e2) * (t / (1 - e2 * t * t) + np.arctanh(e * t) / e)
    beta, lon = q(s) / q(1.0), np.radians(ring[:, 0])
    return float(abs((np.diff(lon) * (beta[:-1] + beta[1:])).sum() / 2) * _A * _A * q(1.0) / 2)


def _area(values: pd.Series) -> pd.Series:
    """The outer rings' area less the holes', told apart by their turn."""
    def one(v):
        rings = _rings(v)
        turn = np.sign(_ring_area(rings[0]))
        return sum(authalic_area(r) * (1 if np.sign(_ring_area(r)) == turn else -1) for r in rings)

    return pd.Series([one(v) if v is not None and len(v) else None for v in values], dtype=float)


def spheroid_area(rings: str) -> Column:
    return F.pandas_udf(_area, "double")(F.col(rings))


def wkb_polygons(data: bytes) -> list[list[np.ndarray]]:
    """Rings of each part of a Polygon or MultiPolygon in well-known binary; others have no parts."""

    def read(at: int) -> tuple[list[list[np.ndarray]], int]:
        order = "<" if data[at] else ">"
        kind, n = struct.unpack_from(f"{order}II", data, at + 1)
        at, parts, found = at + 9, [], []
        if kind % 1000 == 6:
            for _ in range(n):
                inner, at = read(at)
                parts += inner
            return parts, at
        if kind % 1000 != 3:
            return [], at
        wide = 2 + kind // 1000 % 3 + (kind // 1000 == 3)
        for _ in range(n):
            (points,) = struct.unpack_from(f"{order}I", data, at)
            found.append(np.frombuffer(data, f"{order}f8", points * wide, at + 4).reshape(-1, wide)[:, :2].astype(float))
            at += 4 + 8 * wide * points
        return [found], at

    return read(0)[0]


def wkb_area(geometry: str) -> Column:
    """Square metres of a polygon in well-known binary: outer rings less their holes."""

    @F.pandas_udf("double")
    def area(values: pd.Series) -> pd.Series:
        one = lambda part: authalic_area(part[0]) - sum(map(authalic_area, part[1:]))
        return pd.Series([None if v is None else sum(one(part) for part in wkb_polygons(v) if part) for v in values], dtype=float)

    return area(F.col(geometry))


def kept_points(p: np.ndarray, first: np.ndarray, last: np.ndarray, tolerance: float) -> np.ndarray:
    """Of chains of points, from ``first`` to ``last`` in one buffer, those that the line between kept neighbours
    misses by more than the tolerance, and all ends. All chains are cut at once: each pass measures every point
    that still lies inside a piece, keeps the furthest of each piece that is far enough (the first of equals),
    and goes on with the two pieces it makes."""
    keep = np.zeros(len(p), bool)
    keep[first], keep[last] = True, True
    while True:
        long = last - first > 1
        first, last = first[long], last[long]
        if not len(first):
            return keep
        size = last - first - 1
        begin = np.cumsum(size) - size
        piece = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(piece)) - begin[piece] + first[piece] + 1
        d = (p[last] - p[first])[piece]
        away = p[at] - p[first[piece]]
        n = np.hypot(d[:, 0], d[:, 1])
        with np.errstate(invalid="ignore", divide="ignore"):
            far = np.where(n > 0, np.abs(d[:, 0] * away[:, 1] - d[:, 1] * away[:, 0]) / n, np.hypot(away[:, 0], away[:, 1]))
        most = np.maximum.reduceat(far, begin)
        top = np.minimum.reduceat(np.where(far == most[piece], at, len(p)), begin)
        cut = most > tolerance
        keep[top[cut]] = True
        first, last = np.concatenate([first[cut], top[cut]]), np.concatenate([top[cut], last[cut]])


class Outlines:
    """Polygons of a batch as one buffer of points, cut into rings and those into polygons; null ones have no rings."""

    def __init__(self, points: np.ndarray, rings: np.ndarray, shapes: np.ndarray):
        self.points, self.rings, self.shapes = points, rings, shapes  # both with the end

    @classmethod
    def of(cls, column: pa.Array) -> Outlines:
        """From lists of rings of points, of which the first two numbers count."""
        if column.null_count:
            column = pc.if_else(column.is_valid(), column, pa.scalar([], column.type))
        ring_lists, point_lists = column.flatten(), column.flatten().flatten()
        ends = lambda lists: np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        wide = ends(point_lists)
        numbers = point_lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        points = np.stack([numbers[wide[:-1]], numbers[wide[:-1] + 1]], 1) if len(point_lists) else np.zeros((0, 2))
        return cls(points, ends(ring_lists), ends(column))

    def column(self, missing: np.ndarray | None = None) -> pa.Array:
        """Lists of rings of points; ``missing`` says which polygons are null."""
        numbers = pa.array(self.points.ravel())
        points = pa.ListArray.from_arrays(pa.array(np.arange(len(self.points) + 1) * 2, pa.int32()), numbers)
        rings = pa.ListArray.from_arrays(pa.array(self.rings, pa.int32()), points)
        out = pa.ListArray.from_arrays(pa.array(self.shapes, pa.int32()), rings)
        return out if missing is None else pc.if_else(pa.array(~missing), out, pa.nulls(len(out), out.type))

    def ring_of(self) -> np.ndarray:
        """The ring of each point."""
        return np.repeat(np.arange(len(self.rings) - 1), np.diff(self.rings))

    def shape_of(self) -> np.ndarray:
        """The polygon of each ring."""
        return np.repeat(np.arange(len(self.shapes) - 1), np.diff(self.shapes))

    def with_points(self, keep: np.ndarray) -> Outlines:
        kept = np.concatenate([[0], np.cumsum(keep)])
        return Outlines(self.points[keep], kept[self.rings], self.shapes)

    def with_rings(self, keep: np.ndarray) -> Outlines:
        kept = np.concatenate([[0], np.cumsum(keep)])
        size = np.diff(self.rings)
        return Outlines(self.points[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(size[keep])]), kept[self.shapes])

    def areas(self) -> np.ndarray:
        """Signed planar area of each ring."""
        p, ring = self.points, self.ring_of()
        if not len(p):
            return np.zeros(len(self.rings) - 1)
        q = p - p[self.rings[ring]]
        turn = np.zeros(len(p))
        turn[:-1] = np.where(ring[1:] == ring[:-1], q[:-1, 0] * q[1:, 1] - q[1:, 0] * q[:-1, 1], 0)
        return np.bincount(ring, turn, len(self.rings) - 1) / 2

    def thinned(self, tolerance: float, halves: bool = False) -> Outlines:
        """Rings, or each half of them, as chains of ``kept_points``."""
        size = np.diff(self.rings)
        first, last = self.rings[:-1][size > 0], self.rings[1:][size > 0] - 1
        if halves:
            middle = first + (last - first + 1) // 2
            first, last = np.concatenate([first, middle]), np.concatenate([middle, last])
        return self.with_points(kept_points(self.points, first, last, tolerance))


class Grid:
    """Transverse Mercator metres about a meridian, by series in the third flattening (good to a millimetre
    within some degrees)."""

    def __init__(self, meridian: float, scale: float = 0.9996):
        n = (_A - _B) / (_A + _B)
        self.meridian, self.n, self.radius = np.radians(meridian), n, scale * _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        self.out = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
        self.back = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
        self.lift = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)

    def metres(self, p: np.ndarray) -> np.ndarray:
        """East and north of longitudes and latitudes."""
        lon, s, k = np.radians(p[:, 0]) - self.meridian, np.sin(np.radians(p[:, 1])), 2 * np.sqrt(self.n) / (1 + self.n)
        t = np.sinh(np.arctanh(s) - k * np.arctanh(k * s))
        north, east = np.arctan2(t, np.cos(lon)), np.arctanh(np.sin(lon) / np.sqrt(1 + t * t))
        more = [(c, 2 * j) for j, c in enumerate(self.out, 1)]
        return self.radius * np.stack([
            east + sum(c * np.cos(j * north) * np.sinh(j * east) for c, j in more), north + sum(c * np.sin(j * north) * np.cosh(j * east) for c, j in more)
        ], 1)

    def degrees(self, p: np.ndarray) -> np.ndarray:
        """Longitudes and latitudes of east and north."""
        east, north = p[:, 0] / self.radius, p[:, 1] / self.radius
        less = [(c, 2 * j) for j, c in enumerate(self.back, 1)]
        north, east = north - sum(c * np.sin(j * north) * np.cosh(j * east) for c, j in less), east - sum(c * np.cos(j * north) * np.sinh(j * east) for c, j in less)
        chi = np.arcsin(np.sin(north) / np.cosh(east))
        lat = chi + sum(c * np.sin(2 * j * chi) for j, c in enumerate(self.lift, 1))
        return np.degrees(np.stack([self.meridian + np.arctan2(np.sinh(east), np.cos(north)), lat], 1))


def cleaned(shapes: Outlines, grid: Grid, snap: float, least_area: float, tolerance: float, places: int = 5) -> tuple[Outlines, np.ndarray]:
    """Polygons after their points were snapped to a grid of metres and thinned, in rounded degrees, and which of
    them go, as their area in square metres isn't more than the least. Rings that collapse go."""
    flat = Outlines(np.round(grid.metres(shapes.points) / snap) * snap, shapes.rings, shapes.shapes)
    ring = flat.ring_of()
    moved = np.ones(len(ring), bool)
    moved[1:] = (ring[1:] != ring[:-1]) | (flat.points[1:] != flat.points[:-1]).any(1)
    flat = flat.with_points(moved)
    size = np.diff(flat.rings)
    solid = size > 3
    solid[solid] = (flat.points[flat.rings[:-1][solid]] == flat.points[flat.rings[1:][solid] - 1]).all(1)
    flat = flat.with_rings(solid & (flat.areas() != 0))
    area, shape = np.abs(flat.areas()), flat.shape_of()
    outer = np.diff(shape, prepend=-1) != 0
    total = np.bincount(shape, np.where(outer, area, -area), len(flat.shapes) - 1)
    large = (np.diff(flat.shapes) > 0) & (total > least_area)
    flat = flat.with_rings(large[shape]).thinned(tolerance, halves=True)
    flat = flat.with_rings(np.diff(flat.rings) > 3)
    return Outlines(np.round(grid.degrees(flat.points), places), flat.rings, flat.shapes), ~large | (np.diff(flat.shapes) == 0)


def clean_outline(rings: str, meridian: float, snap: float = 0.5, least_area: float = 0.0, tolerance: float = 0.25) -> Column:
    """Column form of ``cleaned``; null for polygons that go."""
    grid = Grid(meridian)

    @F.arrow_udf("array<array<array<double>>>")
    def clean(values: pa.Array) -> pa.Array:
        found, gone = cleaned(Outlines.of(values), grid, snap, least_area, tolerance)
        return found.column(gone)

    return clean(F.col(rings))


def simplified(rings: str, tolerance: float) -> Column:
    @F.arrow_udf("array<array<array<double>>>")
    def thin(values: pa.Array) -> pa.Array:
        return Outlines.of(values).thinned(tolerance).column(values.is_null().to_numpy(zero_copy_only=False))

    return thin(F.col(rings))


def rings_of(segments: np.ndarray) -> list[np.ndarray]:
    """Closed rings from undirected segments; where several meet, the next in order is taken."""
    at: dict[tuple, list[int]] = {}
    ends = [((s[0], s[1]), (s[2], s[3])) for s in segments.tolist()]
    for i, pair in enumerate(ends):
        for p in pair:
            at.setdefault(p, []).append(i)
    if any(len(v) % 2 for v in at.values()):
        raise ValueError("Boundaries do not share their vertices")
    used, out = set(), []
    for i in range(len(ends)):
        if i in used:
            continue
        used.add(i)
        ring = list(ends[i])
        while ring[-1] != ring[0]:
            k = next(j for j in at[ring[-1]] if j not in used)
            used.add(k)
            a, b = ends[k]
            ring.append(b if a == ring[-1] else a)
        out.append(np.array(ring))
    return out


def stitched(segments: DataFrame) -> DataFrame:
    """region_id, ring, points of the outlines (columns x1, y1, x2, y2). A region's outline is one group:
    its size is that of one polygon."""
    kind = segments.schema["region_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["x1", "y1", "x2", "y2"])
        rings = rings_of(pdf[["x1", "y1", "x2", "y2"]].to_numpy())
        return pd.DataFrame({"region_id": pdf.region_id.iloc[0], "ring": range(len(rings)), "points": [r.tolist() for r in rings]})

    return segments.groupBy("region_id").applyInPandas(run, f"region_id {kind}, ring int, points array<array<double>>")
