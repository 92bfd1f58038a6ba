"""Geometry kernels in numpy over Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.functions import geo

#: Radii of the reference spheroid (m).
SEMI_MAJOR_M, SEMI_MINOR_M = 6378137.0, 6356752.314245
ECCENTRICITY2 = 1 - (SEMI_MINOR_M / SEMI_MAJOR_M) ** 2


def plain(g) -> tuple[str, list[np.ndarray], list[int]]:
    """Type, parts as n x 2 arrays, and polygon of each part."""
    parts = [np.array([[p[0], p[1]] for p in r], dtype=float).reshape(-1, 2) for r in g["parts"]]
    return g["type"], parts, list(g["poly"])


def scale(lat0: float) -> tuple[float, float]:
    """Metres per degree of longitude and latitude on the spheroid."""
    s = math.sin(math.radians(lat0))
    w = 1 - ECCENTRICITY2 * s * s
    return math.radians(1) * SEMI_MAJOR_M / math.sqrt(w) * math.cos(math.radians(lat0)), math.radians(1) * SEMI_MAJOR_M * (1 - ECCENTRICITY2) / w**1.5


def _segments(g) -> tuple[np.ndarray, np.ndarray]:
    kind, parts, _ = g
    if kind in ("Point", "MultiPoint"):
        pts = np.concatenate(parts)
        return pts, pts
    a = [r[:-1] if len(r) > 1 else r for r in parts]
    b = [r[1:] if len(r) > 1 else r for r in parts]
    return np.concatenate(a), np.concatenate(b)


def points_in_rings(points: np.ndarray, rings: list[np.ndarray], poly: list[int]) -> np.ndarray:
    """Even-odd containment in any polygon; the boundary counts as inside."""
    out = np.zeros(len(points), bool)
    x, y = points[:, :1], points[:, 1:]
    for k in sorted(set(poly)):
        inside = np.zeros(len(points), bool)
        edge = np.zeros(len(points), bool)
        for ring in (r for r, q in zip(rings, poly, strict=True) if q == k):
            a, b = ring[:-1], ring[1:]
            ax, ay, bx, by = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
            crosses = (ay > y) != (by > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (bx - ax) * (y - ay) / (by - ay) + ax
            inside ^= (crosses & (x < at)).sum(axis=1) % 2 == 1
            cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            on = (np.abs(cross) < 1e-15) & (x >= np.minimum(ax, bx)) & (x <= np.maximum(ax, bx)) & (y >= np.minimum(ay, by)) & (y <= np.maximum(ay, by))
            edge |= on.any(axis=1)
        out |= inside | edge
    return out


def _proper_cross(a, b, c, d) -> np.ndarray:
    """Whether each segment of a-b crosses each of c-d in their insides."""
    cross = lambda o, p, q: (p[..., 0] - o[..., 0]) * (q[..., 1] - o[..., 1]) - (p[..., 1] - o[..., 1]) * (q[..., 0] - o[..., 0])
    a, b, c, d = a[:, None], b[:, None], c[None], d[None]
    return (cross(a, b, c) * cross(a, b, d) < 0) & (cross(c, d, a) * cross(c, d, b) < 0)


def distance_m(g, h) -> float:
    """Least distance in a local frame on the spheroid; 0 where the shapes meet."""
    (a, b), (c, d) = _segments(g), _segments(h)
    if intersects(g, h):
        return 0.0
    kx, ky = scale(float(np.mean([a[:, 1].mean(), c[:, 1].mean()])))
    k = np.array([kx, ky])
    a, b, c, d = a * k, b * k, c * k, d * k

    def to_segments(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> float:
        v = e - s
        n = np.maximum((v * v).sum(axis=1), 1e-30)
        t = np.clip(((p[:, None] - s[None]) * v[None]).sum(axis=2) / n[None], 0, 1)
        q = s[None] + t[..., None] * v[None]
        return float(np.sqrt(((p[:, None] - q) ** 2).sum(axis=2)).min())

    return min(to_segments(np.concatenate([a, b[-1:]]), c, d), to_segments(np.concatenate([c, d[-1:]]), a, b), to_segments(b, c, d), to_segments(d, a, b))


def intersects(g, h) -> bool:
    """The shapes share a point."""
    (a, b), (c, d) = _segments(g), _segments(h)
    for first, second, ends in ((g, h, (a, b)), (h, g, (c, d))):
        if second[0].endswith("Polygon") and points_in_rings(np.concatenate(ends), second[1], second[2]).any():
            return True
    if _proper_cross(a, b, c, d).any():
        return True
    touch = lambda p, s, e: (np.abs((e[None] - s[None])[..., 0] * (p[:, None] - s[None])[..., 1] - (e[None] - s[None])[..., 1] * (p[:, None] - s[None])[..., 0]) < 1e-15) & (p[:, None] >= np.minimum(s, e)[None]).all(axis=2) & (p[:, None] <= np.maximum(s, e)[None]).all(axis=2)
    return bool(touch(np.concatenate([a, b]), c, d).any() or touch(np.concatenate([c, d]), a, b).any())


def covered_by(g, area) -> bool:
    """All of g lies in the polygons of area, boundary included."""
    if not area[0].endswith("Polygon"):
        return False
    a, b = _segments(g)
    if not points_in_rings(np.concatenate([a, b]), area[1], area[2]).all():
        return False
    if g[0] in ("Point", "MultiPoint"):
        return True
    c, d = _segments(area)
    return not _proper_cross(a, b, c, d).any() and bool(points_in_rings((a + b) / 2, area[1], area[2]).all())


def nearest_on(g, point: np.ndarray) -> tuple[np.ndarray, float]:
    """The point of g's lines nearest to a point, and the distance in metres."""
    a, b = _segments(g)
    k = np.array(scale(float(point[1])))
    s, e, p = a * k, b * k, point * k
    v = e - s
    t = np.clip(((p - s) * v).sum(axis=1) / np.maximum((v * v).sum(axis=1), 1e-30), 0, 1)
    q = s + t[:, None] * v
    d = np.sqrt(((q - p) ** 2).sum(axis=1))
    i = int(d.argmin())
    return q[i] / k, float(d[i])


def self_crosses(ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    return bool(_proper_cross(a, b, a, b).any())


def is_valid(g) -> bool:
    """Finite positions, lines of two points, rings closed, of four, and not crossing themselves."""
    kind, parts, _ = g
    if not parts or any(not len(r) or not np.isfinite(r).all() for r in parts):
        return False
    if kind.endswith("Polygon"):
        return all(len(r) >= 4 and (r[0] == r[-1]).all() and not self_crosses(r) for r in parts)
    if kind.endswith("LineString"):
        return all(len(r) >= 2 for r in parts)
    return True


def central_points(g) -> list[list[float]]:
    """For each polygon, or the whole of anything else, its centroid if inside, else the nearest point of it."""
    kind, parts, poly = g
    groups = [[r for r, q in zip(parts, poly, strict=True) if q == k] for k in sorted(set(poly))] if kind == "MultiPolygon" else [parts]
    out = []
    for rings in groups:
        area = kind.endswith("Polygon")
        pts = np.concatenate([r[:-1] if area and len(r) > 1 else r for r in rings])
        c = pts.mean(axis=0)
        if area and points_in_rings(c[None], rings, [0] * len(rings))[0]:
            out.append(c.tolist())
        elif kind in ("Point", "MultiPoint"):
            out.append(c.tolist() if kind == "Point" else pts[((pts - c) ** 2).sum(axis=1).argmin()].tolist())
        else:
            out.append(nearest_on(("MultiLineString", rings, list(range(len(rings)))), c)[0].tolist())
    return out


def pixels_of(g) -> list[tuple[int, int, int, int]]:
    """V2, V4: (h, v, row, col) of the satellite pixels that g meets; that of its box's centre if none.

    Pixels are taken in the metric grid: a line meets those it passes, a polygon also those whose
    centre it holds.
    """
    kind, parts, poly = g
    flat = [np.column_stack([geo.SPHERE_M * np.radians(r[:, 0]) * np.cos(np.radians(r[:, 1])), geo.SPHERE_M * np.radians(r[:, 1])]) for r in parts]
    pts = np.concatenate(flat)
    low, high = pts.min(axis=0), pts.max(axis=0)
    out: dict[tuple[int, int, int, int], None] = {}
    shape = (kind, flat, poly)
    for h in range(_tile(low[0], True), _tile(high[0], True) + 1):
        for v in range(_tile(high[1], False), _tile(low[1], False) + 1):
            left, top = h * geo.TILE_M - geo.GRID_WIDTH_M / 2, geo.GRID_HEIGHT_M / 2 - v * geo.TILE_M
            clamp = lambda x: int(min(max(math.floor(x), 0), geo.TILE_PIXELS - 1))
            c0, c1 = clamp((low[0] - left) / geo.PIXEL_M), clamp((high[0] - left) / geo.PIXEL_M)
            r0, r1 = clamp((top - high[1]) / geo.PIXEL_M), clamp((top - low[1]) / geo.PIXEL_M)
            for row in range(r0, r1 + 1):
                for col in range(c0, c1 + 1):
                    x0, y1 = left + col * geo.PIXEL_M, top - row * geo.PIXEL_M
                    x1, y0 = x0 + geo.PIXEL_M, y1 - geo.PIXEL_M
                    box = ("Polygon", [np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]])], [0])
                    if intersects(shape, box):
                        out[h, v, row, col] = None
    if not out:
        x, y = (low + high) / 2
        h, v = _tile(x, True), _tile(y, False)
        clamp = lambda q: int(min(max(math.floor(q), 0), geo.TILE_PIXELS - 1))
        out[h, v, clamp((geo.GRID_HEIGHT_M / 2 - v * geo.TILE_M - y) / geo.PIXEL_M), clamp((x - h * geo.TILE_M + geo.GRID_WIDTH_M / 2) / geo.PIXEL_M)] = None
    return list(out)


def _tile(metres: float, across: bool) -> int:
    if across:
        return int(min(max(math.floor((metres + geo.GRID_WIDTH_M / 2) / geo.TILE_M), 0), geo.TILES_X - 1))
    return int(min(max(math.floor((geo.GRID_HEIGHT_M / 2 - metres) / geo.TILE_M), 0), geo.TILES_Y - 1))


# -- as columns ----------------------------------------------------------------------------------


def _rows(s: pd.DataFrame) -> list:
    return [plain({"type": t, "parts": p, "poly": q}) for t, p, q in zip(s["type"], s["parts"], s["poly"], strict=True)]


@F.pandas_udf(T.BooleanType())
def _valid(g: pd.DataFrame) -> pd.Series:
    return pd.Series([is_valid(x) for x in _rows(g)], dtype=bool)


def valid_geometry(geometry: Column) -> Column:
    """Native structural checks first; only polygons go on to the crossing test."""
    parts = geometry["parts"]
    finite = F.forall(F.flatten(parts), lambda p: (F.size(p) >= 2) & F.forall(p, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    lines = F.forall(parts, lambda r: F.size(r) >= 2)
    rings = F.forall(parts, lambda r: (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1)))
    shaped = F.when(geo.is_polygon(geometry), rings).when(geometry["type"].isin("LineString", "MultiLineString"), lines).otherwise(F.lit(True))
    return (F.size(parts) > 0) & finite & shaped & F.when(geo.is_polygon(geometry), _valid(geometry)).otherwise(F.lit(True))


@F.pandas_udf(T.DoubleType())
def distance(g: pd.DataFrame, h: pd.DataFrame) -> pd.Series:
    """Least distance in metres between two geometries."""
    return pd.Series([distance_m(a, b) for a, b in zip(_rows(g), _rows(h), strict=True)], dtype=float)


@F.pandas_udf(T.BooleanType())
def covers(area: pd.DataFrame, g: pd.DataFrame) -> pd.Series:
    return pd.Series([covered_by(b, a) for a, b in zip(_rows(area), _rows(g), strict=True)], dtype=bool)


@F.pandas_udf(T.BooleanType())
def meets(g: pd.DataFrame, h: pd.DataFrame) -> pd.Series:
    return pd.Series([intersects(a, b) for a, b in zip(_rows(g), _rows(h), strict=True)], dtype=bool)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def central(g: pd.DataFrame) -> pd.Series:
    return pd.Series([central_points(x) for x in _rows(g)])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def snap(g: pd.DataFrame, point: pd.Series) -> pd.Series:
    """Nearest point on a line: array(lon, lat, metres)."""
    out = []
    for x, p in zip(_rows(g), point, strict=True):
        q, d = nearest_on(x, np.array([p[0], p[1]], float))
        out.append([*q.tolist(), d])
    return pd.Series(out)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("tile", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType())])))
def pixels(g: pd.DataFrame) -> pd.Series:
    """V2, V5."""
    return pd.Series([[{"tile": f"h{h:02d}v{v:02d}", "row": r, "col": c} for h, v, r, c in pixels_of(x)] for x in _rows(g)])
