"""Geometry and projection column functions (G1-G4, G7, G9-G13, E6-E8, V1, V3, geohash, S7).

A geometry is struct<type, parts, poly>: parts are lines or rings of positions, poly the index of
the polygon that each part belongs to. Positions are arrays of longitude, latitude and maybe
elevation. All functions stay in native expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius (km), sphere of the satellite grid (m), its pixels and tiles.
EARTH_KM = 6371.0088
SPHERE_M = 6371007.181
TILE_PIXELS, TILES_X, TILES_Y = 3000, 36, 18
TILE_M, PIXEL_M = 1111950.519667, 375.0
GRID_WIDTH_M, GRID_HEIGHT_M = 20015109.354 * 2, 10007554.677 * 2
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"

GEOMETRY = "struct<type:string,parts:array<array<array<double>>>,poly:array<int>>"


def lon(p: Column) -> Column:
    return p[0]


def lat(p: Column) -> Column:
    return p[1]


def elevation(p: Column) -> Column:
    return F.get(p, 2)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """G1: great-circle distance."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.sin(dlon) * F.sin(dlon) * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def line_km(line: Column) -> Column:
    """Length of one line or ring."""
    n = F.size(line)
    pairs = F.zip_with(F.slice(line, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: haversine_km(a[0], a[1], b[0], b[1]))
    return F.when(n > 1, F.aggregate(pairs, F.lit(0.0), lambda s, d: s + d)).otherwise(F.lit(0.0))


def length_km(geometry: Column) -> Column:
    """G1: length of all lines, or perimeter of all rings."""
    return F.aggregate(F.transform(geometry["parts"], line_km), F.lit(0.0), lambda s, d: s + d)


def is_polygon(geometry: Column) -> Column:
    return geometry["type"].isin("Polygon", "MultiPolygon")


def weight_km(geometry: Column) -> Column:
    """Length, or a third of the perimeter for polygons."""
    return F.when(is_polygon(geometry), length_km(geometry) / 3).otherwise(length_km(geometry))


def positions(geometry: Column) -> Column:
    """All positions."""
    return F.flatten(geometry["parts"])


def open_positions(geometry: Column) -> Column:
    """All positions without the closing one of each ring."""
    closed = F.transform(geometry["parts"], lambda r: F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(1))))
    return F.when(is_polygon(geometry), F.flatten(closed)).otherwise(positions(geometry))


def centroid(geometry: Column) -> Column:
    """Mean of the positions, as array(lon, lat)."""
    pts = open_positions(geometry)
    mean = lambda k: F.aggregate(F.transform(pts, lambda p: p[k]), F.lit(0.0), lambda s, v: s + v) / F.size(pts)
    return F.array(mean(0), mean(1))


def bbox(geometry: Column) -> Column:
    """struct<west, south, east, north>."""
    pts = positions(geometry)
    x, y = F.transform(pts, lambda p: p[0]), F.transform(pts, lambda p: p[1])
    return F.struct(F.array_min(x).alias("west"), F.array_min(y).alias("south"), F.array_max(x).alias("east"), F.array_max(y).alias("north"))


def elevations(geometry: Column) -> Column:
    """Elevations of all positions that have one."""
    return F.array_compact(F.transform(positions(geometry), elevation))


def to_sinusoidal(geometry: Column) -> Column:
    """All positions in metres of the sinusoidal grid; elevations are left out."""

    def moved(p: Column) -> Column:
        s = sinusoidal(p[0], p[1])
        return F.array(s["x"], s["y"])

    return F.struct(geometry["type"].alias("type"), F.transform(geometry["parts"], lambda r: F.transform(r, moved)).alias("parts"), geometry["poly"].alias("poly"))


def type_name(geometry: Column) -> Column:
    """Upper case, polygons as multipolygons."""
    return F.when(geometry["type"] == "Polygon", "MULTIPOLYGON").otherwise(F.upper(geometry["type"]))


def along(line: Column, fraction: Column) -> Column:
    """Position at a fraction of the straight step between two positions, as array(lon, lat)."""
    a, b = line[0], line[1]
    return F.array(a[0] + (b[0] - a[0]) * fraction, a[1] + (b[1] - a[1]) * fraction)


def towards(from_lon: Column, from_lat: Column, to_lon: Column, to_lat: Column, km: float) -> Column:
    """The point so many km from one point on the great circle to another, array(lon, lat)."""
    f1, f2, dl = F.radians(from_lat), F.radians(to_lat), F.radians(to_lon - from_lon)
    bearing = F.atan2(F.sin(dl) * F.cos(f2), F.cos(f1) * F.sin(f2) - F.sin(f1) * F.cos(f2) * F.cos(dl))
    d = km / EARTH_KM
    f = F.asin(F.sin(f1) * math.cos(d) + F.cos(f1) * math.sin(d) * F.cos(bearing))
    l2 = F.radians(from_lon) + F.atan2(F.sin(bearing) * math.sin(d) * F.cos(f1), math.cos(d) - F.sin(f1) * F.sin(f))
    return F.array(F.degrees(l2), F.degrees(f))


def points_each_km(geometry: Column, km: float) -> Column:
    """Positions every so many km along lines and outer rings, ends included, unique."""
    outer = F.filter(geometry["parts"], lambda r, i: ~is_polygon(geometry) | (i == 0) | (F.get(geometry["poly"], i) != F.get(geometry["poly"], i - 1)))

    def of_line(line: Column) -> Column:
        steps = F.zip_with(F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b"), haversine_km(a[0], a[1], b[0], b[1]).alias("d")))
        start = F.struct(F.lit(0.0).alias("done"), F.array().cast("array<array<double>>").alias("out"))

        def walk(s: Column, e: Column) -> Column:
            first, last = F.ceil(s["done"] / km), F.floor((s["done"] + e["d"]) / km)
            inside = F.when((e["d"] > 0) & (first <= last), F.transform(F.sequence(first, last), lambda k: along(F.array(e["a"], e["b"]), (k * km - s["done"]) / e["d"]))).otherwise(F.array().cast("array<array<double>>"))
            return F.struct((s["done"] + e["d"]).alias("done"), F.concat(s["out"], inside).alias("out"))

        middle = F.aggregate(steps, start, walk, lambda s: s["out"])
        tail = F.slice(F.element_at(line, -1), 1, 2)
        return F.concat(middle, F.array(tail))

    flat = F.transform(F.flatten(F.transform(outer, of_line)), lambda p: F.slice(p, 1, 2))
    single = F.transform(positions(geometry), lambda p: F.slice(p, 1, 2))
    return F.array_distinct(F.when(geometry["type"].isin("Point", "MultiPoint"), single).otherwise(flat))


def geohash(lon_: Column, lat_: Column, precision: int) -> Column:
    """Geohash text of a point (the key of the elevation and place tables)."""
    bits = precision * 5
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    cell = lambda v, low, span, n: F.least(F.floor((v - low) / span * (1 << n)).cast("long"), F.lit((1 << n) - 1).cast("long"))
    x, y = cell(lon_, -180.0, 360.0, n_lon), cell(lat_, -90.0, 180.0, n_lat)
    bit = lambda v, k: F.shiftright(v, k).bitwiseAND(F.lit(1))
    digits = []
    for d in range(precision):
        value = F.lit(0)
        for j in range(5):
            k = d * 5 + j
            b = bit(x, n_lon - 1 - k // 2) if k % 2 == 0 else bit(y, n_lat - 1 - k // 2)
            value = value * 2 + b
        digits.append(F.substring(F.lit(GEOHASH_DIGITS), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def tile_pixel(lon_: Column, lat_: Column, zoom: int, size: int) -> Column:
    """struct<x, y, px, py> of the web-mercator tile and the fractional pixel in it."""
    sin = F.greatest(F.least(F.sin(F.radians(lat_)), F.lit(0.9999)), F.lit(-0.9999))
    n = float(1 << zoom)
    x = (lon_ / 360 + 0.5) * n
    y = (F.lit(0.5) - F.log((1 + sin) / (1 - sin)) / (4 * math.pi)) * n
    tx, ty = F.floor(x), F.floor(y)
    return F.struct(tx.cast("int").alias("x"), ty.cast("int").alias("y"), ((x - tx) * size).alias("px"), ((y - ty) * size).alias("py"))


def corners(tp: Column, zoom: int, size: int) -> Column:
    """Array of struct<x, y, px, py, w>: the four pixels around a point with bilinear weights.

    Pixels are sampled at their centres; x wraps around the world, and beyond a pole it is null.
    """
    fx, fy = tp["px"] - 0.5, tp["py"] - 0.5
    x0, y0 = F.floor(fx), F.floor(fy)
    dx, dy = fx - x0, fy - y0
    n = 1 << zoom
    out = []
    for ox in (0, 1):
        for oy in (0, 1):
            px, py = x0 + ox, y0 + oy
            tx = F.pmod(tp["x"] + F.floor(px / size), F.lit(n))
            ty = tp["y"] + F.floor(py / size)
            w = (dx if ox else 1 - dx) * (dy if oy else 1 - dy)
            out.append(F.struct(tx.cast("int").alias("x"), ty.cast("int").alias("y"), F.pmod(px, F.lit(size)).cast("int").alias("px"), F.pmod(py, F.lit(size)).cast("int").alias("py"), w.alias("w")))
    low, high = tp["y"] + F.floor(y0 / size), tp["y"] + F.floor((y0 + 1) / size)
    return F.when((low >= 0) & (high < n), F.array(*out))


def decode_mapbox(r: Column, g: Column, b: Column) -> Column:
    """E8."""
    return F.lit(-10000.0) + (r * 65536 + g * 256 + b) * 0.1


def decode_terrarium(r: Column, g: Column, b: Column) -> Column:
    """E8."""
    return r * 256 + g + b / 256 - 32768


def bilinear(v00: Column, v10: Column, v01: Column, v11: Column, dx: Column, dy: Column) -> Column:
    """Weighted mean of four corners (first index along x)."""
    return v00 * (1 - dx) * (1 - dy) + v10 * dx * (1 - dy) + v01 * (1 - dx) * dy + v11 * dx * dy


def sinusoidal(lon_: Column, lat_: Column) -> Column:
    """V1: struct<x, y> in metres."""
    return F.struct((F.lit(SPHERE_M) * F.radians(lon_) * F.cos(F.radians(lat_))).alias("x"), (F.lit(SPHERE_M) * F.radians(lat_)).alias("y"))


def grid_pixel(x: Column, y: Column) -> Column:
    """V3: struct<h, v, row, col> of the satellite grid, clamped to it."""
    clamp = lambda v, most: F.greatest(F.least(v, F.lit(most)), F.lit(0)).cast("int")
    gx, gy = x + GRID_WIDTH_M / 2, F.lit(GRID_HEIGHT_M / 2) - y
    h, v = clamp(F.floor(gx / TILE_M), TILES_X - 1), clamp(F.floor(gy / TILE_M), TILES_Y - 1)
    col, row = clamp(F.floor((gx - h * TILE_M) / PIXEL_M), TILE_PIXELS - 1), clamp(F.floor((gy - v * TILE_M) / PIXEL_M), TILE_PIXELS - 1)
    return F.struct(h.alias("h"), v.alias("v"), row.alias("row"), col.alias("col"))


def tile_name(h: Column, v: Column) -> Column:
    return F.format_string("h%02dv%02d", h, v)


def normalised_longitude(lon_: Column) -> Column:
    """Into -180..180, keeping the sign of the remainder."""
    return (lon_ + 180) % 360 - 180


def bbox_clause(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The bounding-box setting of a download query."""
    from pisteflow.functions.jsnum import number_text

    n = lambda c: number_text(c)
    return F.concat(F.lit("[bbox:"), n(south), F.lit(","), n(normalised_longitude(west)), F.lit(","), n(north), F.lit(","), n(normalised_longitude(east)), F.lit("]"))


def viewport_hint(geometry: Column) -> Column:
    """2-D hint: centre of the bounding box and its extent in metres."""
    b = bbox(geometry)
    height = (b["north"] - b["south"]) * 111320.0
    middle = (b["north"] + b["south"]) / 2
    width = (b["east"] - b["west"]) * 111320.0 * F.cos(F.radians(middle))
    return F.struct(F.array((b["west"] + b["east"]) / 2, middle).alias("center"), F.lit(None).cast("double").alias("bearing"), width.alias("rotatedWidthMeters"), height.alias("rotatedHeightMeters"), (-height / 2).alias("minCameraY"))


def profile_points(line: Column, resolution_m: float = 25.0) -> Column:
    """Elevation profile points: n = ceil(length / resolution) equal steps, n + 1 points."""
    km = line_km(line)
    n = F.greatest(F.ceil(km * 1000 / resolution_m), F.lit(1))
    steps = F.zip_with(F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"), haversine_km(a[0], a[1], b[0], b[1]).alias("d")))
    empty = F.array().cast("array<struct<a:array<double>,b:array<double>,d:double,s:double>>")
    begun = F.aggregate(steps, F.struct(F.lit(0.0).alias("s"), empty.alias("o")), lambda x, e: F.struct((x["s"] + e["d"]).alias("s"), F.concat(x["o"], F.array(F.struct(e["a"].alias("a"), e["b"].alias("b"), e["d"].alias("d"), x["s"].alias("s")))).alias("o")), lambda x: x["o"])
    at = lambda i: i * km / n

    def place(i: Column) -> Column:
        last = F.element_at(F.filter(begun, lambda e: (e["s"] <= at(i) + 1e-12) & (e["d"] > 0)), -1)
        return along(F.array(last["a"], last["b"]), F.least((at(i) - last["s"]) / last["d"], F.lit(1.0)))

    return F.struct(F.transform(F.sequence(F.lit(0).cast("long"), n), place).alias("points"), (km * 1000 / n).alias("resolution"))
