"""Small frames for tests."""

from pyspark.sql import functions as F

from pisteflow.functions import geo
from pisteflow.sources.geojson import RAW_PROPERTIES


def geometry(kind, coordinates):
    if kind == "Point":
        return (kind, [[coordinates]], [0])
    if kind in ("LineString", "MultiPoint"):
        return (kind, [coordinates], [0])
    if kind == "Polygon":
        return (kind, coordinates, [0] * len(coordinates))
    if kind == "MultiLineString":
        return (kind, coordinates, list(range(len(coordinates))))
    return (kind, [r for p in coordinates for r in p], [i for i, p in enumerate(coordinates) for _ in p])


def floats(x):
    return [floats(v) for v in x] if isinstance(x, list | tuple) else float(x)


def raw(spark, *rows):
    """Raw features of (kind, coordinates, tags); ids count from 1."""
    data = [(geometry(k, floats(c)), ("way", i, t), i) for i, (k, c, t) in enumerate(rows, 1)]
    return spark.createDataFrame(data, f"geometry {geo.GEOMETRY}, properties {RAW_PROPERTIES}, ordinal bigint")


def shapes(spark, key, *rows):
    """(key, geometry) of (key, kind, coordinates)."""
    return spark.createDataFrame([(k, geometry(t, floats(c))) for k, t, c in rows], f"{key} string, geometry {geo.GEOMETRY}")


def tag_frame(spark, *maps):
    return spark.createDataFrame([(m,) for m in maps], "t map<string,string>")


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def second(spark, ident, lon, lat, activities=("downhill",)):
    from pisteflow.sources.geojson import SECOND_SOURCE_PROPERTIES

    return spark.createDataFrame([(geometry("Point", [lon, lat]), (ident, f"Area {ident}", 1, "operating", list(activities), None))], f"geometry {geo.GEOMETRY}, properties {SECOND_SOURCE_PROPERTIES}")


__all__ = ["F", "floats", "geometry", "one", "raw", "second", "shapes", "tag_frame"]
