"""Feature identifiers (F21, F22): SHA-1 of a canonical text of feature type and geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pisteflow.functions.jsnum import number_text


def _string(s: str) -> str:
    return f"string:{len(s)}:{s}"


def _object(entries: list[tuple[str, str]], first: bool) -> str:
    """An object of the canonical text: three inherited keys, then its own in order."""
    native = "fn:string:8:[native]string:20:function-name:Object"
    parent = (
        f"object:3:{_string('prototype')}:Undefined,{_string('__proto__')}:Null,{_string('constructor')}:{native}object:0:,,"
        if first
        else "string:12:[CIRCULAR:1],"
    )
    constructor = f"{_string('constructor')}:{native}string:12:[CIRCULAR:2],"
    own = "".join(f"{_string(k)}:{v}," for k, v in entries)
    return f"object:{3 + len(entries)}:{_string('prototype')}:Undefined,{_string('__proto__')}:{parent}{constructor}{own}"


def _position(p: Column) -> Column:
    return F.concat(F.lit("array:"), F.size(p).cast("string"), F.lit(":"), F.array_join(F.transform(p, lambda v: F.concat(F.lit("number:"), number_text(v))), ""))


def _list(items: Column) -> Column:
    return F.concat(F.lit("array:"), F.size(items).cast("string"), F.lit(":"), F.array_join(items, ""))


def _line(r: Column) -> Column:
    return _list(F.transform(r, _position))


def coordinates_text(geometry: Column) -> Column:
    """Nested coordinates of a geometry in the canonical text."""
    parts = geometry["parts"]
    rings = F.transform(parts, _line)
    polygons = F.transform(F.array_distinct(geometry["poly"]), lambda k: _list(F.filter(F.zip_with(rings, geometry["poly"], lambda r, p: F.when(p == k, r)), lambda r: r.isNotNull())))
    return (
        F.when(geometry["type"] == "Point", _position(parts[0][0]))
        .when(geometry["type"].isin("LineString", "MultiPoint"), rings[0])
        .when(geometry["type"].isin("Polygon", "MultiLineString"), _list(rings))
        .otherwise(_list(polygons))
    )


def feature_id(feature_type: str, geometry: Column) -> Column:
    """equal feature types and geometries have equal ids."""
    mark = "\0"
    inner = _object([("coordinates", mark), ("type", mark)], first=False)
    outer = _object([("geometry", inner), ("properties", _object([("type", _string(feature_type))], first=False)), ("type", _string("Feature"))], first=True)
    head, middle, tail = outer.split(mark)
    kind = F.concat(F.lit("string:"), F.length(geometry["type"]).cast("string"), F.lit(":"), geometry["type"])
    return F.sha1(F.concat(F.lit(head), coordinates_text(geometry), F.lit(middle), kind, F.lit(tail)).cast("binary"))


def site_placeholder(ident: Column) -> Column:
    """where a site relation is put until its members are known."""
    return F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(F.lit(360.0), F.lit(360.0), ident.cast("double")))).alias("parts"), F.array(F.lit(0)).alias("poly"))


def is_placeholder(geometry: Column) -> Column:
    """F21."""
    p = geometry["parts"][0][0]
    return (geometry["type"] == "Point") & (p[0] == 360.0) & (p[1] == 360.0)


def unique_id() -> Column:
    """A random id; where an id has to stay the same in a rerun, hash what makes the row instead."""
    return F.uuid()
