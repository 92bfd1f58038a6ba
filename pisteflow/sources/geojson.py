"""GeoJSON and OSM JSON scans (S1, S2, S5, S10, S14, S15, S18, S25, S30) with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.functions import geo
from pisteflow.functions.jsnum import legacy_float

RAW_PROPERTIES = "struct<type:string,id:bigint,tags:map<string,string>>"
SECOND_SOURCE_PROPERTIES = "struct<id:string,name:string,scalerank:int,status:string,activities:array<string>,official_website:string>"
SITE = "type string, id bigint, tags map<string,string>, members array<struct<type:string,ref:bigint,role:string>>"
ELEMENT = "type string, id bigint, lat double, lon double, nodes array<bigint>, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>"


def _coordinates(kind: Column, raw: Column, legacy: bool) -> Column:
    """Geometry of its type and the JSON text of its coordinates."""
    number = "string" if legacy else "double"
    read = lambda depth: F.from_json(raw, "array<" * depth + number + ">" * depth)
    # As text, a number keeps the digits that it was written with.
    value = (lambda p: F.transform(p, legacy_float)) if legacy else (lambda p: p)
    line = lambda r: F.transform(r, value)
    one = F.array(F.array(value(read(1))))
    two = F.array(line(read(2)))
    three = F.transform(read(3), line)
    four = F.transform(read(4), lambda poly: F.transform(poly, line))
    zero = lambda parts: F.transform(parts, lambda _: F.lit(0))
    of = lambda parts, poly: F.struct(kind.alias("type"), parts.alias("parts"), poly.alias("poly"))
    return (
        F.when(kind == "Point", of(one, F.array(F.lit(0))))
        .when(kind.isin("LineString", "MultiPoint"), of(two, F.array(F.lit(0))))
        .when(kind == "Polygon", of(three, zero(three)))
        .when(kind == "MultiLineString", of(three, F.transform(three, lambda _, i: i)))
        .when(kind == "MultiPolygon", of(F.flatten(four), F.flatten(F.transform(four, lambda poly, i: F.transform(poly, lambda _: i)))))
    )


def read_features(spark: SparkSession, path: str, properties: str = RAW_PROPERTIES, legacy_float_parse: bool = False, lines: bool | None = None) -> DataFrame:
    """(geometry, properties, ordinal) of each feature of a FeatureCollection.

    lines: whether the file has one feature a line, as our own writer makes it; then it is split
    among tasks by byte ranges. Any other layout is parsed as one document. Broken features and
    unknown geometry types are dropped by predicate.
    """
    if lines is None:
        lines = _has_lines(spark, path)
    schema = f"type string, geometry struct<type:string,coordinates:string>, properties {properties}"
    if lines:
        text = spark.read.text(path).select(F.regexp_replace(F.trim("value"), ",$", "").alias("v")).where(F.col("v").startswith('{"type":"Feature"') & ~F.col("v").startswith('{"type":"FeatureCollection"'))
        rows = text.select(F.from_json("v", schema).alias("f"))
    else:
        rows = spark.read.schema(f"features array<struct<{_as_fields(schema)}>>").option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    out = rows.select(_coordinates(F.col("f.geometry.type"), F.col("f.geometry.coordinates"), legacy_float_parse).alias("geometry"), F.col("f.properties").alias("properties"), F.monotonically_increasing_id().alias("ordinal"))
    return out.where(F.col("geometry").isNotNull() & F.col("properties").isNotNull())


def _as_fields(ddl: str) -> str:
    return "type:string,geometry:struct<type:string,coordinates:string>,properties:" + ddl.split("properties ", 1)[1]


def _has_lines(spark: SparkSession, path: str) -> bool:
    first = spark.read.text(path).limit(1).collect()
    return bool(first) and first[0][0].strip().startswith('{"type":"FeatureCollection"') and first[0][0].rstrip().endswith("[")


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of an OSM JSON document; coordinates are rounded to twelve decimals."""
    schema = "elements array<struct<" + ELEMENT.replace(" string", ":string").replace(" bigint", ":bigint").replace(" double", ":double").replace(" array", ":array").replace(" map", ":map").replace(", ", ",") + ">>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    return rows.withColumns({"lat": F.round("lat", 12), "lon": F.round("lon", 12)})


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site relations."""
    return read_elements(spark, path).select("type", "id", "tags", "members")


def site_members(sites: DataFrame, ident: str = "id") -> DataFrame:
    """(member, site) pairs; member is type/ref."""
    return sites.select(F.col(ident).alias("site"), F.explode("members").alias("m")).select(F.concat_ws("/", "m.type", F.col("m.ref").cast("string")).alias("member"), "site").distinct()


def inside_bbox(df: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Features wholly inside a box; the boundary is outside."""
    b = geo.bbox(F.col("geometry"))
    return df.where((b["west"] > west) & (b["east"] < east) & (b["south"] > south) & (b["north"] < north))


def by_ids(df: DataFrame, ids: DataFrame, key: str = "key") -> DataFrame:
    """Rows of these keys."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """S18."""
    return spark.createDataFrame([], schema)


def of_type(objects: DataFrame, kind: str) -> DataFrame:
    """Objects of one type."""
    return objects.where(F.col("type") == kind)


def lift_stations(objects: DataFrame) -> DataFrame:
    """S13."""
    return objects.where((F.col("type") == "spot") & (F.col("spot_type") == "lift_station"))


def ski_areas(objects: DataFrame, only_source: str | None = None, only_polygons: bool = False) -> DataFrame:
    """Ski areas, by source or only polygons. Containment goes through the spatial join."""
    out = of_type(objects, "skiArea")
    if only_source:
        out = out.where(F.col("source") == only_source)
    return out.where("is_polygon") if only_polygons else out
