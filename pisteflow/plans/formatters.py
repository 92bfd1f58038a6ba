"""Layer formatters: raw features to typed runs, lifts, ski areas and spots.

Each takes the frame of a scan (geometry, properties) and returns typed columns: what can't be a
feature of the layer is dropped by predicates, and one pass makes all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.functions import geo, ids, tags
from pisteflow.functions.tags import tag
from pisteflow.operators.kernels import valid_geometry

PLACE = "struct<iso3166_1Alpha2:string,iso3166_2:string,localized:struct<en:struct<country:string,region:string,locality:string>>>"
SOURCE = "struct<type:string,id:string>"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _osm_source(p: str = "properties") -> Column:
    return F.array(F.struct(F.lit("openstreetmap").alias("type"), tags.osm_id(F.col(f"{p}.type"), F.col(f"{p}.id")).alias("id")))


def _websites(value: Column) -> Column:
    return F.array_compact(F.array(value))


def convention(geometry: Column) -> Column:
    """Difficulty convention by place: Japan and the Americas by box, else that of Europe."""
    c = geo.centroid(geometry)
    japan = c[0].between(122, 154) & c[1].between(24, 46)
    america = c[0].between(-180, -30) | (c[0] > 110) & (c[1] < 0)
    return F.when(japan, "japan").when(america, "north_america").otherwise("europe")


def parts_as_features(df: DataFrame) -> DataFrame:
    """One row a part of multi-part geometries, else the row itself."""
    g = F.col("geometry")
    lines = F.transform(g["parts"], lambda r: F.struct(F.lit("LineString").alias("type"), F.array(r).alias("parts"), F.array(F.lit(0)).alias("poly")))
    polygons = F.transform(
        F.array_distinct(g["poly"]),
        lambda k: F.struct(
            F.lit("Polygon").alias("type"),
            F.transform(F.filter(F.arrays_zip(g["parts"].alias("r"), g["poly"].alias("k")), lambda z: z["k"] == k), lambda z: z["r"]).alias("parts"),
            F.transform(F.filter(g["poly"], lambda p: p == k), lambda _: F.lit(0)).alias("poly"),
        ),
    )
    each = F.when(g["type"] == "MultiLineString", lines).when(g["type"] == "MultiPolygon", polygons).otherwise(F.array(g))
    return df.withColumn("geometry", F.explode(each))


def format_runs(raw: DataFrame) -> DataFrame:
    """Operating runs with a known use, one row a part."""
    t = F.col("properties.tags")
    state = tags.status_and_value(t, "piste:type")
    staged = raw.where(F.col("geometry.type") != "Point").withColumn("__s", state).withColumn("__uses", tags.run_uses(F.col("__s.value")))
    status = F.when(tag(t, "piste:abandoned") == "yes", "abandoned").otherwise(F.col("__s.status"))
    staged = staged.where((F.size("__uses") > 0) & (status == "operating")).where(valid_geometry(F.col("geometry")))
    ref = tags.ref(t)
    columns = {
        "type": F.lit("run"),
        "uses": F.col("__uses"),
        "name": tags.name(t, "piste:name", "name", ref),
        "ref": ref,
        "description": tags.first_defined(t, "piste:description", "description"),
        "difficulty": tags.difficulty(t),
        "difficultyConvention": convention(F.col("geometry")),
        "oneway": tags.oneway(t, F.col("__uses")),
        "gladed": tags.gladed(t),
        "patrolled": tags.boolean(tags.first_defined(t, "piste:patrolled", "patrolled")),
        "snowmaking": tags.boolean(tag(t, "piste:snowmaking")),
        "snowfarming": tags.boolean(tag(t, "piste:snowfarming")),
        "tunnel": F.when(tag(t, "tunnel").isNotNull(), True),
        "lit": tags.boolean(tags.first_defined(t, "piste:lit", "lit")),
        "grooming": tags.grooming(t),
        "skiAreas": _none("string"),
        "status": status,
        "sources": _osm_source(),
        "websites": _websites(tag(t, "website")),
        "wikidataID": tags.first_value(t, "wikidata"),
        "places": _none(PLACE),
        "viewportHint": geo.viewport_hint(F.col("geometry")),
    }
    kept = ["geometry", *(["ordinal"] if "ordinal" in raw.columns else [])]
    made = parts_as_features(staged.select(*kept, *(v.alias(k) for k, v in columns.items())))
    return made.select(ids.feature_id("run", F.col("geometry")).alias("id"), "geometry", *columns, *kept[1:])


def format_lifts(raw: DataFrame) -> DataFrame:
    """Lifts that passengers can use, of a known type."""
    t = F.col("properties.tags")
    line = F.col("geometry.type").isin("LineString", "MultiLineString")
    refused = (
        (tag(t, "passenger") == "no") | tag(t, "access").isin("forestry", "no") | tag(t, "foot").isin("no", "private")
        | tag(t, "usage").isin("freight", "industrial") | (tag(t, "railway:traffic_mode") == "freight")
    )
    staged = raw.where(line & ~F.coalesce(refused, F.lit(False))).withColumn("__s", tags.lift_status_and_type(t))
    staged = staged.where(F.col("__s.status").isNotNull() & F.col("__s.value").isNotNull()).where(valid_geometry(F.col("geometry")))
    ref = tags.ref(t)
    return staged.select(
        ids.feature_id("lift", F.col("geometry")).alias("id"),
        "geometry",
        F.lit("lift").alias("type"),
        F.col("__s.value").alias("liftType"),
        F.col("__s.status").alias("status"),
        tags.name(t, "name", None, ref).alias("name"),
        tags.boolean(tag(t, "oneway")).alias("oneway"),
        ref.alias("ref"),
        tags.first_value(t, "ref:FR:CAIRN").alias("refFRCAIRN"),
        F.nullif(tag(t, "description"), F.lit("")).alias("description"),
        tags.number(tag(t, "aerialway:occupancy")).alias("occupancy"),
        tags.number(tag(t, "aerialway:capacity")).alias("capacity"),
        tags.duration_seconds(tag(t, "aerialway:duration")).alias("duration"),
        tags.boolean(tag(t, "aerialway:bubble")).alias("bubble"),
        tags.boolean(tag(t, "aerialway:heating")).alias("heating"),
        tags.boolean(tag(t, "aerialway:detachable")).alias("detachable"),
        F.when(tag(t, "tunnel").isNotNull(), True).alias("tunnel"),
        F.when(tag(t, "access") == "private", "private").alias("access"),
        _none("string").alias("stations"),
        _none("string").alias("skiAreas"),
        _osm_source().alias("sources"),
        _websites(tag(t, "website")).alias("websites"),
        tags.first_value(t, "wikidata").alias("wikidataID"),
        _none(PLACE).alias("places"),
        geo.viewport_hint(F.col("geometry")).alias("viewportHint"),
    )


def _ski_area(df: DataFrame, geometry: Column, name: Column, source: Column, activities: Column, status: Column, websites: Column, wikidata: Column, rule: Column) -> DataFrame:
    """F15."""
    return df.select(
        ids.feature_id("skiArea", geometry).alias("id"),
        geometry.alias("geometry"),
        F.lit("skiArea").alias("type"),
        name.alias("name"),
        source.alias("sources"),
        activities.alias("activities"),
        status.alias("status"),
        websites.alias("websites"),
        wikidata.alias("wikidataID"),
        rule.alias("runConvention"),
        _none(PLACE).alias("places"),
        geo.viewport_hint(geometry).alias("viewportHint"),
    )


def format_landuse(raw: DataFrame) -> DataFrame:
    """winter-sports polygons."""
    t = F.col("properties.tags")
    sport = tag(t, "sport")
    fits = F.col("geometry.type").isin("Polygon", "MultiPolygon") & (sport.isNull() | sport.isin("skiing", "ski"))
    staged = raw.where(fits).withColumn("__s", tags.status_and_value(t, "landuse")["status"]).where("__s is not null").where(valid_geometry(F.col("geometry")))
    g = F.col("geometry")
    return _ski_area(staged, g, tags.name(t, "name"), _osm_source(), _none("string"), F.col("__s"), _websites(tag(t, "website")), tags.first_value(t, "wikidata"), convention(g))


def format_sites(sites: DataFrame) -> DataFrame:
    """site relations, at a placeholder point until their members are known."""
    t = F.col("tags")
    staged = sites.withColumn("__s", tags.status_and_value(t, "site")["status"]).where("__s is not null").withColumn("__g", ids.site_placeholder(F.col("id")))
    source = F.array(F.struct(F.lit("openstreetmap").alias("type"), tags.osm_id(F.col("type"), F.col("id")).alias("id")))
    return _ski_area(staged, F.col("__g"), tags.name(t, "name"), source, _none("string"), F.col("__s"), _websites(tag(t, "website")), tags.first_value(t, "wikidata"), F.lit("north_america"))


def format_second_source(raw: DataFrame) -> DataFrame:
    """ski areas of the second source, taken as they are."""
    p = lambda c: F.col(f"properties.{c}")
    source = F.array(F.struct(F.lit("skimap.org").alias("type"), p("id").alias("id")))
    return _ski_area(raw, F.col("geometry"), F.nullif(p("name"), F.lit("")), source, p("activities"), p("status"), _websites(p("official_website")), _null("string"), convention(F.col("geometry")))


def format_ski_areas(kind: str, raw: DataFrame) -> DataFrame:
    """F11."""
    return {"landuse": format_landuse, "site": format_sites, "second": format_second_source}[kind](raw)


SPOT = "struct<spotType:string,dismount:string,name:string,liftId:string,position:string,entry:boolean,exit:boolean>"


def spots_of(t: Column) -> Column:
    """All spots that a set of tags makes."""
    def spot(kind: str, **own: Column) -> Column:
        fields = {"dismount": _null("string"), "name": _null("string"), "liftId": _null("string"), "position": _null("string"), "entry": _null("boolean"), "exit": _null("boolean")} | own
        return F.struct(F.lit(kind).alias("spotType"), *(v.alias(k) for k, v in fields.items())).cast(SPOT)

    dismount, station, access = tag(t, "piste:dismount"), tag(t, "aerialway:station"), tag(t, "aerialway:access")
    transceiver = lambda v: (tag(t, "amenity") == "avalanche_transceiver") & (tag(t, "avalanche_transceiver") == v)
    entry = F.when(access.isin("both", "entry"), True).when(access.isin("exit", "no"), False)
    leave = F.when(access.isin("both", "exit"), True).when(access.isin("entry", "no"), False)
    return F.array_compact(
        F.array(
            F.when(dismount.isin("yes", "no", "sometimes"), spot("crossing", dismount=dismount)),
            F.when(tag(t, "aerialway") == "station", spot("lift_station", name=tags.name(t, "name"), liftId=F.lit(""), position=F.when(station.isin("top", "mid", "bottom"), station), entry=entry, exit=leave)),
            F.when(transceiver("training"), spot("avalanche_transceiver_training")),
            F.when(transceiver("checkpoint"), spot("avalanche_transceiver_checkpoint")),
            F.when(tag(t, "man_made") == "piste:halfpipe", spot("halfpipe")),
        )
    )


def format_spots(raw: DataFrame) -> DataFrame:
    """F16: any geometry at its centroid, 0 to 5 spots."""
    t = F.coalesce(F.col("properties.tags"), F.create_map().cast("map<string,string>"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.array(geo.centroid(F.col("geometry")))).alias("parts"), F.array(F.lit(0)).alias("poly"))
    # The names of a struct's fields can get lost beside a generator, so that comes after it.
    each = raw.select(point.alias("geometry"), _osm_source().alias("sources"), spots_of(t).alias("__spots")).select("geometry", "sources", F.explode("__spots").alias("s"))
    return each.select(ids.feature_id("spot", F.col("geometry")).alias("id"), "geometry", F.lit("spot").alias("type"), "s.*", _none("string").alias("skiAreas"), "sources", _none(PLACE).alias("places"), geo.viewport_hint(F.col("geometry")).alias("viewportHint"))


#: What enrichment and clustering add to a layer's own properties.
_ADDED = {"run": "elevationProfile struct<heights:array<double>,resolution:double,targetResolution:double>", "spot": "stationLift string, stationPosition string"}


def layer_schema(spark: SparkSession, kind: str) -> T.StructType:
    """The properties that a clustered object of a layer can have, as a schema to read them with."""
    raw = spark.createDataFrame([], f"geometry {geo.GEOMETRY}, properties struct<type:string,id:bigint,tags:map<string,string>>")
    made = {"run": format_runs, "lift": format_lifts, "spot": format_spots}[kind](raw).drop("geometry")
    return T.StructType([*made.schema.fields, *(T.StructType.fromDDL(_ADDED[kind]).fields if kind in _ADDED else [])])
