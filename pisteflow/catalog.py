"""Registered queries: the map-data operators on stand-in tables, each with equivalent DuckDB SQL.

The domain layers aren't among the driver's tables, so points, lines, tags and series are derived
from those tables by fixed arithmetic, alike in both engines. Doubles are rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pisteflow.functions import csvtext, geo, ids, reduce, tags
from pisteflow.functions.jsnum import js_round
from pisteflow.operators import algebra, relational, spatial, topology
from pisteflow.operators.graph import connected_components
from pisteflow.plans import clustering, export, formatters, snow, statistics
from pisteflow.plans.lineage import materialize
from pisteflow.sources import geojson, osm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can express it."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(x: Column) -> Column:
    return F.round(x, 6)


# -- tags ----------------------------------------------------------------------------------------

def _order_tags() -> Column:
    """Orders as tagged features: the priority is the lifecycle state, the status the value."""
    p = F.col("o_orderpriority")
    value = F.lower("o_orderstatus")
    return F.map_filter(
        F.create_map(
            F.lit("piste:type"), F.when(p == "1-URGENT", "proposed").when(p == "2-HIGH", F.lit(None).cast("string")).otherwise(value),
            F.lit("proposed"), F.when((p == "1-URGENT") & (F.col("o_orderkey") % 2 == 0), value),
            F.lit("proposed:piste:type"), F.when(p.isin("1-URGENT", "4-NOT SPECIFIED"), "never"),
            F.lit("abandoned:piste:type"), F.when(p == "2-HIGH", F.concat(F.lit("x"), value)),
            F.lit("disused"), F.when(p == "3-MEDIUM", "yes"),
            F.lit("razed"), F.when(p == "5-LOW", "yes"),
        ),
        lambda k, v: v.isNotNull(),
    )


@query(
    "tags_status_value",
    """
    SELECT o_orderkey,
        CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN 'proposed' WHEN '2-HIGH' THEN 'abandoned'
            WHEN '3-MEDIUM' THEN 'disused' ELSE 'operating' END AS status,
        CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN 'x' || lower(o_orderstatus)
            WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderstatus) END ELSE lower(o_orderstatus) END AS value
    FROM orders""",
)
def tags_status_value(spark, d):
    """A prefixed key counts only where the key itself isn't there."""
    s = tags.status_and_value(F.col("t"), "piste:type")
    return table(spark, d, "orders").select("o_orderkey", _order_tags().alias("t")).select("o_orderkey", s["status"].alias("status"), s["value"].alias("value"))


def _part_tags(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    pairs = {"piste:ref": F.when(F.col("p_size") % 3 == 0, F.col("p_brand")), "loc_ref": F.when(F.col("p_size") % 2 == 0, F.col("p_type")), "ref": F.col("p_name"), "lit": F.when(F.col("p_size") % 5 == 0, "yes").when(F.col("p_size") % 5 == 1, "no"), "occupancy": F.when(F.col("p_size") % 4 == 0, F.col("p_size").cast("string")).when(F.col("p_size") % 4 == 1, "").when(F.col("p_size") % 4 == 2, "many")}
    flat = [x for k, v in pairs.items() for x in (F.lit(k), v)]
    return p.select("p_partkey", F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull()).alias("t"))


@query(
    "tags_first_defined",
    """
    SELECT p_partkey,
        coalesce(CASE WHEN p_size % 3 = 0 THEN p_brand END, CASE WHEN p_size % 2 = 0 THEN p_type END, p_name) AS ref,
        CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN false END AS lit,
        CASE p_size % 4 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN 0.0::DOUBLE END AS occupancy
    FROM part""",
)
def tags_first_defined(spark, d):
    """T3-T5, T8, T9."""
    t = F.col("t")
    return _part_tags(spark, d).select("p_partkey", tags.ref(t).alias("ref"), tags.boolean(tags.tag(t, "lit")).alias("lit"), tags.number(tags.tag(t, "occupancy")).alias("occupancy"))


@query(
    "name_ref_prefix_strip",
    """SELECT p_partkey, CASE p_size % 5 WHEN 3 THEN p_brand || '. ' || p_name WHEN 4 THEN p_brand || p_name ELSE p_name END
        || CASE WHEN p_size % 2 = 0 THEN ', ' || p_type ELSE '' END AS name FROM part""",
)
def name_ref_prefix_strip(spark, d):
    """Names of all variants; a leading ref goes with a dash or spaces, but not with a point."""
    n = F.col("p_size") % 5
    between = F.when(n == 0, " - ").when(n == 1, "-").when(n == 2, " ").when(n == 3, ". ").otherwise("")
    t = F.map_filter(F.create_map(F.lit("name"), F.concat("p_brand", between, "p_name"), F.lit("name:xx"), F.when(F.col("p_size") % 2 == 0, F.col("p_type"))), lambda k, v: v.isNotNull())
    return table(spark, d, "part").select("p_partkey", "p_brand", t.alias("t")).select("p_partkey", tags.name(F.col("t"), "name", None, F.col("p_brand")).alias("name"))


@query(
    "multi_value_explode",
    """
    SELECT p_partkey, i - 1 AS pos, u AS use FROM (
        SELECT p_partkey, unnest(l) AS u, generate_subscripts(l, 1) AS i FROM (
            SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN ['downhill', 'nordic'] WHEN 1 THEN ['hike'] ELSE []::VARCHAR[] END AS l FROM part))""",
)
def multi_value_explode(spark, d):
    """Known uses, one row each."""
    v = F.when(F.col("p_size") % 3 == 0, " Downhill; other ;nordic").when(F.col("p_size") % 3 == 1, "hike").otherwise("none")
    return table(spark, d, "part").select("p_partkey", F.posexplode(tags.run_uses(v)).alias("pos", "use"))


@query(
    "grooming_normalise",
    """
    SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'classic+skating' WHEN 1 THEN 'mogul' WHEN 2 THEN 'backcountry' WHEN 3 THEN 'backcountry' END AS grooming,
        CASE WHEN p_size % 5 = 2 THEN 'expert' END AS difficulty, CASE WHEN p_size % 2 = 0 THEN true END AS gladed
    FROM part""",
)
def grooming_normalise(spark, d):
    """F4, F6, F7."""
    n = F.col("p_size") % 5
    pairs = {"piste:grooming": F.when(n == 0, "skating;classic").when(n == 1, "mogul").when(n == 3, "no"), "piste:difficulty": F.when(n == 2, "expert").when(n == 3, "unknown"), "natural": F.when(F.col("p_size") % 2 == 0, "wood")}
    flat = [x for k, v in pairs.items() for x in (F.lit(k), v)]
    t = F.col("t")
    return table(spark, d, "part").select("p_partkey", F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull()).alias("t")).select("p_partkey", tags.grooming(t).alias("grooming"), tags.difficulty(t).alias("difficulty"), tags.gladed(t).alias("gladed"))


@query("duration_parse", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN (p_size * 60)::DOUBLE WHEN 1 THEN (p_size * 60 + 30)::DOUBLE END AS seconds FROM part")
def duration_parse(spark, d):
    """F10, T18."""
    n = F.col("p_size").cast("string")
    v = F.when(F.col("p_size") % 3 == 0, n).when(F.col("p_size") % 3 == 1, F.concat(n, F.lit(":30"))).otherwise("long")
    return table(spark, d, "part").select("p_partkey", tags.duration_seconds(v).alias("seconds"))


def _raw(tags_: dict[str, Column], geometry: Column, df: DataFrame, key: str) -> DataFrame:
    """Raw features of a table's rows."""
    flat = [x for k, v in tags_.items() for x in (F.lit(k), v)]
    made = F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull())
    return df.select(geometry.alias("geometry"), F.struct(F.lit("way").alias("type"), F.col(key).cast("long").alias("id"), made.alias("tags")).alias("properties"))


def _short_line(k: Column) -> Column:
    x, y = (k % 300 - 150).cast("double"), F.floor(k / 300).cast("double")
    return F.struct(F.lit("LineString").alias("type"), F.array(F.array(F.array(x, y), F.array(x, y + 0.01))).alias("parts"), F.array(F.lit(0)).alias("poly"))


def _source_key() -> Column:
    return F.split(F.col("sources")[0]["id"], "/")[1].cast("long")


@query(
    "format_runs",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'downhill,nordic' ELSE 'sled' END AS uses, p_name AS name, CASE WHEN p_size % 4 = 0 THEN p_brand END AS ref, CASE WHEN p_size % 5 = 0 THEN 'easy' END AS difficulty,
        CASE WHEN p_size % 2 = 0 THEN false WHEN p_size % 3 = 0 THEN true END AS oneway, CASE WHEN p_size % 7 = 0 THEN true END AS lit, CASE WHEN p_size % 5 = 1 THEN 'classic' END AS grooming
    FROM part WHERE p_size % 3 <> 1 AND p_size % 11 <> 0""",
)
def format_runs(spark, d):
    """Operating runs of a known use."""
    k = F.col("p_size")
    t = {
        "piste:type": F.when(k % 3 == 0, "downhill; nordic").when(k % 3 == 2, "sled;unknown").otherwise("unknown"), "abandoned": F.when(k % 11 == 0, "yes"), "name": F.when(k % 4 == 0, F.concat("p_brand", F.lit(" - "), "p_name")).otherwise(F.col("p_name")),
        "ref": F.when(k % 4 == 0, F.col("p_brand")), "piste:difficulty": F.when(k % 5 == 0, "easy").when(k % 5 == 2, "strange"), "oneway": F.when(k % 2 == 0, "no"), "lit": F.when(k % 7 == 0, "yes"), "piste:grooming": F.when(k % 5 == 1, "classic"),
    }
    out = formatters.format_runs(_raw(t, _short_line(F.col("p_partkey")), table(spark, d, "part"), "p_partkey"))
    return out.select(_source_key().alias("p_partkey"), F.array_join("uses", ",").alias("uses"), "name", "ref", "difficulty", "oneway", "lit", "grooming")


@query(
    "format_lifts",
    """SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN 'railway' ELSE 'gondola' END AS "liftType", CASE WHEN p_size % 4 = 1 THEN 'disused' ELSE 'operating' END AS status, p_name AS name,
        CASE WHEN p_size % 3 = 0 THEN p_size::DOUBLE END AS occupancy, CASE WHEN p_size % 2 = 0 THEN (p_size * 60 + 30)::DOUBLE END AS duration, CASE WHEN p_size % 13 = 1 THEN 'private' END AS access
    FROM part WHERE p_size % 4 <> 2 AND p_size % 13 <> 0 AND p_size % 17 <> 0""",
)
def format_lifts(spark, d):
    """Lifts that take passengers, by their own key or as railways."""
    k = F.col("p_size")
    t = {
        "aerialway": F.when(k % 4 == 0, "gondola").when(k % 4 == 1, "disused").when(k % 4 == 2, "zip_line"), "disused": F.when(k % 4 == 1, "gondola"), "railway": F.when(k % 4 == 3, "narrow_gauge"), "name": F.col("p_name"),
        "aerialway:occupancy": F.when(k % 3 == 0, k.cast("string")).otherwise("many"), "aerialway:duration": F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(":30"))), "access": F.when(k % 13 == 0, "no").when(k % 13 == 1, "private"), "passenger": F.when(k % 17 == 0, "no"),
    }
    out = formatters.format_lifts(_raw(t, _short_line(F.col("p_partkey")), table(spark, d, "part"), "p_partkey"))
    return out.select(_source_key().alias("p_partkey"), "liftType", "status", "name", "occupancy", "duration", "access")


@query(
    "format_spots",
    """SELECT p_partkey, 'crossing' AS "spotType", 'yes' AS dismount, NULL::VARCHAR AS name, NULL::BOOLEAN AS entry, NULL::BOOLEAN AS "exit" FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, 'lift_station', NULL, p_name, CASE WHEN p_size % 5 = 0 THEN true WHEN p_size % 5 = 1 THEN false END, CASE WHEN p_size % 5 = 0 THEN true WHEN p_size % 5 = 1 THEN true END FROM part WHERE p_size % 3 = 0
    UNION ALL SELECT p_partkey, 'avalanche_transceiver_training', NULL, NULL, NULL, NULL FROM part WHERE p_size % 7 = 0
    UNION ALL SELECT p_partkey, 'avalanche_transceiver_checkpoint', NULL, NULL, NULL, NULL FROM part WHERE p_size % 7 = 1
    UNION ALL SELECT p_partkey, 'halfpipe', NULL, NULL, NULL, NULL FROM part WHERE p_size % 11 = 0""",
)
def format_spots(spark, d):
    """All spots that one feature makes."""
    k = F.col("p_size")
    t = {
        "piste:dismount": F.when(k % 2 == 0, "yes").when(k % 2 == 1, "perhaps"), "aerialway": F.when(k % 3 == 0, "station"), "name": F.col("p_name"), "aerialway:access": F.when(k % 5 == 0, "both").when(k % 5 == 1, "exit"),
        "amenity": F.when((k % 7).isin(0, 1), "avalanche_transceiver"), "avalanche_transceiver": F.when(k % 7 == 0, "training").when(k % 7 == 1, "checkpoint"), "man_made": F.when(k % 11 == 0, "piste:halfpipe"),
    }
    out = formatters.format_spots(_raw(t, _short_line(F.col("p_partkey")), table(spark, d, "part"), "p_partkey"))
    return out.select(_source_key().alias("p_partkey"), "spotType", "dismount", "name", "entry", "exit")


@query(
    "osm_conversion",
    """WITH n AS (SELECT c_custkey AS k, c_custkey // 100 AS way FROM customer WHERE c_custkey % 10 <> 9)
    SELECT 'way' AS type, way AS id, CASE WHEN way % 2 = 0 THEN 'Polygon' ELSE 'LineString' END AS geometry, count(*) + 1 AS n FROM n GROUP BY way HAVING count(*) > 2
    UNION ALL SELECT 'node', c_custkey, 'Point', 1 FROM customer WHERE c_custkey % 10 = 9""",
)
def osm_conversion(spark, d):
    """Ways of their nodes, closed ones as polygons where their tags say so, and lone nodes."""
    k = F.col("c_custkey")
    none = {"nodes": F.lit(None).cast("array<bigint>"), "members": F.lit(None).cast("array<struct<type:string,ref:bigint,role:string>>"), "tags": F.lit(None).cast("map<string,string>")}
    nodes = customers(spark, d).select(F.lit("node").alias("type"), k.alias("id"), F.col("x").alias("lon"), F.col("y").alias("lat"), *(v.alias(c) for c, v in none.items()))
    ring = F.array_sort(F.collect_list(k))
    ways = table(spark, d, "customer").where("c_custkey % 10 <> 9").groupBy(F.floor(k / 100).alias("id")).agg(ring.alias("l")).where("size(l) > 2")
    made = F.when(F.col("id") % 2 == 0, F.create_map(F.lit("landuse"), F.lit("winter_sports"))).otherwise(F.create_map(F.lit("piste:type"), F.lit("nordic")))
    null = F.lit(None).cast("double")
    ways = ways.select(F.lit("way").alias("type"), "id", null.alias("lon"), null.alias("lat"), F.concat("l", F.slice("l", 1, 1)).alias("nodes"), none["members"].alias("members"), made.alias("tags"))
    out = osm.to_features(nodes.union(ways))
    return out.select("properties.type", "properties.id", F.col("geometry.type").alias("geometry"), F.size(geo.positions(F.col("geometry"))).cast("long").alias("n"))


# -- geometry ------------------------------------------------------------------------------------


def _point(x: Column, y: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(x, y))).alias("parts"), F.array(F.lit(0)).alias("poly"))


def _xy(k: str, step: int) -> list[Column]:
    return [((F.col(k) * 7919 % 1000) * 0.001 + 11.0).alias("x"), ((F.col(k) * step % 1000) * 0.001 + 47.0).alias("y")]


#: Customers and suppliers as points in a degree around (11, 47).
_CUSTOMER, _SUPPLIER = ("c_custkey", 104729), ("s_suppkey", 1299709)
_SQL_POINTS = """
    c AS (SELECT c_custkey, (c_custkey * 7919 % 1000) * 0.001::DOUBLE + 11.0::DOUBLE AS x, (c_custkey * 104729 % 1000) * 0.001::DOUBLE + 47.0::DOUBLE AS y FROM customer),
    s AS (SELECT s_suppkey, (s_suppkey * 7919 % 1000) * 0.001::DOUBLE + 11.0::DOUBLE AS x, (s_suppkey * 1299709 % 1000) * 0.001::DOUBLE + 47.0::DOUBLE AS y FROM supplier)"""
#: Distance in the frame of the mean latitude, on the spheroid.
_E2 = "(1 - power(6356752.314245::DOUBLE / 6378137.0::DOUBLE, 2))"
_W = f"(1 - {_E2} * power(sin(radians((c.y + s.y) / 2)), 2))"
_SQL_M = f"""sqrt(power((c.x - s.x) * radians(1) * 6378137.0::DOUBLE / sqrt({_W}) * cos(radians((c.y + s.y) / 2)), 2)
    + power((c.y - s.y) * radians(1) * 6378137.0::DOUBLE * (1 - {_E2}) / power({_W}, 1.5), 2))"""


def customers(spark, d) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", *_xy(*_CUSTOMER))


def suppliers(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", *_xy(*_SUPPLIER))


def _as_points(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.select(F.col(key).alias(out), _point(F.col("x"), F.col("y")).alias("geometry"))


@query(
    "distance_join_haversine",
    f"WITH {_SQL_POINTS}, p AS (SELECT c_custkey, s_suppkey, {_SQL_M} AS m FROM c, s) SELECT c_custkey, s_suppkey, round(m, 6) AS metres FROM p WHERE m <= 2500",
)
def distance_join_haversine(spark, d):
    """Pairs within 2.5 km through the grid."""
    pairs = spatial.within_distance(_as_points(customers(spark, d), "c_custkey", "lkey"), _as_points(suppliers(spark, d), "s_suppkey", "rkey"), 2500.0, decimals=6)
    return pairs.select(F.col("lkey").alias("c_custkey"), F.col("rkey").alias("s_suppkey"), "metres")


@query(
    "nearest_with_tiebreak",
    f"""WITH {_SQL_POINTS}, k AS (SELECT c_custkey, s_suppkey, round({_SQL_M}, 6) AS metres FROM c, s)
    SELECT c_custkey, s_suppkey, metres FROM k WHERE metres <= 20000 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY metres, s_suppkey) = 1""",
)
def nearest_with_tiebreak(spark, d):
    """Nearest within 20 km; ties go to the lower key."""
    best = spatial.nearest(_as_points(customers(spark, d), "c_custkey", "lkey"), _as_points(suppliers(spark, d), "s_suppkey", "rkey"), 20_000.0)
    return best.select(F.col("lkey").alias("c_custkey"), F.col("rkey").alias("s_suppkey"), r6(F.col("metres")).alias("metres"))


@query(
    "line_length_haversine",
    "SELECT l_orderkey, l_linenumber, round(2 * 6371.0088::DOUBLE * (asin(sin(radians(l_linenumber * 0.01::DOUBLE) / 2)) + asin(sin(radians(0.02::DOUBLE) / 2))), 6) AS km FROM lineitem",
)
def line_length_haversine(spark, d):
    """The length of a line of two steps due north."""
    n = F.col("l_linenumber") * 0.01
    line = F.array(F.array(F.lit(11.0), F.lit(0.0)), F.array(F.lit(11.0), n), F.array(F.lit(11.0), n + 0.02))
    g = F.struct(F.lit("LineString").alias("type"), F.array(line).alias("parts"), F.array(F.lit(0)).alias("poly"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r6(geo.weight_km(g)).alias("km"))


def _box(w: Column, s: Column, e: Column, n: Column) -> Column:
    ring = F.array(F.array(w, s), F.array(e, s), F.array(e, n), F.array(w, n), F.array(w, s))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("parts"), F.array(F.lit(0)).alias("poly"))


def _nation_boxes(spark, d) -> DataFrame:
    """Nations as 25 boxes of 0.2 degrees; no point lies on an edge."""
    n = F.col("n_nationkey")
    w, s = F.lit(11.0005) + (n % 5) * 0.2, F.lit(47.0005) + F.floor(n / 5) * 0.2
    return table(spark, d, "nation").select("n_nationkey", _box(w, s, w + 0.2, s + 0.2).alias("geometry"))


_SQL_BOXES = "b AS (SELECT n_nationkey, 11.0005::DOUBLE + (n_nationkey % 5) * 0.2::DOUBLE AS w, 47.0005::DOUBLE + (n_nationkey // 5) * 0.2::DOUBLE AS s FROM nation)"


@query(
    "bbox_contains",
    f"WITH {_SQL_POINTS}, {_SQL_BOXES} SELECT n_nationkey, count(*) AS n FROM c JOIN b ON c.x > b.w AND c.x < b.w + 0.2 AND c.y > b.s AND c.y < b.s + 0.2 GROUP BY n_nationkey",
)
def bbox_contains(spark, d):
    """Points that polygons hold."""
    inside = spatial.contained(_nation_boxes(spark, d).withColumnRenamed("n_nationkey", "lkey"), _as_points(customers(spark, d), "c_custkey", "rkey"))
    return inside.groupBy(F.col("lkey").alias("n_nationkey")).agg(F.count("*").alias("n"))


@query("bbox_filter", f"WITH {_SQL_POINTS} SELECT c_custkey FROM c WHERE x > 11.2 AND x < 11.7005 AND y > 47.1005 AND y < 47.6")
def bbox_filter(spark, d):
    """What lies wholly in a box, whose edges are outside."""
    return geojson.inside_bbox(_as_points(customers(spark, d), "c_custkey", "c_custkey"), 11.2, 47.1005, 11.7005, 47.6).select("c_custkey")


@query(
    "pixels_of_points",
    f"""WITH {_SQL_POINTS}, m AS (SELECT c_custkey, 6371007.181::DOUBLE * radians(x) * cos(radians(y)) + 20015109.354::DOUBLE AS gx, 10007554.677::DOUBLE - 6371007.181::DOUBLE * radians(y) AS gy FROM c),
    t AS (SELECT *, floor(gx / 1111950.519667::DOUBLE) AS h, floor(gy / 1111950.519667::DOUBLE) AS v FROM m)
    SELECT c_custkey, printf('h%02dv%02d', h::INTEGER, v::INTEGER) AS tile, least(floor((gy - v * 1111950.519667::DOUBLE) / 375), 2999)::INTEGER AS row_index, least(floor((gx - h * 1111950.519667::DOUBLE) / 375), 2999)::INTEGER AS col_index FROM t""",
)
def pixels_of_points(spark, d):
    """The satellite pixels that geometries meet."""
    px = snow.run_pixels(_as_points(customers(spark, d), "c_custkey", "c_custkey"), "c_custkey")
    return px.select("c_custkey", "tile", F.col("row").alias("row_index"), F.col("col").alias("col_index"))


def _id_sql() -> str:
    """The canonical text around a point's coordinates, as literals."""
    mark = "\0"
    inner = ids._object([("coordinates", mark), ("type", "string:5:Point")], first=False)
    outer = ids._object([("geometry", inner), ("properties", ids._object([("type", "string:3:run")], first=False)), ("type", "string:7:Feature")], first=True)
    head, tail = outer.split(mark)
    return f"SELECT c_custkey, sha1('{head}array:2:number:' || c_custkey || 'number:47' || '{tail}') AS feature_id FROM customer"


@query("feature_id_sha1", _id_sql())
def feature_id_sha1(spark, d):
    """F22."""
    return table(spark, d, "customer").select("c_custkey", ids.feature_id("run", _point(F.col("c_custkey").cast("double"), F.lit(47.0))).alias("feature_id"))


@query(
    "web_mercator_tile",
    f"""WITH {_SQL_POINTS}, t AS (SELECT c_custkey, (x / 360 + 0.5) * 1024 AS tx, (0.5 - ln((1 + sin(radians(y))) / (1 - sin(radians(y)))) / (4 * pi())) * 1024 AS ty FROM c)
    SELECT c_custkey, floor(tx)::INTEGER AS x, floor(ty)::INTEGER AS y, round((tx - floor(tx)) * 256, 6) AS px, round((ty - floor(ty)) * 256, 6) AS py FROM t""",
)
def web_mercator_tile(spark, d):
    """E6."""
    return customers(spark, d).select("c_custkey", geo.tile_pixel(F.col("x"), F.col("y"), 10, 256).alias("t")).select("c_custkey", "t.x", "t.y", r6(F.col("t.px")).alias("px"), r6(F.col("t.py")).alias("py"))


@query(
    "bilinear",
    f"""WITH {_SQL_POINTS}, w AS (SELECT c_custkey, x - floor(x) AS dx, y - floor(y) AS dy, c_custkey % 97 AS v FROM c)
    SELECT c_custkey, round(v * (1 - dx) * (1 - dy) + (v + 1) * dx * (1 - dy) + (v + 2) * (1 - dx) * dy + (v + 3) * dx * dy, 6) AS value,
        round(-10000 + (v * 65536 + 3 * 256 + 7) * 0.1::DOUBLE, 6) AS mapbox, round(v * 256 + 3 + 7 / 256 - 32768, 6) AS terrarium FROM w""",
)
def bilinear(spark, d):
    """E8."""
    v = (F.col("c_custkey") % 97).cast("double")
    dx, dy = F.col("x") - F.floor("x"), F.col("y") - F.floor("y")
    return customers(spark, d).select("c_custkey", r6(geo.bilinear(v, v + 1, v + 2, v + 3, dx, dy)).alias("value"), r6(geo.decode_mapbox(v, F.lit(3.0), F.lit(7.0))).alias("mapbox"), r6(geo.decode_terrarium(v, F.lit(3.0), F.lit(7.0))).alias("terrarium"))


@query(
    "sinusoidal_pixel",
    f"""WITH {_SQL_POINTS}, m AS (SELECT c_custkey, 6371007.181::DOUBLE * radians(x) * cos(radians(y)) + 20015109.354::DOUBLE AS gx, 10007554.677::DOUBLE - 6371007.181::DOUBLE * radians(y) AS gy FROM c),
    t AS (SELECT *, floor(gx / 1111950.519667::DOUBLE) AS h, floor(gy / 1111950.519667::DOUBLE) AS v FROM m)
    SELECT c_custkey, h::INTEGER AS h, v::INTEGER AS v, least(floor((gy - v * 1111950.519667::DOUBLE) / 375), 2999)::INTEGER AS row_index, least(floor((gx - h * 1111950.519667::DOUBLE) / 375), 2999)::INTEGER AS col_index FROM t""",
)
def sinusoidal_pixel(spark, d):
    """V1, V3."""
    s = geo.sinusoidal(F.col("x"), F.col("y"))
    return customers(spark, d).select("c_custkey", s.alias("s")).select("c_custkey", geo.grid_pixel(F.col("s.x"), F.col("s.y")).alias("g")).select("c_custkey", "g.h", "g.v", F.col("g.row").alias("row_index"), F.col("g.col").alias("col_index"))


@query(
    "geohash_bits",
    f"""WITH {_SQL_POINTS}, b AS (SELECT c_custkey, floor((x + 180) / 360 * 32768)::BIGINT AS i, floor((y + 90) / 180 * 32768)::BIGINT AS j FROM c),
    g AS (SELECT c_custkey, unnest(range(0, 6)) AS k, i, j FROM b),
    v AS (SELECT c_custkey, k, (SELECT sum(((CASE WHEN (k * 5 + o) % 2 = 0 THEN i >> (14 - (k * 5 + o) // 2) ELSE j >> (14 - (k * 5 + o) // 2) END) & 1) << (4 - o)) FROM range(0, 5) t(o)) AS d FROM g)
    SELECT c_custkey, string_agg(substr('0123456789bcdefghjkmnpqrstuvwxyz', d::INTEGER + 1, 1), '' ORDER BY k) AS geohash FROM v GROUP BY c_custkey""",
)
def geohash_bits(spark, d):
    """Key of the place table."""
    return customers(spark, d).select("c_custkey", geo.geohash(F.col("x"), F.col("y"), 6).alias("geohash"))


@query("points_along", "SELECT p_partkey, floor(km)::BIGINT + 1 + (km > floor(km))::BIGINT AS n FROM (SELECT p_partkey, 6371.0088::DOUBLE * radians(0.01::DOUBLE * (p_size + 0.5)) AS km FROM part)")
def points_along(spark, d):
    """A position each kilometre, ends included."""
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array(F.array(F.lit(11.0), F.lit(0.0)), F.array(F.lit(11.0), (F.col("p_size") + 0.5) * 0.01))).alias("parts"), F.array(F.lit(0)).alias("poly"))
    return table(spark, d, "part").select("p_partkey", F.size(geo.points_each_km(line, 1.0)).cast("long").alias("n"))


@query("centroid", f"WITH {_SQL_BOXES} SELECT n_nationkey, round(w + 0.1, 6) AS x, round(s + 0.1, 6) AS y, 'MULTIPOLYGON' AS kind FROM b")
def centroid(spark, d):
    """The mean of a ring's positions, its closing one left out."""
    g = F.col("geometry")
    return _nation_boxes(spark, d).select("n_nationkey", r6(geo.centroid(g)[0]).alias("x"), r6(geo.centroid(g)[1]).alias("y"), geo.type_name(g).alias("kind"))


# -- joins and nesting ---------------------------------------------------------------------------


@query(
    "summary_nesting",
    """SELECT l_orderkey, count(DISTINCT l_suppkey) FILTER (l_suppkey % 5 <> 0) AS n,
        coalesce(string_agg(DISTINCT 's' || lpad(l_suppkey::VARCHAR, 6, '0') || ':Supplier#' || lpad(l_suppkey::VARCHAR, 9, '0') || ':operating', ';' ORDER BY 's' || lpad(l_suppkey::VARCHAR, 6, '0') || ':Supplier#' || lpad(l_suppkey::VARCHAR, 9, '0') || ':operating')
            FILTER (l_suppkey % 5 <> 0), '') AS areas FROM lineitem GROUP BY l_orderkey""",
)
def summary_nesting(spark, d):
    """Summaries of an object's areas in key order; unknown areas are left out."""
    own = F.concat(F.lit("s"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    objects = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.collect_set(own).alias("ski_areas"))
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
    areas = table(spark, d, "supplier").where("s_suppkey % 5 <> 0").select(F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("key"), name.alias("name"), F.array(F.lit("downhill")).alias("activities"), F.lit("operating").alias("status"), _point(F.lit(11.0), F.lit(47.0)).alias("geometry")).withColumn("id", F.col("key"))
    nested = relational.nest_summaries(objects, areas, algebra.summary())
    text = F.transform("skiAreas", lambda a: F.concat_ws(":", a["properties"]["id"], a["properties"]["name"], a["properties"]["status"]))
    return nested.select(F.col("key").alias("l_orderkey"), F.size("skiAreas").cast("long").alias("n"), F.array_join(text, ";").alias("areas"))


@query(
    "station_nesting",
    "SELECT o_custkey, count(*) FILTER (o_orderkey % 3 <> 0) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_totalprice DESC, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS stations FROM orders GROUP BY o_custkey",
)
def station_nesting(spark, d):
    """Stations of a lift in the order of its list; unknown ones are left out."""
    o = table(spark, d, "orders")
    order = F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), F.col("o_orderkey").alias("k"))))
    lifts = o.groupBy(F.col("o_custkey").alias("key")).agg(F.transform(order, lambda x: x["k"]).alias("station_ids"))
    nested = relational.nest_stations(lifts, o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("key")), F.col("key").cast("string"))
    return nested.select(F.col("key").alias("o_custkey"), F.coalesce(F.size("stations"), F.lit(0)).cast("long").alias("n"), F.array_join("stations", ",").alias("stations"))


@query(
    "site_membership_join",
    "SELECT o_orderkey, string_agg(DISTINCT 's' || lpad(l_suppkey::VARCHAR, 6, '0'), ',' ORDER BY 's' || lpad(l_suppkey::VARCHAR, 6, '0')) AS sites FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
)
def site_membership_join(spark, d):
    """Sites listing a feature's source, by explode and equi-join."""
    features = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.array(F.struct(F.lit("openstreetmap").alias("type"), F.concat(F.lit("way/"), F.col("o_orderkey").cast("string")).alias("id"))).alias("sources"), F.array().cast("array<string>").alias("skiAreas"))
    members = table(spark, d, "lineitem").select(F.concat(F.lit("way/"), F.col("l_orderkey").cast("string")).alias("member"), F.concat(F.lit("s"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("site")).distinct()
    out = relational.attach_sites(features, members)
    return out.where(F.size("skiAreas") > 0).select(F.col("id").cast("long").alias("o_orderkey"), F.array_join("skiAreas", ",").alias("sites"))


@query("anti_unassigned", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_unassigned(spark, d):
    """J11."""
    return relational.without(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("eligible_objects", "SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 1 AND c_custkey % 2 = 0")
def eligible_objects(spark, d):
    """Objects that share an activity and are in no area."""
    k = F.col("c_custkey")
    acts = F.when(k % 3 == 0, F.array(F.lit("downhill"))).when(k % 3 == 1, F.array(F.lit("nordic"))).otherwise(F.array(F.lit("nordic"), F.lit("downhill")))
    areas = F.when(k % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a")))
    return relational.eligible(table(spark, d, "customer").select("c_custkey", acts.alias("activities"), areas.alias("ski_areas")), F.array(F.lit("downhill")), unassigned_only=True).select("c_custkey")


@query("semi_ids", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_ids(spark, d):
    """S15, S16."""
    wanted = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return geojson.by_ids(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), wanted, "c_custkey")


def _chains(spark, d) -> DataFrame:
    """Edges of order numbers: chains of up to 100 that lack some links."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    return o.where("k % 100 <> 0 and k % 7 <> 0").select(F.col("k").alias("src"), (F.col("k") + 1).alias("dst"))


_SQL_CHAINS = """e AS (SELECT o_orderkey AS a, o_orderkey + 1 AS b FROM orders WHERE o_orderkey % 100 <> 0 AND o_orderkey % 7 <> 0),
    n AS (SELECT a AS k FROM e UNION SELECT b FROM e),
    g AS (SELECT k, sum(CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.b = n.k) THEN 0 ELSE 1 END) OVER (ORDER BY k) AS i FROM n),
    p AS (SELECT k AS node, min(k) OVER (PARTITION BY i) AS component FROM g)"""


@query("connected_components", f"WITH {_SQL_CHAINS} SELECT node, component FROM p")
def connected_components_query(spark, d):
    """Components of the proximity graph."""
    return connected_components(_chains(spark, d)).select("node", "component")


# Customers as objects along parallels, 304 m apart at 47 degrees and 257 m at most northern 54.45, a hundred in a
# row; every seventh is missing, so that what is left falls into chains. Every tenth place has a ski area 111 m to
# the north. Rows go north by 0.05 degrees; after 150 they go on half a degree further east, and once round the
# world 0.01 degrees north of the first ones, so that gaps stay wider than the search up to 54 million customers.
_SQL_ROWS = """o AS (SELECT c_custkey AS k, 'o' || lpad(c_custkey::VARCHAR, 9, '0') AS key FROM customer WHERE c_custkey % 7 <> 0),
    g AS (SELECT k, key, sum(CASE WHEN EXISTS (SELECT 1 FROM o p WHERE p.k = o.k - 1 AND p.k // 100 = o.k // 100) THEN 0 ELSE 1 END) OVER (ORDER BY k) AS part FROM o)"""


def _rows_of_objects(spark, d, kind: Column, areas: bool) -> DataFrame:
    k = F.col("c_custkey")
    text = lambda mark: F.concat(F.lit(mark), F.lpad(k.cast("string"), 9, "0"))
    row = F.floor(k / 100)
    column = F.floor(row / 150)
    east = F.lit(11.0) + column % 720 * 0.5
    x = F.when(east < 180, east).otherwise(east - 360) + (k % 100) * 0.004
    y = F.lit(47.0) + row % 150 * 0.05 + F.floor(column / 720) * 0.01
    null = lambda t: F.lit(None).cast(t)
    none = F.array().cast("array<string>")

    def rows(df: DataFrame, key: Column, kind: Column, geometry: Column, basis: Column) -> DataFrame:
        own = {
            "key": key, "type": kind, "source": F.lit("openstreetmap"), "geometry": geometry, "is_polygon": F.lit(False), "activities": F.array(F.lit("downhill")), "ski_areas": none,
            "is_basis": basis, "in_polygon": F.lit(False), "in_site": F.lit(False), "station_ids": none, "websites": none, "snowmaking": null("boolean"), "snowfarming": null("boolean"),
            "sources": F.array().cast(f"array<{formatters.SOURCE}>"), "places": F.array().cast(f"array<{formatters.PLACE}>"), "viewportHint": geo.viewport_hint(geometry),
        }
        return df.select(*(own.get(c, null("string")).alias(c) for c in clustering.COLUMNS))

    c = table(spark, d, "customer")
    out = rows(c.where("c_custkey % 7 <> 0"), text("o"), kind, _point(x, y), kind == "run")
    if areas:
        out = out.union(rows(c.where("c_custkey % 10 = 5"), text("a"), F.lit("skiArea"), _point(x, y + 0.001), F.lit(False)))
    return out


@query(
    "greedy_assign_min_key",
    f"""WITH {_SQL_ROWS}, r AS (SELECT part, min('a' || lpad(a.c_custkey::VARCHAR, 9, '0')) AS area FROM customer a JOIN g ON abs(g.k - a.c_custkey) <= 1 AND g.k // 100 = a.c_custkey // 100 WHERE a.c_custkey % 10 = 5 GROUP BY part)
    SELECT area, key FROM r JOIN g USING (part)""",
)
def greedy_assign_min_key(spark, d):
    """In key order, areas take what they reach within 500 m, and all that goes on from there."""
    objects = _rows_of_objects(spark, d, F.lit("lift"), areas=True)
    out = clustering.assign_greedily(objects, "openstreetmap", None)
    return out.where("type <> 'skiArea'").select(F.explode("ski_areas").alias("area"), "key")


@query(
    "generated_areas",
    f"""WITH {_SQL_ROWS}, a AS (SELECT part, sha1(string_agg(key, '|' ORDER BY key)) AS area FROM g GROUP BY part HAVING bool_or(k % 5 = 0) AND bool_or(k % 5 <> 0))
    SELECT area, key FROM a JOIN g USING (part)""",
)
def generated_areas(spark, d):
    """Areas for runs that are in none; downhill needs a lift."""
    objects = _rows_of_objects(spark, d, F.when(F.col("c_custkey") % 5 == 0, "lift").otherwise("run"), areas=False)
    edges = materialize(clustering._graph(objects, clustering.NEAR_M), "near")
    out = clustering.pass_f(objects, edges)
    return out.where("type <> 'skiArea'").select(F.explode("ski_areas").alias("area"), "key")


@query(
    "removal_ratio_rule",
    f"""WITH {_SQL_POINTS}, {_SQL_BOXES}, l AS (SELECT c_custkey AS k, x, y, 0.01 * (1 + (c_custkey * 37 % 101) / 100::DOUBLE) AS h, c_custkey % 11 < 3 + c_custkey % 7 AS site FROM c),
    i AS (SELECT n_nationkey, k, h, site FROM l JOIN b ON x > w AND x < w + 0.2 AND y > b.s AND y + h < b.s + 0.2),
    n AS (SELECT n_nationkey FROM i GROUP BY n_nationkey HAVING sum(CASE WHEN site THEN h ELSE 0 END) / sum(h) <= 0.5)
    SELECT 'n' || n_nationkey AS area, 'c' || k AS key FROM i JOIN n USING (n_nationkey)""",
)
def removal_ratio_rule(spark, d):
    """Polygons take what they hold; those mostly of objects of sites go."""
    k = F.col("c_custkey")
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array(F.array("x", "y"), F.array(F.col("x"), F.col("y") + F.lit(0.01) * (1 + (k * 37 % 101) / 100)))).alias("parts"), F.array(F.lit(0)).alias("poly"))
    base = _rows_of_objects(spark, d, F.lit("run"), areas=False).limit(0)
    null = {f.name: F.lit(None).cast(f.dataType) for f in base.schema.fields}
    site = k % 11 < 3 + k % 7
    own = {"activities": F.array(F.lit("downhill")), "in_polygon": F.lit(False), "is_basis": F.lit(False), "station_ids": F.array().cast("array<string>"), "source": F.lit("openstreetmap")}
    runs = {"key": F.concat(F.lit("c"), k.cast("string")), "type": F.lit("run"), "geometry": line, "is_polygon": F.lit(False), "in_site": site, "ski_areas": F.when(site, F.array(F.lit("site"))).otherwise(F.array().cast("array<string>"))}
    boxes = {"key": F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), "type": F.lit("skiArea"), "geometry": F.col("geometry"), "is_polygon": F.lit(True), "in_site": F.lit(False), "ski_areas": F.array().cast("array<string>")}
    shaped = lambda df, c: df.select(*({**null, **own, **c}[n].alias(n) for n in clustering.COLUMNS))
    out = clustering.pass_b(shaped(customers(spark, d), runs).union(shaped(_nation_boxes(spark, d), boxes)))
    return out.where("type = 'run'").select(F.explode("ski_areas").alias("area"), "key").where("area <> 'site'")


# -- reducers ------------------------------------------------------------------------------------

@query(
    "priority_reduce",
    "SELECT o_custkey, arg_min(v, r) FILTER (r IS NOT NULL) AS difficulty FROM (SELECT o_custkey, ['easy', 'novice', 'expert', 'intermediate', NULL][o_orderpriority[1]::INTEGER] AS v, [2, 1, 5, 3, NULL][o_orderpriority[1]::INTEGER] AS r FROM orders) GROUP BY o_custkey",
)
def priority_reduce(spark, d):
    """A8, A9."""
    level = F.get(F.array(*map(F.lit, ("easy", "novice", "expert", "intermediate", "none"))), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    return table(spark, d, "orders").groupBy("o_custkey").agg(reduce.priority_agg(F.when(level != "none", level), "difficulty").alias("difficulty"))


@query("unique_join", "SELECT l_orderkey, string_agg(DISTINCT l_returnflag || l_linestatus, ', ' ORDER BY l_returnflag || l_linestatus) AS modes FROM lineitem GROUP BY l_orderkey")
def unique_join(spark, d):
    """A11-A16."""
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.concat("l_returnflag", "l_linestatus"))).alias("m"))
    return per.select("l_orderkey", reduce.unique_joined(F.col("m")).alias("modes"))


@query("oneway_and", "SELECT l_orderkey, bool_and(CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END) AS oneway FROM lineitem GROUP BY l_orderkey")
def oneway_and(spark, d):
    """A10: true only if all known values are."""
    v = F.when(F.col("l_returnflag") == "N", True).when(F.col("l_returnflag") == "R", False)
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(v.alias("v"))).alias("v"))
    return per.select("l_orderkey", reduce.oneway(F.transform("v", lambda x: x["v"])).alias("oneway"))


@query(
    "status_priority",
    "SELECT o_custkey, arg_min(v, r) AS status FROM (SELECT o_custkey, ['proposed', 'abandoned', 'construction', 'planned', 'disused'][o_orderpriority[1]::INTEGER] AS v, [4, 6, 2, 3, 5][o_orderpriority[1]::INTEGER] AS r FROM orders) GROUP BY o_custkey",
)
def status_priority(spark, d):
    """Of several states the most present one."""
    state = F.get(F.array(*map(F.lit, ("proposed", "abandoned", "construction", "planned", "disused"))), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    per = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(state).alias("s"))
    return per.select("o_custkey", reduce.priority(F.col("s"), "status").alias("status"))


@query(
    "unique_sources",
    """WITH l AS (SELECT l_orderkey, l_returnflag AS t, l_linestatus AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) AS i FROM lineitem),
    f AS (SELECT l_orderkey, t || '/' || d AS s, min(i) AS i FROM l GROUP BY 1, 2),
    m AS (SELECT l_orderkey, v, min(i) AS i FROM (SELECT l_orderkey, t AS v, i FROM l UNION ALL SELECT l_orderkey, d, 1000 + i FROM l) GROUP BY 1, 2),
    n AS (SELECT l_orderkey, string_agg(v, ',' ORDER BY i) AS merged FROM m GROUP BY 1)
    SELECT l_orderkey, string_agg(s, ',' ORDER BY i) AS sources, any_value(merged) AS merged FROM f JOIN n USING (l_orderkey) GROUP BY l_orderkey""",
)
def unique_sources(spark, d):
    """The first of each source, and all values of two lists, first seen first."""
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("id"))))
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(rows.alias("s"))
    text = F.array_join(F.transform(reduce.unique_sources(F.col("s")), lambda x: F.concat_ws("/", x["type"], x["id"])), ",")
    merged = reduce.merged_unique(F.transform("s", lambda x: x["type"]), F.transform("s", lambda x: x["id"]))
    return per.select("l_orderkey", text.alias("sources"), F.array_join(merged, ",").alias("merged"))


@query("sorted_places", "SELECT r_regionkey, string_agg(n_name, ';' ORDER BY n_name) AS places FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey")
def sorted_places(spark, d):
    """Places once each, sorted by country."""
    en = F.struct(F.col("n_name").alias("country"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("locality"))
    place = F.struct(F.concat(F.lit("X"), F.col("n_nationkey").cast("string")).alias("iso3166_1Alpha2"), F.lit(None).cast("string").alias("iso3166_2"), F.struct(en.alias("en")).alias("localized"))
    twice = table(spark, d, "nation").withColumn("twice", F.explode(F.array(F.lit(0), F.lit(1))))
    per = twice.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list(place).alias("p"))
    names = F.transform(reduce.sorted_places(reduce.unique_places(F.col("p"))), lambda p: p["localized"]["en"]["country"])
    return per.select("r_regionkey", F.array_join(names, ";").alias("places"))


@query(
    "served_elevations",
    """SELECT p_partkey, least(nullif(p_size % 7 * 100, 0), nullif(p_size % 5 * 120, 0))::DOUBLE AS most, greatest(nullif(p_size % 7 * 10, 0), nullif(p_size % 5 * 12, 0))::DOUBLE AS least FROM part""",
)
def served_elevations(spark, d):
    """The lower of both maxima and the higher of both minima; a missing side yields the other."""
    m = lambda n, f: (F.col("p_size") % n * f).cast("double")
    return table(spark, d, "part").select("p_partkey", reduce.served_max(m(7, 100), m(5, 120)).alias("most"), reduce.served_min(m(7, 10), m(5, 12)).alias("least"))


def _line_runs(spark, d, lift_type: Column | None = None) -> DataFrame:
    """Line items as runs of two positions; quantity and discount make the elevations."""
    x, y = (F.col("l_partkey") % 360 - 180).cast("double"), (F.col("l_suppkey") % 120 - 60).cast("double")
    z0, z1 = F.col("l_quantity") * 10, F.col("l_linenumber") * 100.0
    geometry = F.struct(F.lit("LineString").alias("type"), F.array(F.array(F.array(x, y, z0), F.array(x, y + 0.01, z1))).alias("parts"), F.array(F.lit(0)).alias("poly"))
    return table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("ski_area"), geometry.alias("geometry"), F.when(F.col("l_returnflag") == "N", F.array(F.lit("nordic"))).when(F.col("l_returnflag") == "R", F.array(F.lit("downhill"), F.lit("nordic"))).otherwise(F.array(F.lit("downhill"))).alias("activities"), F.when(F.col("l_linestatus") == "F", "easy").alias("difficulty"), (F.col("l_tax") > 0.04).alias("snowmaking"), F.lit(None).cast("boolean").alias("snowfarming"), F.lit("run").alias("type"), (F.lit(None).cast("string") if lift_type is None else lift_type).alias("lift_type"), F.col("l_linenumber").alias("n"))


@query(
    "nested_statistics",
    """
    WITH l AS (SELECT l_suppkey::VARCHAR AS ski_area, unnest(CASE l_returnflag WHEN 'N' THEN ['nordic'] WHEN 'R' THEN ['downhill', 'nordic'] ELSE ['downhill'] END) AS activity,
            CASE WHEN l_linestatus = 'F' THEN 'easy' ELSE 'other' END AS difficulty, l_quantity * 10 AS z0, l_linenumber * 100.0::DOUBLE AS z1, l_tax > 0.04 AS snowmaking,
            2 * 6371.0088::DOUBLE * asin(sin(radians(0.01::DOUBLE) / 2)) AS km FROM lineitem)
    SELECT ski_area, activity, difficulty, count(*) AS "count", round(sum(km), 6) AS "lengthInKm", min(nullif(least(z0, z1), 0)) AS "minElevation", max(nullif(greatest(z0, z1), 0)) AS "maxElevation",
        round(sum(abs(nullif(z1 - z0, 0))), 6) AS "combinedElevationChange", round(sum(CASE WHEN snowmaking THEN km ELSE 0 END), 6) AS "snowmakingLengthInKm"
    FROM l GROUP BY ALL""",
)
def nested_statistics(spark, d):
    """A1-A5: sums by area, activity and difficulty; zero elevations count as missing."""
    s = statistics.run_statistics(_line_runs(spark, d))
    keep = {c: r6(F.col(c)) for c in ("lengthInKm", "combinedElevationChange", "snowmakingLengthInKm")}
    return s.withColumns(keep).select("ski_area", "activity", "difficulty", "count", "lengthInKm", "minElevation", "maxElevation", "combinedElevationChange", "snowmakingLengthInKm")


@query(
    "lift_statistics",
    """
    WITH l AS (SELECT l_suppkey::VARCHAR AS ski_area, CASE WHEN l_linenumber % 2 = 0 THEN 'gondola' ELSE 'other' END AS lift_type, l_quantity * 10 AS z0, l_linenumber * 100.0::DOUBLE AS z1,
            2 * 6371.0088::DOUBLE * asin(sin(radians(0.01::DOUBLE) / 2)) AS km FROM lineitem)
    SELECT ski_area, lift_type, count(*) AS "count", round(sum(km), 6) AS "lengthInKm", min(nullif(least(z0, z1), 0)) AS "minElevation", max(nullif(greatest(z0, z1), 0)) AS "maxElevation",
        round(sum(abs(nullif(z1 - z0, 0))), 6) AS "combinedElevationChange"
    FROM l GROUP BY ALL""",
)
def lift_statistics(spark, d):
    """A3-A5."""
    lifts = _line_runs(spark, d, F.when(F.col("l_linenumber") % 2 == 0, "gondola"))
    return statistics.lift_statistics(lifts).select("ski_area", "lift_type", "count", r6(F.col("lengthInKm")).alias("lengthInKm"), "minElevation", "maxElevation", r6(F.col("combinedElevationChange")).alias("combinedElevationChange"))


@query(
    "area_statistics",
    """
    WITH l AS (SELECT l_suppkey::VARCHAR AS ski_area, l_linenumber % 3 = 0 AS lift, l_quantity * 10 AS z0, l_linenumber * 100.0::DOUBLE AS z1 FROM lineitem),
    s AS (SELECT ski_area, min(least(z0, z1)) FILTER (NOT lift) AS rlo, max(greatest(z0, z1)) FILTER (NOT lift) AS rhi, min(least(z0, z1)) FILTER (lift) AS llo, max(greatest(z0, z1)) FILTER (lift) AS lhi,
        count(*) FILTER (lift) AS lifts FROM l GROUP BY ski_area)
    SELECT ski_area, lifts, greatest(rlo, llo) AS lowest, least(rhi, lhi) AS highest FROM s""",
)
def area_statistics(spark, d):
    """Nested statistics of areas; heights count where lifts and runs share them."""
    rows = _line_runs(spark, d, F.lit("gondola"))
    members = rows.withColumn("type", F.when(F.col("n") % 3 == 0, "lift").otherwise("run"))
    s = F.col("statistics")
    return statistics.ski_area_statistics(members).select("ski_area", export.lift_count(s).alias("lifts"), s["minElevation"].alias("lowest"), s["maxElevation"].alias("highest"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested statistics over clustered synthetic areas: components of line items, then A1."""
    runs = _line_runs(spark, sf_dir)
    edges = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("src"), (F.col("l_suppkey") % 50 - F.col("l_suppkey") % 10).alias("dst"))
    areas = connected_components(edges).select(F.col("node"), F.concat(F.lit("area-"), F.col("component").cast("string")).alias("area"))
    placed = runs.join(areas, (F.col("ski_area").cast("long") % 50) == F.col("node")).withColumn("ski_area", F.col("area"))
    return statistics.run_statistics(placed)


# -- topology ------------------------------------------------------------------------------------


# Customers as lines of one step along parallels, a hundred in a row; every seventh is missing.
def _steps(spark, d, props: Column, turned: Column | None = None) -> DataFrame:
    k = F.col("c_custkey")
    y = F.floor(k / 100).cast("double")
    a, b = F.array((k % 100).cast("double"), y), F.array((k % 100 + 1).cast("double"), y)
    coords = F.array(a, b) if turned is None else F.when(turned, F.array(b, a)).otherwise(F.array(a, b))
    return table(spark, d, "customer").where("c_custkey % 7 <> 0").select(k.alias("ordinal"), coords.alias("coords"), F.to_json(props).alias("props"))


@query(
    "gaps_and_islands",
    f"""WITH {_SQL_ROWS}, n AS (SELECT g.k, c_mktsegment AS name, part, sum(CASE WHEN c_mktsegment = lag THEN 0 ELSE 1 END) OVER (ORDER BY g.k) AS island
        FROM (SELECT g.k, g.part, c_mktsegment, lag(c_mktsegment) OVER (PARTITION BY part ORDER BY g.k) AS lag FROM g JOIN customer ON c_custkey = g.k) g)
    SELECT (k0 // 100)::DOUBLE AS y, (k0 % 100)::DOUBLE AS x, name, n FROM (SELECT min(k) AS k0, any_value(name) AS name, count(*) + 1 AS n FROM n GROUP BY island)""",
)
def gaps_and_islands(spark, d):
    """Adjoining lines of one name become one line."""
    out = topology.normalise_runs(_steps(spark, d, F.struct(F.col("c_mktsegment").alias("name"))))
    first = F.array_min(F.transform("coords", lambda p: p[0]))
    return out.select(F.col("coords")[0][1].alias("y"), first.alias("x"), F.get_json_object("props", "$.name").alias("name"), F.size("coords").cast("long").alias("n"))


@query("endpoint_chain_join", f"WITH {_SQL_ROWS} SELECT (min(k) // 100)::DOUBLE AS y, (min(k) % 100)::DOUBLE AS x, (max(k) % 100 + 1)::DOUBLE AS until, count(*) + 1 AS n FROM g GROUP BY part")
def endpoint_chain_join(spark, d):
    """Lines that begin or end where another ends join, turned round where need be."""
    out = topology.normalise_runs(_steps(spark, d, F.struct(F.lit("x").alias("name")), F.col("c_custkey") % 3 == 0))
    x = F.transform("coords", lambda p: p[0])
    return out.select(F.col("coords")[0][1].alias("y"), F.array_min(x).alias("x"), F.array_max(x).alias("until"), F.size("coords").cast("long").alias("n"))


@query("overlap_merge", "SELECT (c_custkey // 100)::DOUBLE AS y, (c_custkey % 100)::DOUBLE AS x, CASE WHEN c_custkey % 4 = 0 THEN c_name || ', ' || c_mktsegment ELSE c_name END AS name FROM customer WHERE c_custkey % 7 <> 0")
def overlap_merge(spark, d):
    """Lines on one course become one with the names of both."""
    one = _steps(spark, d, F.struct(F.col("c_name").alias("name"))).withColumn("ordinal", F.col("ordinal") * 2)
    two = _steps(spark, d, F.struct(F.col("c_mktsegment").alias("name"))).where("ordinal % 4 = 0").withColumn("ordinal", F.col("ordinal") * 2 + 1)
    out = topology.normalise_runs(one.union(two))
    return out.select(F.col("coords")[0][1].alias("y"), F.array_min(F.transform("coords", lambda p: p[0])).alias("x"), F.get_json_object("props", "$.name").alias("name"))


# -- time series ---------------------------------------------------------------------------------


def _weeks(spark, d) -> DataFrame:
    """Events as weekly pixel values: (tile, row, col, year, week, snow, persistence)."""
    return table(spark, d, "events").select(F.lit("h18v04").alias("tile"), (F.col("user_id") % 50).cast("int").alias("row"), F.lit(0).alias("col"), F.year("ts").alias("year"), (F.floor((F.dayofyear("ts") - 1) / 7) + 1).cast("int").alias("week"), (F.col("event_id") % 120).cast("int").alias("snow"), (F.col("event_id") % 4).cast("int").alias("persistence"))


_SQL_WEEKS = """w AS (SELECT 'h18v04' AS tile, (user_id % 50)::INTEGER AS r, 0 AS c, year(ts) AS y, ((dayofyear(ts) - 1) // 7 + 1)::INTEGER AS week, (event_id % 120)::INTEGER AS snow, (event_id % 4)::INTEGER AS persistence FROM events),
    k AS (SELECT *, make_date(y, 1, 1) + ((week - 1) * 7 - persistence)::INTEGER AS day FROM w WHERE snow <= 100)"""


@query("week_to_day", f"WITH {_SQL_WEEKS} SELECT DISTINCT y AS year, week, persistence, year(day) AS actual_year, dayofyear(day) AS day_of_year FROM k")
def week_to_day(spark, d):
    """V6, V13."""
    date = snow.week_date(F.col("year"), F.col("week"), F.col("persistence"))
    return _weeks(spark, d).where(snow.is_valid(F.col("snow"))).select(F.col("year").cast("long").alias("year"), "week", "persistence", F.year(date).cast("long").alias("actual_year"), F.dayofyear(date).cast("long").alias("day_of_year")).distinct()


@query(
    "missing_weeks",
    """
    WITH p AS (SELECT DISTINCT (user_id % 50)::INTEGER AS r FROM events), d AS (SELECT unnest(generate_series(DATE '2023-11-01', DATE '2024-03-01', INTERVAL 7 DAY))::DATE AS day),
    h AS (SELECT DISTINCT (user_id % 50)::INTEGER AS r, year(ts) AS y, (dayofyear(ts) - 1) // 7 AS w FROM events WHERE event_id % 3 = 0)
    SELECT p.r AS row_index, strftime(day, '%Y-%m-%d') AS day FROM p, d WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.r = p.r AND h.y = year(day) AND h.w = (dayofyear(day) - 1) // 7)""",
)
def missing_weeks(spark, d):
    """Weekly dates that a pixel has no value for."""
    weeks = _weeks(spark, d)
    have = table(spark, d, "events").where("event_id % 3 = 0").select(F.lit("h18v04").alias("tile"), (F.col("user_id") % 50).cast("int").alias("row"), F.lit(0).alias("col"), F.year("ts").alias("year"), (F.floor((F.dayofyear("ts") - 1) / 7) + 1).cast("int").alias("week"), F.lit(1).alias("snow"))
    out = snow.missing_weeks(snow.existing_pixels(weeks), have, "2023-11-01", "2024-03-01")
    return out.select(F.col("row").alias("row_index"), F.date_format("date", "yyyy-MM-dd").alias("day"))


@query(
    "daily_best_measurement",
    f"WITH {_SQL_WEEKS}, b AS (SELECT r, day, min({{'p': persistence, 's': snow}}) AS m FROM k GROUP BY r, day) SELECT r AS row_index, strftime(day, '%Y-%m-%d') AS day, m.s AS snow FROM b",
)
def daily_best_measurement(spark, d):
    """V7: least persistence wins a day (ties here: the lower value)."""
    dated = _weeks(spark, d).where(snow.is_valid(F.col("snow"))).withColumn("date", snow.week_date(F.col("year"), F.col("week"), F.col("persistence")))
    best = dated.groupBy("row", "date").agg(F.min_by("snow", F.struct("persistence", "snow")).alias("snow"))
    return best.select(F.col("row").alias("row_index"), F.date_format("date", "yyyy-MM-dd").alias("day"), "snow")


@query(
    "history_aggregate",
    f"""WITH {_SQL_WEEKS}, b AS (SELECT r, day, min({{'p': persistence, 's': snow}}).s AS s FROM k GROUP BY r, day),
    t AS (SELECT r % 5 AS area, count(DISTINCT r) AS pixels FROM b GROUP BY 1)
    SELECT (b.r % 5)::INTEGER AS area, year(day) AS year, dayofyear(day) AS day, floor(avg(s) + 0.5)::INTEGER AS snow, floor(count(*) * 100 / any_value(pixels) + 0.5)::INTEGER AS valid_percent
    FROM b JOIN t ON t.area = b.r % 5 GROUP BY ALL""",
)
def history_aggregate(spark, d):
    """Daily means of an area's pixels, and the share of pixels measured."""
    dated = _weeks(spark, d).where(snow.is_valid(F.col("snow"))).withColumn("date", snow.week_date(F.col("year"), F.col("week"), F.col("persistence")))
    days = dated.groupBy("tile", "row", "col", "date").agg(F.min_by("snow", F.struct("persistence", "snow")).alias("snow")).select("tile", "row", "col", F.year("date").alias("year"), F.dayofyear("date").alias("day"), "snow")
    areas = snow.existing_pixels(_weeks(spark, d)).withColumn("area", (F.col("row") % 5).cast("int"))
    return snow.history(areas, days, ["area"]).select("area", F.col("year").cast("long").alias("year"), F.col("day").cast("long").alias("day"), "snow", "valid_percent")


@query(
    "snow_statistics",
    f"""WITH {_SQL_WEEKS}, b AS (SELECT r, day, min({{'p': persistence, 's': snow}}).s AS s FROM k GROUP BY r, day),
    m AS (SELECT DISTINCT r, r % 5 AS area, unnest(CASE WHEN r % 3 = 0 THEN ['overall', 'downhill', 'nordic'] WHEN r % 3 = 1 THEN ['overall', 'nordic'] ELSE ['overall', 'other'] END) AS activity FROM b),
    t AS (SELECT area, activity, count(*) AS pixels FROM m GROUP BY ALL)
    SELECT area::VARCHAR AS ski_area, activity, year(day) AS year, dayofyear(day) AS day, floor(avg(s) + 0.5)::INTEGER AS snow, floor(count(*) * 100 / any_value(pixels) + 0.5)::INTEGER AS valid_percent
    FROM b JOIN m USING (r) JOIN t USING (area, activity) GROUP BY ALL""",
)
def snow_statistics(spark, d):
    """Daily means of an area's runs, overall and by activity."""
    dated = _weeks(spark, d).where(snow.is_valid(F.col("snow"))).withColumn("date", snow.week_date(F.col("year"), F.col("week"), F.col("persistence")))
    days = dated.groupBy("tile", "row", "col", "date").agg(F.min_by("snow", F.struct("persistence", "snow")).alias("snow")).select("tile", "row", "col", F.year("date").alias("year"), F.dayofyear("date").alias("day"), "snow")
    r = F.col("row")
    px = snow.existing_pixels(_weeks(spark, d)).withColumn("key", r.cast("string"))
    acts = F.when(r % 3 == 0, F.array(F.lit("downhill"), F.lit("nordic"))).when(r % 3 == 1, F.array(F.lit("nordic"))).otherwise(F.array().cast("array<string>"))
    members = px.select((r % 5).cast("string").alias("ski_area"), "key", acts.alias("activities"))
    out = snow.area_statistics(members, px.select("key", "tile", "row", "col"), days)
    return out.select("ski_area", "activity", F.col("year").cast("long").alias("year"), F.col("day").cast("long").alias("day"), "snow", "valid_percent")


@query(
    "missing_summary",
    """
    WITH p AS (SELECT DISTINCT (user_id % 50)::INTEGER AS r FROM events), d AS (SELECT unnest(generate_series(DATE '2023-11-01', DATE '2024-03-01', INTERVAL 7 DAY))::DATE AS day),
    h AS (SELECT DISTINCT (user_id % 50)::INTEGER AS r, year(ts) AS y, (dayofyear(ts) - 1) // 7 AS w FROM events WHERE event_id % 3 = 0)
    SELECT count(DISTINCT 1) AS tiles, count(DISTINCT p.r) AS pixels, count(*) AS missing_weeks FROM p, d WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.r = p.r AND h.y = year(day) AND h.w = (dayofyear(day) - 1) // 7)""",
)
def missing_summary(spark, d):
    """A19."""
    weeks = _weeks(spark, d)
    return snow.missing_summary(snow.missing_weeks(snow.existing_pixels(weeks), weeks.where("snow is not null").join(table(spark, d, "events").where("event_id % 3 = 0").select((F.col("user_id") % 50).cast("int").alias("row"), F.year("ts").alias("year"), (F.floor((F.dayofyear("ts") - 1) / 7) + 1).cast("int").alias("week")).distinct(), ["row", "year", "week"], "left_semi"), "2023-11-01", "2024-03-01"))


@query("pixels_by_tile", "SELECT 'h18v0' || (user_id % 3)::VARCHAR AS tile, count(DISTINCT user_id % 50) AS n, min(user_id % 50)::INTEGER AS first FROM events GROUP BY 1")
def pixels_by_tile(spark, d):
    """J16."""
    px = table(spark, d, "events").select(F.concat(F.lit("h18v0"), (F.col("user_id") % 3).cast("string")).alias("tile"), (F.col("user_id") % 50).cast("int").alias("row"), F.lit(0).alias("col"))
    return relational.by_tile(px).select("tile", F.size("pixels").cast("long").alias("n"), F.col("pixels")[0]["row"].alias("first"))


@query("codes_left_out", "SELECT c_custkey FROM customer WHERE c_custkey % 5 NOT IN (0, 3)")
def codes_left_out(spark, d):
    """Codes of weeks that may still come go, others stay."""
    code = F.get(F.array(F.lit(snow.MISSING_RECENT), F.lit(snow.MISSING_OLD), F.lit(None).cast("int"), F.lit(snow.FAILED), F.lit(55)), (F.col("c_custkey") % 5).cast("int"))
    return snow.without_codes(table(spark, d, "customer").select("c_custkey", code.alias("snow"))).select("c_custkey")


@query(
    "country_region",
    """SELECT c_custkey, n_name AS country, CASE WHEN c_custkey % 4 IN (1, 2) THEN 'R' || (c_custkey % 4) WHEN c_custkey % 6 IN (1, 2) THEN 'R' || (c_custkey % 6) END AS region_code,
        CASE WHEN c_custkey % 4 IN (1, 2) THEN 'S' || (c_custkey % 4) WHEN c_custkey % 6 IN (1, 2) THEN 'S' || (c_custkey % 6) END AS region
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def country_region(spark, d):
    """Names of country codes, and codes of the state, else of the county."""
    region = lambda n: F.struct(F.lit(f"R{n}").alias("iso"), F.lit(f"S{n}").alias("name"))
    iso = table(spark, d, "nation").select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("iso"), F.col("n_name").alias("name"), F.array(region(1), region(2)).alias("regions"))
    k = F.col("c_custkey")
    places = table(spark, d, "customer").select(k, F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("countrycode"), F.concat(F.lit("S"), (k % 4).cast("string")).alias("state"), F.concat(F.lit("S"), (k % 6).cast("string")).alias("county"))
    return relational.country_and_region(places, iso).select("c_custkey", "country", "region_code", "region")


# -- caches and unions ---------------------------------------------------------------------------


@query(
    "cache_lookup_ttl",
    "SELECT c_custkey, h.event_id IS NOT NULL AS hit, h.value AS value FROM customer LEFT JOIN (SELECT event_id, round(value, 6) AS value FROM events WHERE event_id >= 500) h ON h.event_id = c_custkey",
)
def cache_lookup_ttl(spark, d):
    """Entries past their time are misses; one of just that age is a hit."""
    cache = table(spark, d, "events").select(F.col("event_id").alias("key"), r6(F.col("value")).alias("value"), F.col("event_id").alias("timestamp"))
    return relational.lookup(table(spark, d, "customer").select("c_custkey"), cache, "c_custkey", 1000, 500).select("c_custkey", "hit", "value")


@query("partial_update", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN c_phone ELSE c_mktsegment END AS c_mktsegment FROM (SELECT *, c_name AS c_phone FROM customer)")
def partial_update(spark, d):
    """A matching update replaces a column, also with null."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    new = c.where("c_custkey % 2 = 0 or c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_mktsegment"))
    return relational.update(c.drop("c_name"), new, "c_custkey", ["c_mktsegment"])


@query("union_first_wins", "SELECT c_custkey, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0")
def union_first_wins(spark, d):
    """U3, U4."""
    c = table(spark, d, "customer")
    first, rest = c.where("c_custkey % 3 <> 0").select("c_custkey", F.col("c_mktsegment").alias("v")), c.select("c_custkey", F.col("c_name").alias("v"))
    return relational.union_first_wins([first, rest], ["c_custkey"])


@query("union_all_dirs", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0")
def union_all_dirs(spark, d):
    """U1, U2, P11."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return algebra.merge(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"))


@query(
    "upsert_last_wins",
    """SELECT o_custkey, coalesce(arg_max(o_orderstatus, o_orderkey) FILTER (o_orderkey % 5 = 0), arg_max(o_orderstatus, o_orderkey)) AS status,
        coalesce(max(o_orderkey) FILTER (o_orderkey % 5 = 0), max(o_orderkey)) AS last FROM orders GROUP BY o_custkey""",
)
def upsert_last_wins(spark, d):
    """Updates beat the base whatever their age; among each, the last of a key wins."""
    o = table(spark, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("last"))
    return relational.upsert(o.where("last % 5 <> 0"), o.where("last % 5 = 0"), ["o_custkey"], "last").select("o_custkey", "status", "last")


@query(
    "delete_cascade",
    "SELECT l_orderkey, coalesce(string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) FILTER (l_suppkey % 4 <> 0), '') AS areas FROM lineitem GROUP BY l_orderkey",
)
def delete_cascade(spark, d):
    """Deleted keys leave every list."""
    o = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))).alias("ski_areas"))
    objects = o.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("key"), "ski_areas", "l_orderkey")
    gone = table(spark, d, "supplier").where("s_suppkey % 4 = 0").select(F.col("s_suppkey").cast("string").alias("key"))
    return relational.delete_cascade(objects, gone).select("l_orderkey", F.array_join("ski_areas", ",").alias("areas"))


# -- outputs -------------------------------------------------------------------------------------


@query(
    "csv_escape",
    """SELECT doc_id, CASE WHEN regexp_matches(v, '[,"\\n\\r;]') THEN '"' || replace(v, '"', '""') || '"' ELSE coalesce(v, '') END AS cell FROM (SELECT doc_id, text AS v FROM documents)""",
)
def csv_escape(spark, d):
    """T11."""
    return table(spark, d, "documents").select("doc_id", csvtext.escape(F.col("text")).alias("cell"))


def _area_rows(spark, d) -> DataFrame:
    """Suppliers as ski areas with statistics."""
    k = F.col("s_suppkey")
    levels = F.create_map(F.lit("easy"), F.struct((k * 1.5).alias("lengthInKm")), F.lit("other"), F.struct(F.lit(0.25).alias("lengthInKm")))
    kinds = F.create_map(F.lit("gondola"), F.struct((k % 3).alias("count")), F.lit("t-bar"), F.struct((k % 2).alias("count")))
    stats = F.struct(
        F.struct(F.create_map(F.lit("downhill"), F.struct(levels.alias("byDifficulty"))).alias("byActivity")).alias("runs"), F.struct(kinds.alias("byType")).alias("lifts"),
        (k % 4 * 100).cast("double").alias("minElevation"), (k % 4 * 100 + 350.5).alias("maxElevation"),
    )
    en = lambda c, l: F.struct(F.struct(F.struct(F.lit(c).alias("country"), F.lit(None).cast("string").alias("region"), F.lit(l).cast("string").alias("locality")).alias("en")).alias("localized"))  # noqa: E731, E741
    sources = F.array(F.struct(F.lit("skimap.org").alias("type"), k.cast("string").alias("id")), F.struct(F.lit("openstreetmap").alias("type"), F.concat(F.lit("way/"), k.cast("string")).alias("id")))
    return suppliers(spark, d).select(
        "s_suppkey", F.concat(F.lit("Area, "), k.cast("string")).alias("name"), F.array(en("B", "l"), en("A", None), en("B", "")).alias("places"), F.lit("operating").alias("status"),
        F.when(k % 2 == 0, F.array(F.lit("downhill"))).otherwise(F.array(F.lit("nordic"))).alias("activities"), stats.alias("statistics"), F.lit("europe").alias("runConvention"), F.lit(None).cast("string").alias("wikidataID"),
        F.array(F.lit("z.org"), F.lit("a.org")).alias("websites"), k.cast("string").alias("id"), _point("x", "y").alias("geometry"), sources.alias("sources"),
    )


@query(
    "csv_row",
    f"""WITH {_SQL_POINTS} SELECT s_suppkey, concat_ws(',', '"Area, ' || s_suppkey || '"', '"A;B"', '', 'l', 'operating', CASE WHEN s_suppkey % 2 = 0 THEN 'yes,no' ELSE 'no,yes' END, floor(s_suppkey * 1.5 + 0.25 + 0.5)::BIGINT, '',
        CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '351' END, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE (s_suppkey % 4 * 100)::VARCHAR END, s_suppkey % 4 * 100 + 351,
        coalesce(nullif(s_suppkey % 3 + s_suppkey % 2, 0)::VARCHAR, ''), CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '1' END, 'europe', '', 'a.org z.org', 'https://map.example/?obj=' || s_suppkey, s_suppkey, 'Point', printf('%.6f', y), printf('%.6f', x),
        'https://www.openstreetmap.org/way/' || s_suppkey || ' https://www.skimap.org/SkiAreas/view/' || s_suppkey) AS line FROM s""",
)
def csv_row(spark, d):
    """Lines of ski areas."""
    return _area_rows(spark, d).select("s_suppkey", export.CSV_ROWS["skiArea"]().alias("line"))


@query(
    "map_ski_areas",
    """SELECT '{"id":"' || s_suppkey || '","name":"Area, ' || s_suppkey || '","status":"operating","downhillDistance":' || floor(s_suppkey * 1.5 + 0.25 + 0.5)::BIGINT || ',"nordicDistance":null,"maxElevation":' || (s_suppkey % 4 * 100 + 351)
        || ',"vertical":' || CASE WHEN s_suppkey % 4 = 0 THEN 'null' ELSE '351' END || CASE WHEN s_suppkey % 2 = 0 THEN ',"has_downhill":true}' ELSE ',"has_nordic":true}' END AS properties FROM supplier""",
)
def map_ski_areas(spark, d):
    """F27, F28, F31, G6."""
    return export.map_ski_areas(_area_rows(spark, d)).select("properties")


def _part_layer(spark, d) -> DataFrame:
    """Parts with an area each."""
    area = F.struct(F.concat(F.lit("a"), F.col("p_partkey").cast("string")).alias("id"), F.lit("A").alias("name"))
    null = lambda t: F.lit(None).cast(t)
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.cast("string").alias("id"), F.when(k % 3 != 0, F.col("p_brand")).alias("name"), F.when(k % 2 == 0, F.lit("7")).alias("ref"), F.when(k % 5 == 0, "construction").otherwise("operating").alias("status"), F.lit("gondola").alias("liftType"),
        null("string").alias("access"), F.array(F.lit("s1"), F.lit("s2")).alias("station_ids"), F.array(area).alias("areas"), F.when(k % 7 == 0, True).alias("tunnel"), _point(F.lit(11.0), F.lit(47.0)).alias("geometry"),
        F.when(k % 3 == 0, "crossing").when(k % 3 == 1, "lift_station").otherwise("halfpipe").alias("spotType"), F.lit("sometimes").alias("dismount"), F.lit("l").alias("liftId"), null("string").alias("position"), F.lit(True).alias("entry"), null("boolean").alias("exit"),
    )


@query(
    "map_lifts",
    """SELECT '{"id":"' || p_partkey || '","name_and_type":"' || CASE WHEN p_partkey % 2 = 0 THEN '7 - ' ELSE '' END || CASE WHEN p_partkey % 3 <> 0 THEN p_brand || ' (Gondola)' ELSE 'Gondola' END || '","color":"'
        || CASE WHEN p_partkey % 5 = 0 THEN 'hsl(0, 53%, 42%)","status":"construction' ELSE 'hsl(0, 82%, 42%)","status":"operating' END || '","access":null,"stationIds":["s1","s2"],"skiAreas":["a' || p_partkey || '"],"tunnel":'
        || CASE WHEN p_partkey % 7 = 0 THEN 'true}' ELSE 'null}' END AS properties FROM part""",
)
def map_lifts(spark, d):
    """F25, F29."""
    return export.map_lifts(_part_layer(spark, d)).select("properties")


@query(
    "map_spots",
    """SELECT '{"id":"' || p_partkey || '","spotType":"' || ['crossing', 'lift_station', 'halfpipe'][1 + p_partkey % 3] || '","skiAreas":["a' || p_partkey || '"]' || CASE p_partkey % 3 WHEN 0 THEN ',"dismount":"sometimes"}'
        WHEN 1 THEN ',"name":"' || p_brand || '","liftId":"l","position":null,"entry":true,"exit":null}' ELSE '}' END AS properties FROM part""",
)
def map_spots(spark, d):
    """F26."""
    return export.map_spots(_part_layer(spark, d)).select("properties")


@query(
    "mapbox_use_offset",
    """WITH u AS (SELECT DISTINCT l_orderkey, CASE l_linenumber WHEN 1 THEN 'downhill' WHEN 2 THEN 'nordic' WHEN 3 THEN 'skitour' ELSE 'other' END AS use FROM lineitem)
    SELECT l_orderkey, use, (row_number() OVER (PARTITION BY l_orderkey ORDER BY use) - 1 - (count(*) OVER (PARTITION BY l_orderkey) - 1) / 2)::DOUBLE AS "offset" FROM u""",
)
def mapbox_use_offset(spark, d):
    """F24, F30."""
    m = F.col("l_linenumber")
    use = F.when(m == 1, "downhill").when(m == 2, "nordic").when(m == 3, "skitour").otherwise("hike")
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(use).alias("uses"))
    return per.select("l_orderkey", F.explode(export.use_offsets(F.col("uses"))).alias("use", "offset"))


@query("short_name", "SELECT p_partkey, CASE WHEN length(v) > 20 THEN trim(split_part(v, '(', 1)) ELSE v END AS short FROM (SELECT p_partkey, p_name || ' (' || p_type || ')' AS v FROM part)")
def short_name(spark, d):
    """F28."""
    return table(spark, d, "part").select("p_partkey", export.short_name(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")"))).alias("short"))


@query("name_with_ref", "SELECT p_partkey, nullif(concat_ws(' - ', CASE WHEN p_size % 2 = 0 THEN p_brand END, CASE WHEN p_size % 3 = 0 THEN p_name END), '') AS name FROM part")
def name_with_ref(spark, d):
    """F29."""
    return table(spark, d, "part").select("p_partkey", export.name_with_ref(F.when(F.col("p_size") % 3 == 0, F.col("p_name")), F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("name"))


@query("js_rounding", "SELECT o_orderkey, floor(-o_totalprice / 10 + 0.5)::BIGINT AS whole, floor(o_totalprice * 10 + 0.5) / 10 AS tenth FROM orders")
def js_rounding(spark, d):
    """T16."""
    return table(spark, d, "orders").select("o_orderkey", js_round(-F.col("o_totalprice") / 10).alias("whole"), (js_round(F.col("o_totalprice") * 10) / 10).alias("tenth"))
