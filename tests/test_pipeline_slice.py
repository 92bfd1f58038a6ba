"""The end-to-end slice: raw layers to clustered areas, statistics and files."""

import json
import math
import sqlite3

from pyspark.sql import functions as F
from helpers import raw, second

from pisteflow.operators import relational
from pisteflow.plans import clustering, export, formatters
from pisteflow.sources import geojson, osm, sinks

LIFT = ("LineString", [[11.1223444, 47.5572422, 1000], [11.1164297, 47.5581563, 1500]], {"aerialway": "t-bar", "name": "Skilift"})
RUN = ("LineString", [[11.1164297, 47.5581563, 1500], [11.1223444, 47.5572422, 1000]], {"piste:type": "downhill", "piste:difficulty": "easy", "name": "Run"})
NONE = ("Point", [0, 0], {"x": "y"})


def clustered(spark, lifts=(LIFT,), runs=(RUN,), spots=(NONE,), areas=None):
    areas = areas if areas is not None else formatters.format_second_source(second(spark, "1", 11.12, 47.557))
    objects = clustering.load(areas, formatters.format_runs(raw(spark, *runs)), formatters.format_lifts(raw(spark, *lifts)), formatters.format_spots(raw(spark, *spots)))
    return clustering.cluster(objects)


def test_area_takes_near_objects(spark):
    station = ("Point", [11.1223444, 47.5572422, 1050], {"aerialway": "station", "name": "Valley"})
    orphan = ("Point", [11.3, 47.5572422], {"aerialway": "station"})
    objects, stats = clustered(spark, spots=(station, orphan))
    rows = objects.collect()
    area = next(r for r in rows if r.type == "skiArea")
    assert {r.type: r.ski_areas for r in rows if r.type != "skiArea"} == {"run": [area.key], "lift": [area.key], "spot": [area.key]}
    lift = next(r for r in rows if r.type == "lift")
    spot = next(r for r in rows if r.type == "spot")
    assert lift.station_ids == [spot.key] and json.loads(spot.properties)["stationLift"] == lift.key
    s = stats.where(F.col("ski_area") == area.key).first().statistics
    assert math.isclose(s.lifts.byType["t-bar"].lengthInKm, 0.4553273553619445, rel_tol=1e-9)
    assert s.runs.byActivity["downhill"].byDifficulty["easy"]["count"] == 1
    assert (s.minElevation, s.maxElevation) == (1000.0, 1500.0)


def test_generated_area_needs_a_lift_for_downhill(spark):
    far = formatters.format_second_source(second(spark, "9", 0.0, 0.0))
    objects, _ = clustered(spark, areas=far)
    made = [r for r in objects.collect() if r.type == "skiArea" and r.source == "openstreetmap"]
    assert len(made) == 1 and made[0].activities == ["downhill"]
    far_lift = ("LineString", [[20, 40], [20.01, 40]], {"aerialway": "t-bar"})
    objects, _ = clustered(spark, areas=far, lifts=(far_lift,))
    assert not [r for r in objects.collect() if r.type == "skiArea" and r.source == "openstreetmap"]


def test_polygon_area_and_merge_of_sources(spark):
    ring = [[[11.11, 47.55], [11.13, 47.55], [11.13, 47.56], [11.11, 47.56], [11.11, 47.55]]]
    landuse = formatters.format_landuse(raw(spark, ("Polygon", ring, {"landuse": "winter_sports", "name": "Both"})))
    objects, _ = clustered(spark, areas=landuse.unionByName(formatters.format_second_source(second(spark, "1", 11.12, 47.557))))
    areas = [r for r in objects.collect() if r.type == "skiArea"]
    assert len(areas) == 1 and areas[0].name == "Both"
    assert [(s.type, s.id) for s in areas[0].sources] == [("openstreetmap", "way/1"), ("skimap.org", "1")]
    assert all(r.in_polygon for r in objects.collect() if r.type in ("run", "lift"))


def test_empty_polygon_goes(spark):
    ring = [[[1, 1], [1.1, 1], [1.1, 1.1], [1, 1.1], [1, 1]]]
    objects, _ = clustered(spark, areas=formatters.format_landuse(raw(spark, ("Polygon", ring, {"landuse": "winter_sports"}))))
    assert [r.source for r in objects.collect() if r.type == "skiArea"] == ["openstreetmap"]


def test_formatters_drop_what_is_no_feature(spark):
    assert formatters.format_lifts(raw(spark, LIFT, ("LineString", [[0, 0], [1, 1]], {"aerialway": "t-bar", "access": "no"}), ("Point", [0, 0], {"aerialway": "t-bar"}))).count() == 1
    bad = ("LineString", [[0, 0], [1, 1]], {"piste:type": "unknown"})
    split = ("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3]]], {"piste:type": "nordic;hike"})
    rows = formatters.format_runs(raw(spark, RUN, bad, split)).collect()
    assert sorted(r.uses for r in rows) == [["downhill"], ["nordic", "hike"], ["nordic", "hike"]]
    spots = formatters.format_spots(raw(spark, ("Point", [1, 2], {"piste:dismount": "yes", "man_made": "piste:halfpipe"})))
    assert sorted(r.spotType for r in spots.collect()) == ["crossing", "halfpipe"]


def test_geojson_round_trip_and_scan(spark, tmp_path):
    runs = formatters.format_runs(raw(spark, RUN))
    path = str(tmp_path / "runs.geojson")
    n = sinks.write_geojson(runs.select("geometry", F.struct("id", "type", "name", "websites").alias("properties")), path)
    text = json.loads((tmp_path / "runs.geojson").read_text())
    assert n == 1 and text["features"][0]["properties"]["name"] == "Run" and text["features"][0]["geometry"]["coordinates"][0] == [11.1164297, 47.5581563, 1500.0]
    back = geojson.read_features(spark, f"file://{path}", "struct<id:string,name:string>").collect()
    assert back[0].properties.name == "Run" and back[0].geometry.parts[0][1] == [11.1223444, 47.5572422, 1000.0]
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": text["features"]}))
    legacy = geojson.read_features(spark, f"file://{tmp_path}/one.json", "struct<id:string>", legacy_float_parse=True).first()
    assert legacy.geometry.parts[0][0][1] == 47.55815630000001


def test_osm_conversion(spark, tmp_path):
    nodes = [{"type": "node", "id": i, "lat": la, "lon": lo} for i, (lo, la) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)], 1)]
    ways = [{"type": "way", "id": 10, "nodes": [1, 2, 3, 4, 1], "tags": {"piste:type": "downhill"}}, {"type": "way", "id": 11, "nodes": [1, 2, 3, 1], "tags": {"piste:type": "nordic"}}, {"type": "way", "id": 12, "nodes": [1, 2, 3]}, {"type": "way", "id": 13, "nodes": [3, 4, 1]}]
    relation = {"type": "relation", "id": 20, "tags": {"type": "multipolygon", "landuse": "winter_sports"}, "members": [{"type": "way", "ref": 12, "role": "outer"}, {"type": "way", "ref": 13, "role": "outer"}]}
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [*nodes, *ways, relation]}))
    rows = {(r.properties.type, r.properties.id): r.geometry.type for r in osm.to_features(geojson.read_elements(spark, f"file://{tmp_path}/osm.json")).collect()}
    assert rows == {("way", 10): "Polygon", ("way", 11): "LineString", ("way", 12): "LineString", ("way", 13): "LineString", ("relation", 20): "Polygon"}


def test_csv_and_package(spark, tmp_path):
    lifts = formatters.format_lifts(raw(spark, LIFT)).withColumn("areas", F.expr("array(named_struct('id', 'x', 'name', 'Area, one'))"))
    line = export.csv_lines(lifts, "lift").first().line
    assert line.startswith("Skilift,,,t-bar,operating,,,,,\"Area, one\",,,") and line.count(",") == 34
    assert len(export.CSV_HEADERS["lift"].split(",")) == 34 and len(export.CSV_HEADERS["run"].split(",")) == 32
    assert sinks.write_csv(export.csv_lines(lifts.where("false"), "lift"), str(tmp_path / "e.csv"), export.CSV_HEADERS["lift"]) == 0
    assert (tmp_path / "e.csv").read_text() == ""

    a, b = sinks.GeoPackage(str(tmp_path / "a.gpkg")), sinks.GeoPackage(str(tmp_path / "b.gpkg"))
    rows = export.package_columns(lifts, "lift")
    a.add(rows, "lifts")
    b.add(rows.union(rows.withColumn("feature_id", F.lit("other"))), "lifts")
    b.close()
    assert a.merge(str(tmp_path / "b.gpkg")) == {"lifts_linestring": 2}
    a.index()
    a.close()
    db = sqlite3.connect(tmp_path / "a.gpkg")
    assert db.execute("select count(*) from rtree_lifts_linestring_geometry").fetchone() == (2,)
    assert db.execute("select lift_type, countries from lifts_linestring").fetchone() == ("t-bar", None)


def test_map_layers(spark):
    runs = formatters.format_runs(raw(spark, ("LineString", [[11, 47], [11.1, 47]], {"piste:type": "downhill;hike;sled"}), ("LineString", [[1, 1], [2, 2]], {"piste:type": "connection"})))
    area = F.array(F.struct(F.lit("a").alias("id"), F.lit("A").alias("name")))
    rows = [json.loads(r.properties) for r in export.map_runs(runs.withColumn("areas", area)).collect()]
    assert len(rows) == 1 and (rows[0]["downhill"], rows[0]["other"], rows[0]["skiAreas"]) == (-0.5, 0.5, ["a"])
    assert "nordic" not in rows[0] and rows[0]["snowmaking"] is None


def test_upsert_delete_and_lookup(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "key string, v int")
    assert sorted(map(tuple, relational.upsert(base, new, ["key"]).collect())) == [("a", 1), ("b", 3), ("c", 4)]
    objects = spark.createDataFrame([("x", ["a", "b"]), ("a", []), ("b", [])], "key string, ski_areas array<string>")
    assert sorted(map(tuple, relational.delete_cascade(objects, base.where("key = 'a'")).collect())) == [("b", []), ("x", ["b"])]
    cache = spark.createDataFrame([("a", "1", 100), ("b", None, 950)], "key string, value string, timestamp bigint")
    got = relational.lookup(spark.createDataFrame([("a",), ("b",), ("z",)], "k string"), cache, "k", 1000, 500)
    assert {r.k: r.hit for r in got.collect()} == {"a": False, "b": True, "z": False}
