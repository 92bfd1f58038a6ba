"""Whole runs over files, snow cover, enrichment, caches and streams."""

import json
import math
import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from helpers import raw, shapes

from pisteflow.operators import algebra
from pisteflow.plans import enrich, export, formatters, prepare, snow
from pisteflow.sources import config, geojson
from pisteflow.sources.cache import Cache
from pisteflow.streaming import events


def _write(path: Path, *features) -> None:
    rows = [{"type": "Feature", "properties": p, "geometry": {"type": k, "coordinates": c}} for k, c, p in features]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": rows}))


def _download(paths, layer, *elements):
    paths.osm_json(layer).write_text(json.dumps({"elements": list(elements)}))


def test_run_over_downloads(spark, tmp_path):
    """From OSM JSON, as it is downloaded, to all files of all layers."""
    paths = config.Paths(tmp_path / "data", out=tmp_path / "out").make()
    node = lambda i, x, y, **t: {"type": "node", "id": i, "lon": x, "lat": y, "tags": t or None}
    way = lambda i, nodes, **t: {"type": "way", "id": i, "nodes": nodes, "tags": {k.replace("__", ":"): v for k, v in t.items()}}
    a, b, c = node(1, 11.1164297, 47.5581563), node(2, 11.12, 47.558), node(3, 11.1223444, 47.5572422)
    _download(paths, "runs", a, b, c, way(1, [1, 2], piste__type="downhill", name="R", ref="7"), way(2, [2, 3], piste__type="downhill", name="R", ref="7"))
    _download(paths, "lifts", a, c, way(3, [3, 1], aerialway="chair_lift", name="Up", ref="A"))
    _download(paths, "ski_areas", node(8, 0.0, 0.0))
    _download(paths, "spots", {**node(5, 11.12, 47.5575), "tags": {"piste:dismount": "yes"}}, {**c, "tags": {"aerialway": "station", "name": "Valley"}})
    site = {"type": "relation", "id": 7, "tags": {"site": "piste", "name": "Site"}, "members": [{"type": "way", "ref": 3, "role": ""}]}
    (paths.root / "input_ski_area_sites.osmjson").write_text(json.dumps({"elements": [site]}))
    second = lambda i, x, y: ("Point", [x, y], {"id": i, "name": f"S{i}", "scalerank": 1, "status": "operating", "activities": ["downhill"], "official_website": None})
    _write(paths.root / "input_second_source.geojson", second("1", 60.0, 10.0), second("2", 12.5, 46.5))
    assert prepare.convert(spark, paths) == ["ski_areas", "runs", "lifts", "spots"]
    assert len(json.loads(paths.raw("ski_areas").read_text())["features"]) == 1  # a lone node
    from pisteflow.functions import geo

    heights = {1: 1500.0, 2: 1200.0, 3: 1000.0}
    pts = spark.createDataFrame([(p["lon"], p["lat"], heights[p["id"]]) for p in (a, b, c)], "lon double, lat double, value double")
    runs = formatters.format_runs(geojson.read_features(spark, f"file://{paths.raw('runs')}"))
    along = prepare.normalised_runs(runs).select(F.explode(geo.profile_points(F.col("geometry.parts")[0])["points"]).alias("p")).select(F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"), F.lit(1100.0).alias("value"))
    elevation = pts.union(along).select(geo.geohash(F.col("lon"), F.col("lat"), 10).alias("key"), F.col("value").cast("float").alias("value")).groupBy("key").agg(F.max_by("value", F.col("value") != 1100).alias("value"))
    timer = prepare.Timer()
    pixels = snow.run_pixels(runs).select("tile", "row", "col").distinct()
    cover = pixels.withColumn("data", F.expr("array(named_struct('year', 2024, 'data', array(array(80, 0), array(60, 0))))"))
    objects, stats = prepare.prepare(spark, paths, elevation, timer=timer, bbox=(5, 40, 20, 50), snow_cover=cover)
    rows = objects.collect()
    areas = [r for r in rows if r.type == "skiArea"]
    assert sorted(a.name for a in areas) == ["S2", "Site"]
    home = next(a.key for a in areas if a.name == "Site")
    assert all(r.ski_areas == [home] for r in rows if r.type != "skiArea") and len(rows) == 6
    assert [n for _, n, _ in timer.took] == ["cluster", "snow cover", "prepare"]
    prepare.outputs(objects, stats, paths, cover)
    read = lambda layer, kind="geojson": [f["properties"] for f in json.loads(paths.output(layer, kind).read_text())["features"]]
    area = next(p for p in read("ski_areas") if p["name"] == "Site")
    assert area["statistics"]["lifts"]["byType"]["chair_lift"]["count"] == 1 and area["statistics"]["snowCover"]["overall"][0]["days"] == [[1, 80, 100], [8, 60, 100]]
    run, lift = read("runs")[0], read("lifts")[0]
    assert run["skiAreas"][0]["properties"] == {"id": home, "name": "Site", "activities": ["downhill"], "type": "skiArea", "status": "operating"}
    assert run["elevationProfile"]["targetResolution"] == 25.0 and len(run["snowCoverHistory"]) == 1 and run["tunnel"] is None
    assert [s["properties"]["name"] for s in lift["stations"]] == ["Valley"] and lift["stations"][0]["properties"]["position"] == "bottom"
    assert lift["stations"][0]["properties"]["liftId"] == lift["id"]
    spots = {p["spotType"]: p for p in read("spots")}
    assert spots["crossing"]["dismount"] == "yes" and "entry" not in spots["crossing"] and spots["lift_station"]["entry"] is None
    shown = read("runs", "map")[0]
    assert shown["name"] == "7 - R" and shown["downhill"] == 0 and "nordic" not in shown and shown["skiAreas"] == [home] and "snowmaking" in shown
    assert read("lifts", "map")[0]["name_and_type"] == "A - Up (Chairlift)" and len(read("lifts", "map")[0]["stationIds"]) == 1
    assert next(p for p in read("ski_areas", "map") if p["name"] == "Site")["maxElevation"] == 1500 and "has_nordic" not in read("ski_areas", "map")[0]
    lines = {n: paths.output(n, "csv").read_text().splitlines() for n in ("ski_areas", "runs", "lifts", "spots")}
    assert all(lines[n][0] == export.CSV_HEADERS[k] for n, k in (("ski_areas", "skiArea"), ("runs", "run"), ("lifts", "lift"), ("spots", "spot")))
    assert any(x.startswith("Site,,,,operating,yes,no,0,,500,1000,1500,1,,") for x in lines["ski_areas"]) and lines["runs"][1].startswith("R,7,,,,Site,")
    db = sqlite3.connect(paths.package)
    tables = {r[0] for r in db.execute("SELECT table_name FROM gpkg_contents")}
    assert tables == {"ski_areas_point", "runs_linestring", "lifts_linestring", "spots_point"}
    assert db.execute("SELECT uses, ski_area_names, elevation_profile_resolution IS NOT NULL FROM runs_linestring").fetchall() == [("downhill", "Site", 1)]
    assert db.execute("SELECT lift_type, ref, max_elevation FROM lifts_linestring, ski_areas_point WHERE ski_areas_point.name = 'Site'").fetchall() == [("chair_lift", "A", 1500.0)]
    db.close()
    merged = prepare.merge_outputs(spark, [str(paths.target), str(paths.target)], str(tmp_path / "merged"))
    assert merged["ski_areas.geojson"] == 4 and merged["csv/ski_areas.csv"] == 4 and merged["ski_areas_point"] == 2 and merged["csv/spots.csv"] == 4


def test_settings(tmp_path):
    assert config.bbox_clause((65, -90, 191.5, 90)) == "[bbox:-90,65,90,-168.5]" and config.bbox_clause(None) == ""
    assert 'way["planned:aerialway"];' in config.layer_query("lifts")
    s = config.from_environment({"BBOX": "[1,2,3,4]", "ELEVATION_SERVER_URL": "x", "ELEVATION_SERVER_TYPE": "tile", "ELEVATION_SERVER_ZOOM": "15,12"})
    assert s.bbox == (1, 2, 3, 4) and s.elevation.zooms == (15, 12)
    assert s.output_dir == "data" and s.geocoder is None and s.snow_policy is None and s.elevation.encoding == "mapbox"
    t = config.from_environment({"OUTPUT_DIR": "o", "GEOCODING_SERVER_URL": "g", "GEOCODING_SERVER_URL_TTL": "5", "ENABLE_SNOW_COVER": "1", "GENERATE_TILES": "1"})
    assert (t.output_dir, t.geocoder.kind, t.geocoder.ttl_ms, t.snow_policy, t.tiles) == ("o", "photon", 5, "full", True)
    with pytest.raises(ValueError):
        config.from_environment({"BBOX": "1,2"})
    tries = []

    class Source:
        def __init__(self):
            self.left = [b"ab", b""]

        def read(self, n):
            return self.left.pop(0)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return None

    def opener(url, timeout):
        tries.append(url)
        if len(tries) < 3:
            raise OSError("no")
        return Source()

    assert config.download("u", str(tmp_path / "f"), wait_s=0, opener=opener) == 2 and len(tries) == 3
    with pytest.raises(NotADirectoryError):
        config.files_to_merge([str(tmp_path / "none")], "csv")


def test_snow(spark):
    data = [("h18v04", 1, 2, [(2024, [[80, 5], [90, 0], [200, 0]])]), ("h18v04", 1, 3, [(2024, [[60, 5], [70, 0]])])]
    weeks = snow.long_form(spark.createDataFrame(data, snow.SERIES))
    days = snow.pixel_days(weeks)
    assert sorted(tuple(r) for r in days.where("col = 2").select("year", "day", "snow").collect()) == [(2023, 361, 80), (2024, 8, 90)]
    area = snow.existing_pixels(weeks).withColumn("area", F.lit("a"))
    got = snow.nested_history(snow.history(area, days, ["area"]), ["area"]).first()
    assert [(y.year, y.days) for y in got.history] == [(2023, [[361, 70, 100]]), (2024, [[8, 80, 100]])]
    back = snow.to_series(weeks.where("snow <= 100")).where("col = 2").first()
    assert len(back.data[0].data) == 53 and back.data[0].data[0] == [80, 5] and back.data[0].data[2] == [None, 0]
    gaps = snow.missing_weeks(snow.existing_pixels(weeks), weeks, "2024-01-01", "2024-01-22")
    assert {(r["col"], str(r["date"])) for r in gaps.collect()} == {(2, "2024-01-22"), (3, "2024-01-15"), (3, "2024-01-22")}
    assert tuple(snow.missing_summary(gaps).first()) == (1, 2, 3)
    asked = gaps.where("col = 3")
    fetched = snow.extract(weeks.select("tile", "row", "col", F.lit("2024-01-15").cast("date").alias("date"), F.col("snow").alias("value"), "persistence"), asked, "2024-01-30")
    assert snow.MISSING_RECENT in {r.snow for r in fetched.collect()}
    assert snow.without_codes(spark.createDataFrame([(400,), (301,), (5,), (None,)], "snow int")).count() == 3
    runs = shapes(spark, "id", ("r", "LineString", [[11, 47], [11.01, 47]]))
    assert snow.run_pixels(runs).count() >= 2


def test_enrichment(spark):
    lines = shapes(spark, "id", ("l", "LineString", [[11.0, 47.0], [11.001, 47.0]]), ("m", "Point", [12.0, 47.0]))
    keys = enrich.elevation_keys(lines)
    table = keys.where("lon < 12").select("key", (F.col("lon") * 100).cast("float").alias("value"))
    got = {r.id: r.geometry.parts[0] for r in enrich.add_elevations(lines, table).collect()}
    assert got["l"] == [[11.0, 47.0, 1100.0], [11.001, 47.0, 1100.1]] and got["m"] == [[12.0, 47.0]]
    place = "struct<iso3166_1Alpha2:string,iso3166_2:string,localized:struct<en:struct<country:string,region:string,locality:string>>>"
    here = enrich.place_keys(lines).where("id = 'l'").select(F.col("place_key").alias("key")).distinct()
    places = here.withColumn("place", F.expr(f"from_json('{{\"p\":{{\"iso3166_1Alpha2\":\"AT\",\"localized\":{{\"en\":{{\"country\":\"Austria\"}}}}}}}}', 'p {place}').p"))
    named = {r.id: r.places for r in enrich.add_places(lines.withColumn("places", F.array().cast(f"array<{place}>")), places).collect()}
    assert [p.localized.en.country for p in named["l"]] == ["Austria"] and named["m"] == []
    pts = spark.createDataFrame([("k", 11.0, 47.0), ("far", 100.0, 10.0)], "key string, lon double, lat double")
    image = bytes([1, 134, 160] * 16)  # one colour: 0 m above the base of the scale plus 0
    tiles = spark.createDataFrame([(2, x, y, 4, image, False) for x in range(4) for y in range(4)], "z int, x int, y int, width int, rgb binary, missing boolean")
    heights = {r.key: r.value for r in enrich.sample_tiles(pts, enrich.decode_tiles(tiles), (9, 2), 4).collect()}
    assert math.isclose(heights["k"], 0.0, abs_tol=1e-6) and math.isclose(heights["far"], 0.0, abs_tol=1e-6)


def test_cache_and_stream(spark, tmp_path):
    cache = Cache(spark, f"file://{tmp_path}/cache", "string", ttl_ms=100)
    entry = lambda *kv: spark.createDataFrame(list(kv), "key string, value string")
    cache.set_many(entry(("a", "1"), ("b", None)), 1000)
    cache.set_many(entry(("a", "2")), 1050)
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert {r.k: (r.hit, r.value) for r in cache.get_many(asked, "k", 1120).collect()} == {"a": (True, "2"), "b": (False, None), "c": (False, None)}
    cache.cleanup(1120)
    assert cache.size() == 1
    with pytest.raises(TypeError):
        Cache(spark, f"file://{tmp_path}/cache", "double").read()
    entry(("s", "9"), ("a", "3")).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("key string, value string").parquet(f"file://{tmp_path}/in")
    q = events.into_cache(stream, cache, lambda: 1130, f"file://{tmp_path}/check")
    q.processAllAvailable()
    q.stop()
    assert {r.key: r.value for r in cache.read().collect()} == {"a": "3", "s": "9"}


def test_algebra(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "i int, l array<int>")
    assert algebra.flat_map_array(df, F.col("l"), "x").count() == 2
    assert algebra.flat_map(df, F.get("l", 0), "x").count() == 1
    tapped, seen = algebra.tap(df, "seen")
    tapped.collect()
    assert seen.get["rows"] == 3
    assert algebra.merge(df, df.drop("l")).count() == 6
    assert sorted(r.local_id for r in algebra.local_ids(df, ["i"]).collect()) == ["0", "1", "2"]
    with pytest.raises(ValueError):
        algebra.accumulate(df, [], lambda x: x, "i int")
    assert raw(spark, ("Point", [0, 0], {})).count() == 1
