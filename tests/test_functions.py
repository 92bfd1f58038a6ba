import math

from pyspark.sql import functions as F
from helpers import geometry, one, shapes, tag_frame

from pisteflow.functions import csvtext, geo, ids, jsnum, reduce, tags


def test_ids_match_published_ones(spark):
    df = shapes(spark, "k", ("p", "Point", [11.122066084534, 47.557111836837]), ("l", "LineString", [[11.1223444, 47.5572422], [11.1164297, 47.55815630000001]]))
    got = {r.k: r for r in df.select("k", ids.feature_id("skiArea", F.col("geometry")).alias("a"), ids.feature_id("lift", F.col("geometry")).alias("l"), geo.length_km(F.col("geometry")).alias("km")).collect()}
    assert got["p"].a == "02911313f405ef0415188ceb357b415f02af5d64"
    assert got["l"].l == "4d07b91974c5a5b3a0ad9e1928c0a6d433c5093b"
    assert math.isclose(got["l"].km, 0.455327355, rel_tol=1e-8)
    site = spark.range(1).select(ids.feature_id("skiArea", ids.site_placeholder(F.lit(1)))).first()[0]
    assert site == "2033ab9be8698fcd4794c24e42782bf33c124e8d"


def test_numbers(spark):
    values = {0.0: "0", 1.0: "1", -2.5: "-2.5", 1e7: "10000000", 1e-4: "0.0001", 123456789.125: "123456789.125", 47.55815630000001: "47.55815630000001", -0.001: "-0.001"}
    df = spark.createDataFrame([(k,) for k in values], "x double")
    assert dict(map(tuple, df.select("x", jsnum.number_text(F.col("x"))).collect())) == values
    assert [r[0] for r in df.where("x = -2.5").select(jsnum.js_round(F.col("x"))).collect()] == [-2]
    drift = spark.range(1).select(jsnum.legacy_float(F.lit("47.5581563"))).first()[0]
    assert drift == 47.55815630000001


def test_status(spark):
    cases = [
        ({"piste:type": "downhill"}, "operating", "downhill"),
        ({"piste:type": "disused", "disused": "downhill"}, "disused", "downhill"),
        ({"piste:type": "disused", "disused:piste:type": "downhill"}, "disused", None),
        ({"piste:type": "downhill", "proposed:piste:type": "nordic"}, "operating", "downhill"),
        ({"piste:type": "", "planned": "yes"}, "planned", None),
        ({"proposed:piste:type": "nordic"}, "proposed", "nordic"),
        ({"abandoned": "yes", "piste:type": "downhill"}, "abandoned", "downhill"),
        ({"demolished": "yes", "piste:type": "downhill"}, None, None),
        ({"piste:type": "razed"}, None, None),
        ({}, "operating", None),
    ]
    df = tag_frame(spark, *(c[0] for c in cases))
    got = one(df, tags.status_and_value(F.col("t"), "piste:type"))
    assert [(g.status, g.value) for g in got] == [c[1:] for c in cases]


def test_tag_values(spark):
    df = tag_frame(spark, {"n": "", "h": "0x10", "d": "7.5", "x": "abc", "b": "yes", "l": "a; b"})
    t = F.col("t")
    row = df.select(tags.number(tags.tag(t, "n")), tags.number(tags.tag(t, "h")), tags.number(tags.tag(t, "d")), tags.number(tags.tag(t, "x")), tags.boolean(tags.tag(t, "b")), tags.first_value(t, "l")).first()
    assert tuple(row) == (0.0, 16.0, 7.5, None, True, "a")
    durations = spark.createDataFrame([("5",), ("12:30",), ("x",), ("1.5",), (None,)], "v string")
    assert one(durations, tags.duration_seconds(F.col("v"))) == [300, 750, None, 90, None]


def test_names(spark):
    df = tag_frame(spark, {"name": "Main", "name:de": "Haupt", "name:fr": "Main"}, {"name": "7 - Run"}, {"other": "x"})
    assert one(df, tags.name(F.col("t"), "name", None, F.lit("7"))) == ["Main, Haupt", "Run", None]
    assert one(df.limit(1), tags.name(F.col("t"), "piste:name", "name")) == ["Main, Haupt"]


def test_ref_in_front_of_a_name(spark):
    names = {"11 - Peak Chair": "Peak Chair", "11-Peak Chair": "Peak Chair", "11- Peak Chair": "Peak Chair", "11 -Peak Chair": "11 -Peak Chair", "11 Peak Chair": "Peak Chair", "11. Peak": "11. Peak", "11Peak": "11Peak", " x ": " x "}
    want = dict(names) | {"11 -Peak Chair": "-Peak Chair"}
    df = tag_frame(spark, *({"name": n} for n in names))
    assert one(df, tags.name(F.col("t"), "name", None, F.lit("11"))) == list(want.values())


def test_lists_in_cells(spark):
    areas = "array<struct<id:string,name:string>>"
    df = spark.createDataFrame([([("b", "Zeta"), ("a", "Alpha"), ("c", None)], ["x.org", "a.org"], [("skimap.org", "9"), ("openstreetmap", "way/1")])], f"a {areas}, w array<string>, s array<struct<type:string,id:string>>")
    row = df.select(csvtext.area_names(F.col("a")), csvtext.area_ids(F.col("a")), csvtext.websites(F.col("w")), csvtext.source_urls(F.col("s"))).first()
    assert tuple(row) == ('"Alpha,Zeta,"', "b;a;c", "a.org x.org", "https://www.openstreetmap.org/way/1 https://www.skimap.org/SkiAreas/view/9")


def test_priorities(spark):
    df = spark.createDataFrame([(["proposed", "abandoned", "construction"],)], "s array<string>")
    assert one(df, reduce.priority(F.col("s"), "status")) == ["construction"]


def test_grooming_and_oneway(spark):
    df = tag_frame(spark, {"piste:grooming": "skating;classic"}, {"piste:grooming": "classic"}, {"piste:difficulty": "extreme"}, {"piste:grooming": "no"}, {})
    assert one(df, tags.grooming(F.col("t"))) == ["classic+skating", "classic", "backcountry", "backcountry", None]
    uses = F.array(F.lit("downhill"))
    assert one(tag_frame(spark, {}, {"piste:oneway": "no"}), tags.oneway(F.col("t"), uses)) == [True, False]


def test_reducers(spark):
    df = spark.createDataFrame([([None, "expert", "easy"], ["a", " b ", None, "a", ""], [True, None, False])], "d array<string>, s array<string>, o array<boolean>")
    row = df.select(reduce.priority(F.col("d"), "difficulty"), reduce.unique_joined(F.col("s")), reduce.oneway(F.col("o"))).first()
    assert tuple(row) == ("easy", "a, b", False)


def test_csv_cells(spark):
    df = spark.createDataFrame([("a,b",), ('say "x"',), (None,), ("plain",)], "v string")
    assert one(df, csvtext.escape(F.col("v"))) == ['"a,b"', '"say ""x"""', "", "plain"]


def test_geohash_and_projection(spark):
    row = spark.range(1).select(geo.geohash(F.lit(-5.6), F.lit(42.6), 5), geo.sinusoidal(F.lit(10.0), F.lit(45.0)), geo.tile_pixel(F.lit(11.0), F.lit(47.0), 10, 256), geo.bbox_clause(F.lit(65.0), F.lit(-90.0), F.lit(191.5), F.lit(90.0))).first()
    assert row[0] == "ezs42"
    assert math.isclose(row[1].x, geo.SPHERE_M * math.radians(10) * math.cos(math.radians(45)))
    assert (row[2].x, row[2].y) == (543, 360)
    assert row[3] == "[bbox:-90,65,90,-168.5]"


def test_points_along_line(spark):
    line = geometry("LineString", [[0.0, 0.0], [0.02, 0.0]])
    df = spark.createDataFrame([(line,)], f"g {geo.GEOMETRY}")
    pts = df.select(geo.points_each_km(F.col("g"), 1.0)).first()[0]
    assert len(pts) == 4 and pts[0] == [0.0, 0.0] and pts[-1] == [0.02, 0.0]
    profile = df.select(geo.profile_points(F.col("g.parts")[0])).first()[0]
    assert len(profile.points) == math.ceil(2.2239 * 1000 / 25) + 1 and profile.resolution <= 25
