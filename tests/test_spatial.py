import random
import threading
from contextlib import contextmanager

from pyspark.sql import functions as F
from helpers import shapes

from pisteflow.operators import kernels, spatial
from pisteflow.operators.graph import connected_components


def test_distance_join_matches_brute_force(spark):
    rnd = random.Random(5)
    spot = lambda: [179.99 + rnd.random() * 0.03 if rnd.random() < 0.3 else 11 + rnd.random() * 0.05, 47 + rnd.random() * 0.05]
    wrap = lambda p: [p[0] - 360 if p[0] > 180 else p[0], p[1]]
    a = [(f"a{i}", "Point", wrap(spot())) for i in range(60)]
    b = [(f"b{i}", "LineString", [wrap(p := spot()), [wrap(p)[0] + 0.001, p[1] + 0.001]]) for i in range(60)]
    got = {(r.lkey, r.rkey) for r in spatial.within_distance(shapes(spark, "lkey", *a), shapes(spark, "rkey", *b), 800.0).collect()}
    plain = lambda k, c: kernels.plain({"type": k, "parts": [[c]] if k == "Point" else [c], "poly": [0]})
    want = {(x[0], y[0]) for x in a for y in b if kernels.distance_m(plain(*x[1:]), plain(*y[1:])) <= 800.0}
    assert got == want and want


def test_large_and_small_shapes_meet(spark):
    square = [[[10.0, 46.0], [12.0, 46.0], [12.0, 48.0], [10.0, 48.0], [10.0, 46.0]]]
    areas = shapes(spark, "lkey", ("big", "Polygon", square))
    objects = shapes(spark, "rkey", ("in", "Point", [11, 47]), ("edge", "Point", [10, 47]), ("out", "Point", [9.9, 47]), ("across", "LineString", [[11, 47], [13, 47]]))
    assert {r.rkey for r in spatial.contained(areas, objects).collect()} == {"in", "edge"}
    assert {r.rkey for r in spatial.intersecting(areas, objects).collect()} == {"in", "edge", "across"}
    assert {r.rkey for r in spatial.contained(areas, objects, buffer_m=10_000).collect()} == {"in", "edge", "out"}


def test_nearest_prefers_on_ties(spark):
    points = shapes(spark, "lkey", ("s", "Point", [11.0, 47.0]))
    lines = shapes(spark, "rkey", ("far", "LineString", [[11.0002, 47.0], [11.0003, 47.0]]), ("b", "LineString", [[11.0, 47.0], [11.01, 47.0]]), ("a", "LineString", [[11.0, 47.0], [11.0, 47.01]]))
    assert spatial.nearest(points, lines, 30).first().rkey == "a"
    marked = lines.withColumn("good", F.col("rkey") == "b")
    assert spatial.nearest(points, marked, 30, F.col("good")).first().rkey == "b"


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 200: 200}


def test_validity_and_centres():
    bow = kernels.plain({"type": "Polygon", "parts": [[[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]], "poly": [0]})
    box = kernels.plain({"type": "Polygon", "parts": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]], "poly": [0]})
    assert not kernels.is_valid(bow) and kernels.is_valid(box)
    assert kernels.central_points(box) == [[0.5, 0.5]]
    ell = kernels.plain({"type": "Polygon", "parts": [[[0, 0], [4, 0], [4, 0.1], [0.1, 0.1], [0.1, 4], [0, 4], [0, 0]]], "poly": [0]})
    assert kernels.points_in_rings(__import__("numpy").array(kernels.central_points(ell)), ell[1], ell[2]).all()


def test_pixels_of_a_point_and_a_line():
    dot = kernels.plain({"type": "Point", "parts": [[[11.0, 47.0]]], "poly": [0]})
    line = kernels.plain({"type": "LineString", "parts": [[[11.0, 47.0], [11.02, 47.0]]], "poly": [0]})
    assert len(kernels.pixels_of(dot)) == 1
    assert set(kernels.pixels_of(dot)) <= set(kernels.pixels_of(line)) and len(kernels.pixels_of(line)) >= 4


@contextmanager
def seconds(spark, limit):
    """Jobs that still run after so long are cancelled, so that the test fails."""
    timer = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        yield
    finally:
        timer.cancel()


def dots(spark, n, key, x, y):
    """Points of numbered rows."""
    at = F.array(F.array(F.array(x.cast("double"), y.cast("double"))))
    return spark.range(n).select(F.col("id").alias(key), F.struct(F.lit("Point").alias("type"), at.alias("parts"), F.array(F.lit(0)).alias("poly")).alias("geometry"))


def test_points_at_one_position_are_measured_once(spark):
    n = F.col("id")
    a = dots(spark, 200_000, "lkey", 11 + F.floor(n / 200_000), 47 + F.floor(n / 200_000))
    near = n % 25_000 == 7
    b = dots(spark, 50_000, "rkey", F.when(near, 11.01).otherwise(11.025), F.when(near, 47.0).otherwise(47.017))
    with seconds(spark, 60):
        got = spatial.within_distance(a, b, 2000.0).groupBy("rkey").agg(F.count("*").alias("n"), F.min("metres").alias("m"), F.max("metres").alias("x")).collect()
    assert sorted((r.rkey, r.n) for r in got) == [(7, 200_000), (25_007, 200_000)]
    assert all(r.m == r.x and abs(r.m - 760.6) < 1 for r in got)


def test_point_pairs_match_brute_force(spark):
    rnd = random.Random(9)
    spot = lambda: rnd.choice([[11 + rnd.random() * 0.1, 47 + rnd.random() * 0.1], [rnd.random() * 0.1 - 0.05, rnd.random() * 0.1 - 0.05], [170 + rnd.random() * 9, 88.5 + rnd.random() * 0.9], [-180.0, -47.0], [180.0, 0.01], [11.0, 47.0]])
    a = [(f"a{i}", "Point", spot()) for i in range(150)] + [("placeholder", "Point", [360.0, 360.0])]
    b = [(f"b{i}", "Point", spot()) for i in range(150)] + [("placeholder", "Point", [360.0, 360.0])]
    plain = lambda c: kernels.plain({"type": "Point", "parts": [[c]], "poly": [0]})
    for metres in (300.0, 2500.0, 20_000.0):
        got = {(r.lkey, r.rkey): r.metres for r in spatial.within_distance(shapes(spark, "lkey", *a), shapes(spark, "rkey", *b), metres, decimals=6).collect()}
        want = {(x[0], y[0]): m for x in a[:-1] for y in b[:-1] if (m := kernels.distance_m(plain(x[2]), plain(y[2]))) <= metres}
        assert set(got) == set(want) and all(abs(got[k] - m) < 1e-5 for k, m in want.items()) and want


def test_nearest_among_points_at_one_position(spark):
    n = F.col("id")
    a = dots(spark, 100_000, "lkey", 11 + F.floor(n / 99_999) * 0.15, 47 + F.floor(n / 100_000))
    b = dots(spark, 100_000, "rkey", 11.005 + F.floor(n / 100_000), 47.005 + F.floor(n / 99_999) * 3)
    with seconds(spark, 60):
        got = spatial.nearest(a, b.withColumn("rkey", 100_002 - F.col("rkey")), 20_000.0).groupBy("rkey").agg(F.count("*").alias("n"), F.round(F.min("metres"), -2).alias("m")).collect()
    assert [tuple(r) for r in got] == [(4, 100_000, 700.0)]


def test_nearest_points_match_brute_force(spark):
    rnd = random.Random(3)
    spot = lambda: [11 + rnd.randrange(60) * 0.005, 47 + rnd.randrange(60) * 0.005]
    a = [(f"a{i % 80}", "Point", spot()) for i in range(100)] + [("lone", "Point", [12.0, 47.0]), ("placeholder", "Point", [360.0, 360.0])]
    b = [(f"b{i}", "Point", spot()) for i in range(12)] * 2
    plain = lambda c: kernels.plain({"type": "Point", "parts": [[c]], "poly": [0]})
    every = [(x[0], (round(kernels.distance_m(plain(x[2]), plain(y[2])), 6), y[0])) for x in a[:-1] for y in b]
    want = {k: min(v for j, v in every if j == k) for k, _ in every}
    got = {r.lkey: (round(r.metres, 6), r.rkey) for r in spatial.nearest(shapes(spark, "lkey", *a), shapes(spark, "rkey", *b), 20_000.0).collect()}
    assert got == {k: v for k, v in want.items() if v[0] <= 20_000.0} and "lone" not in got
