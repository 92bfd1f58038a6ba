"""Services, tiles on disk, other programs and the command line."""

import io
import json
import sys
import urllib.error

import pandas as pd
import pytest
from pyspark.sql import functions as F
from helpers import shapes

from pisteflow import cli
from pisteflow.functions import geo, ids
from pisteflow.plans import snow
from pisteflow.sources import config, remote
from pisteflow.sources.cache import Cache


def test_messages_are_throttled():
    said, now = [], [0.0]
    tell = remote.Throttled(60, said.append, lambda: now[0])
    assert tell("a") and not tell("a") and tell("b")
    now[0] = 61
    assert tell("a") and said == ["a", "b", "a"]


def test_commands():
    remote.run_command(sys.executable, "-c", "pass")
    with pytest.raises(RuntimeError, match="ended with 3: no"):
        remote.run_command(sys.executable, "-c", "import sys; sys.stderr.write('no'); sys.exit(3)")


def test_tiles_on_disk(tmp_path):
    store, asked = remote.TileStore(str(tmp_path), 2), []

    def opener(url, timeout):
        asked.append(url)
        if url.endswith("9"):
            raise urllib.error.HTTPError(url, 404, "none", {}, None)
        return io.BytesIO(url.encode())

    get = lambda y: store.fetch(1, 0, y, "u/{z}/{x}/{y}", opener)
    assert get(1) == b"u/1/0/1" and get(2) == b"u/1/0/2" and get(9) is None and get(9) is None and asked.count("u/1/0/9") == 1
    assert get(1) == b"u/1/0/1" and len(asked) == 3
    assert get(3) and store.get(1, 0, 2) is None and store.get(1, 0, 1)  # the least recently used went
    with pytest.raises(urllib.error.HTTPError):
        store.fetch(1, 0, 5, "u", lambda url, timeout: (_ for _ in ()).throw(urllib.error.HTTPError(url, 500, "x", {}, None)))


def test_elevations():
    def opener(asked, timeout):
        return io.BytesIO(json.dumps([lat * 10 for lat, _ in json.loads(asked.data)]).encode())

    assert remote.posted_elevations("http://u", [(11.0, 47.0), (12.0, 48.0)], opener) == [470.0, 480.0]
    with pytest.raises(ValueError):
        remote.posted_elevations("http://u", [(1.0, 2.0)], lambda a, timeout: io.BytesIO(b"[]"))
    seen = []

    def at_zoom(zoom, points):
        seen.append((zoom, list(points)))
        return [p if p % zoom == 0 else None for p in points]

    assert remote.with_fallback(at_zoom, [4, 6, 7], (4, 3, 2)) == [4, 6, None]
    assert seen == [(4, [4, 6, 7]), (3, [6, 7]), (2, [7])]


def test_fill_asks_for_what_is_unknown(spark, tmp_path):
    cache = Cache(spark, f"file://{tmp_path}/cache", "string", ttl_ms=1000)
    entry = lambda *kv: spark.createDataFrame(list(kv), "key string, value string")
    cache.set_many(entry(("a", "old"), ("b", "kept")), 500)
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), ("bad",)], "key string")

    def lookup(keys):
        if "bad" in keys:
            raise OSError("down")
        return [f"new {k}" for k in keys]

    got = {r.key: (r.hit, r.value) for r in remote.fill(cache, wanted, lookup, 1000, batch=1, wait_s=0).collect()}
    assert got == {"a": (True, "old"), "b": (True, "kept"), "c": (True, "new c"), "bad": (False, None)}
    never = remote.fill(cache, spark.createDataFrame([(f"k{i}",) for i in range(9)], "key string").coalesce(1), lambda k: 1 / 0, 1000, batch=1, at_once=1, most_errors=2, wait_s=0)
    assert never.where("hit").count() == 0


def test_rasters_and_stored_series(spark, tmp_path, monkeypatch):
    asked = spark.createDataFrame([("h18v04", "2024-01-01"), ("h18v04", "2024-01-08"), ("h18v04", "2024-01-01")], "tile string, date string").withColumn("date", F.to_date("date"))

    def read(tile, date):
        if date.day == 8:
            raise OSError("broken")
        return pd.DataFrame({"row": [1], "col": [2], "value": [50], "persistence": [0]})

    assert [tuple(r)[2:] for r in remote.fetch_rasters(asked, read).collect()] == [(1, 2, 50, 0)]

    paths = config.Paths(tmp_path / "data").make()
    way = {"type": "way", "id": 1, "tags": {"piste:type": "downhill"}}
    line = [[11.0, 47.0], [11.001, 47.0]]
    paths.raw("runs").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": way, "geometry": {"type": "LineString", "coordinates": line}}]}))
    px = snow.run_pixels(shapes(spark, "id", ("r", "LineString", line))).select("tile", "row", "col")
    px.select("tile", F.to_date(F.lit("2024-01-01")).alias("date"), "row", "col", F.lit(70).alias("value"), F.lit(0).alias("persistence")).write.parquet(f"{tmp_path}/rasters")
    stats = cli.fetch_snow(spark, paths, f"{tmp_path}/series", f"{tmp_path}/rasters", "2024-01-01", "2024-01-08", "full")
    assert stats["tiles"] == 1 and stats["pixels"] == px.count() and stats["weeks"] == 2 * px.count()
    held = snow.long_form(spark.read.parquet(f"{tmp_path}/series")).where("snow is not null")
    assert {(r.week, r.snow) for r in held.collect()} == {(1, 70), (2, snow.MISSING_RECENT)}
    assert cli.fetch_snow(spark, paths, f"{tmp_path}/series", "", "", "", "none", stats_only=True) == stats
    assert remote.stats_text({"pixels": 1234567, "size_bytes": 2_500_000}) == "pixels: 1,234,567\nsize: 2.5 MB"


def test_caches_are_cleared_when_asked(spark, tmp_path, capsys):
    for name in ("x", "y"):
        Cache(spark, f"file://{tmp_path}/{name}", "string").set_many(spark.createDataFrame([("k", "v")], "key string, value string"), 1)
    assert cli.clear_caches(spark, tmp_path, ask=lambda _: "n") == 0
    assert cli.clear_caches(spark, tmp_path, ask=lambda _: "y") == 2 and cli.clear_caches(spark, tmp_path, sure=True) == 0
    assert "x: 1" in capsys.readouterr().out


def test_tile_commands(tmp_path):
    made = remote.tile_commands(config.Paths(tmp_path), {"runs": (9, 15)})
    assert made[0][:3] == ["tippecanoe", "-Q", "-f"] and "9" in made[0] and made[0][-1].endswith("mapboxgl_runs.geojson") and len(made) == 3


def test_positions_in_metres_and_ids(spark):
    row = shapes(spark, "k", ("l", "LineString", [[10.0, 45.0], [0.0, 0.0]])).select(geo.to_sinusoidal(F.col("geometry")).alias("g"), geo.sinusoidal(F.lit(10.0), F.lit(45.0)).alias("s"), ids.unique_id().alias("u")).first()
    assert row.g.parts[0] == [[row.s.x, row.s.y], [0.0, 0.0]] and row.g.type == "LineString" and len(row.u) == 36
