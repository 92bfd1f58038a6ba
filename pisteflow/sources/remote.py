"""Services beside the run: elevation and place lookups that fill caches, tiles on disk, other programs.

(E4, E5, E10, E13, E15, E16, V18, K10, O3). Lookups are batch functions over distinct keys that no
cache knows; Spark deals the keys out, so what runs at once is bounded by cores.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pisteflow.sources.cache import Cache

RASTER = "tile string, date date, row int, col int, value int, persistence int"


class Throttled:
    """Says each message once a minute at most."""

    def __init__(self, every_s: float = 60.0, say: Callable[[str], None] = lambda m: print(m, file=sys.stderr), clock: Callable[[], float] = time.monotonic):
        self.every_s, self.say, self.clock = every_s, say, clock
        self.said: dict[str, float] = {}

    def __call__(self, message: str) -> bool:
        now = self.clock()
        if now - self.said.get(message, -self.every_s) < self.every_s:
            return False
        self.said[message] = now
        self.say(message)
        return True


def run_command(*command: str) -> None:
    """O3: run another program; one that fails raises with what it said."""
    done = subprocess.run(command, capture_output=True, text=True, check=False)
    if done.returncode:
        raise RuntimeError(f"{' '.join(command)} ended with {done.returncode}: {done.stderr.strip()}")


def write_whole(path: Path, data: bytes) -> None:
    """A file that is either there in full or not at all."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{os.getpid()}.part")
    part.write_bytes(data)
    os.replace(part, path)


class TileStore:
    """Tiles as files z/x/y of a folder, the least recently used going first.

    A file's time of change is its last use; an empty file says that the server has no such tile.
    """

    def __init__(self, folder: str, most: int, suffix: str = "webp"):
        self.folder, self.most, self.suffix = Path(folder), most, suffix

    def path(self, z: int, x: int, y: int) -> Path:
        return self.folder / str(z) / str(x) / f"{y}.{self.suffix}"

    def get(self, z: int, x: int, y: int) -> bytes | None:
        """The tile; b"" if it is known to be missing, None if nothing is known."""
        path = self.path(z, x, y)
        if not path.exists():
            return None
        os.utime(path)
        return path.read_bytes()

    def put(self, z: int, x: int, y: int, data: bytes) -> None:
        write_whole(self.path(z, x, y), data)
        files = [p for p in self.folder.glob(f"*/*/*.{self.suffix}") if p.stat().st_size]
        for path in sorted(files, key=lambda p: p.stat().st_mtime_ns)[: max(0, len(files) - self.most)]:
            path.unlink()

    def mark_missing(self, z: int, x: int, y: int) -> None:
        write_whole(self.path(z, x, y), b"")

    def fetch(self, z: int, x: int, y: int, url: str, opener: Callable = urllib.request.urlopen) -> bytes | None:
        """The tile from the folder or the server; None where there is none."""
        held = self.get(z, x, y)
        if held is not None:
            return held or None
        try:
            with opener(url.format(z=z, x=x, y=y), timeout=60) as answer:
                data = answer.read()
        except urllib.error.HTTPError as e:
            if e.code not in (204, 404):
                raise
            data = b""
        if data:
            self.put(z, x, y, data)
        else:
            self.mark_missing(z, x, y)
        return data or None


def posted_elevations(url: str, points: Sequence[tuple[float, float]], opener: Callable = urllib.request.urlopen) -> list[float | None]:
    """Heights of (lon, lat) from a server that takes a list of [lat, lon]."""
    body = json.dumps([[lat, lon] for lon, lat in points]).encode()
    asked = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json"}, method="POST")
    with opener(asked, timeout=120) as answer:
        heights = json.loads(answer.read())
    if len(heights) != len(points):
        raise ValueError(f"{len(heights)} heights for {len(points)} points")
    return heights


def with_fallback(at_zoom: Callable[[int, Sequence], list[float | None]], points: Sequence, zooms: Sequence[int]) -> list[float | None]:
    """E5: heights at the first zoom that has one; only open points are asked for again."""
    out: list[float | None] = [None] * len(points)
    for zoom in zooms:
        open_ = [k for k, v in enumerate(out) if v is None]
        if not open_:
            break
        for k, v in zip(open_, at_zoom(zoom, [points[k] for k in open_]), strict=True):
            out[k] = v
    return out


def fill(cache: Cache, wanted: DataFrame, lookup: Callable[[list[str]], list], now_ms: int, batch: int = 1000, at_once: int = 4, most_errors: int = 100, wait_s: float = 10.0) -> DataFrame:
    """Look up the distinct keys of wanted that the cache doesn't know, and store what is found.

    A lookup that fails is tried once more after wait_s. After most_errors failures in a row a task
    asks no more (the keys stay unknown and are asked for next time). Returns (key, value, hit) of
    all wanted keys, misses with null.
    """
    keys = wanted.select("key").distinct()
    known = cache.get_many(keys, "key", now_ms)
    kind = cache.read().schema["value"].dataType.simpleString()

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed, tell = 0, Throttled()

        def one(some: list[str]) -> list | None:
            for again in (True, False):
                try:
                    return lookup(some)
                except Exception as e:  # noqa: BLE001  a service can fail in any way
                    tell(f"lookup failed: {e}")
                    if again:
                        time.sleep(wait_s)
            return None

        with ThreadPoolExecutor(at_once) as pool:
            for frame in frames:
                parts = [frame["key"].iloc[k : k + batch].tolist() for k in range(0, len(frame), batch)]
                for base in range(0, len(parts), at_once):
                    if failed >= most_errors:
                        break
                    some = parts[base : base + at_once]
                    for asked, got in zip(some, pool.map(one, some), strict=True):
                        failed = failed + 1 if got is None else 0
                        if got is not None:
                            yield pd.DataFrame({"key": asked, "value": got})

    found = known.where("not hit").select("key").mapInPandas(ask, f"key string, value {kind}")
    cache.set_many(found, now_ms)
    return cache.get_many(keys, "key", now_ms)


def fetch_rasters(asked: DataFrame, read: Callable[[str, object], pd.DataFrame | None]) -> DataFrame:
    """Raster rows of the distinct (tile, date) that are asked for, some at once.

    read gives (row, col, value, persistence) of a tile on a date, or None where there is no file or
    it can't be read.
    """
    columns = [c.split()[0] for c in RASTER.split(", ")]

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tile, date in zip(frame["tile"], frame["date"], strict=True):
                try:
                    got = read(tile, date)
                except (OSError, ValueError):
                    got = None
                if got is not None and len(got):
                    yield got.assign(tile=tile, date=date)[columns]

    return asked.select("tile", "date").distinct().repartition("tile", "date").mapInPandas(load, RASTER)


def tile_commands(paths, zooms: dict[str, tuple[int, int]], tool: str = "tippecanoe", join: str = "tile-join") -> list[list[str]]:
    """Commands that make vector tiles of the map layers, and join them into one file and folder."""
    out = [[tool, "-Q", "-f", "-o", str(paths.target / f"{layer}.mbtiles"), "-Z", str(lo), "-z", str(hi), "--drop-densest-as-needed", str(paths.output(layer, "map"))] for layer, (lo, hi) in zooms.items()]
    parts = [str(paths.target / f"{layer}.mbtiles") for layer in zooms]
    return [*out, [join, "-f", "--no-tile-size-limit", "-o", str(paths.target / "map.mbtiles"), *parts], [join, "-f", "--no-tile-size-limit", "--output-to-directory", str(paths.target / "map"), *parts]]


def geocode_url(server: str, lon: float, lat: float) -> str:
    """Address of the place at a position."""
    return f"{server}?lon={lon}&lat={lat}&lang=en&limit=1&radius=5"


def stats_text(stats: dict[str, float]) -> str:
    """Figures with thousands separators, bytes as megabytes."""
    line = lambda k, v: f"{k.removesuffix('_bytes')}: {v / 1e6:,.1f} MB" if k.endswith("_bytes") else f"{k}: {v:,}"
    return "\n".join(line(k, v) for k, v in stats.items())


def archive_stats(series: DataFrame) -> dict[str, int]:
    """Tiles, pixels, years and weeks with a value of stored pixel series."""
    weeks = F.aggregate("data", F.lit(0).cast("long"), lambda s, y: s + F.size(F.filter(y["data"], lambda w: F.get(w, 0).isNotNull())))
    return series.agg(F.countDistinct("tile").alias("tiles"), F.count("*").alias("pixels"), F.sum(F.size("data")).alias("years"), F.sum(weeks).alias("weeks")).first().asDict()
