"""Command line: prepare, merge, download, snow cover, caches, one place."""

from __future__ import annotations

import argparse
import json
import urllib.request
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pisteflow.plans import export, formatters, snow
from pisteflow.plans import prepare as plans
from pisteflow.plans.lineage import materialize
from pisteflow.sources import config, geojson, remote
from pisteflow.sources.cache import Cache


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pisteflow")
    commands = parser.add_subparsers(dest="command", required=True)
    prepare = commands.add_parser("prepare", help="raw layers to areas, statistics and files")
    prepare.add_argument("--elevation", help="Parquet table of key and value")
    prepare.add_argument("--places", help="Parquet table of key and place")
    prepare.add_argument("--snow-cover", help="Parquet table of weekly pixel series")
    merge = commands.add_parser("merge", help="outputs of several directories into one")
    merge.add_argument("target")
    merge.add_argument("directories", nargs="+")
    download = commands.add_parser("download", help="raw layers by query")
    download.add_argument("endpoint")
    download.add_argument("second_endpoint")
    download.add_argument("second_source")
    clear = commands.add_parser("clear-cache", help="list the caches of a folder, ask, and delete them")
    clear.add_argument("path")
    clear.add_argument("--yes", action="store_true", help="don't ask")
    fetch = commands.add_parser("fetch-snow", help="weeks that pixels of runs lack, from staged rasters into the stored series")
    fetch.add_argument("series", help="folder of the stored series (Parquet)")
    fetch.add_argument("rasters", help="Parquet table of tile, date, row, col, value and persistence")
    fetch.add_argument("--start", required=True)
    fetch.add_argument("--end", required=True)
    fetch.add_argument("--stats", action="store_true", help="only say what is stored")
    place = commands.add_parser("geocode", help="what the geocoder says about a position")
    place.add_argument("lon", type=float)
    place.add_argument("lat", type=float)
    ns = parser.parse_args(args)
    settings = config.from_environment()
    paths = config.Paths(Path(settings.working_dir), out=Path(settings.output_dir))
    if ns.command == "download":
        for group in config.download_plan(paths, (ns.endpoint, ns.second_endpoint), ns.second_source, settings.bbox):
            for url, path in group:
                config.download(url, str(path))
        return 0
    if ns.command == "geocode":
        if settings.geocoder is None:
            parser.error("GEOCODING_SERVER_URL isn't set")
        with urllib.request.urlopen(remote.geocode_url(settings.geocoder.url, ns.lon, ns.lat), timeout=60) as answer:
            print(json.dumps(json.load(answer), indent=1, ensure_ascii=False))
        return 0
    spark = SparkSession.builder.appName("pisteflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if ns.command == "prepare":
        read = lambda p: spark.read.parquet(p) if p else None
        timer = plans.Timer()
        with timer.phase("convert"):
            plans.convert(spark, paths)
        snow_cover = read(ns.snow_cover) if settings.snow_policy else None
        objects, stats = plans.prepare(spark, paths, read(ns.elevation), read(ns.places), timer, settings.bbox, snow_cover)
        with timer.phase("outputs"):
            plans.outputs(objects, stats, paths, snow_cover)
        if settings.tiles:
            with timer.phase("tiles"):
                for command in remote.tile_commands(paths, export.TILE_ZOOMS):
                    remote.run_command(*command)
        for depth, name, took in timer.took:
            print("  " * depth + f"{name}: {took:.1f} s")
    elif ns.command == "merge":
        print(plans.merge_outputs(spark, ns.directories, ns.target))
    elif ns.command == "fetch-snow":
        print(remote.stats_text(fetch_snow(spark, paths, ns.series, ns.rasters, ns.start, ns.end, settings.snow_policy or "full", ns.stats)))
    else:
        clear_caches(spark, Path(ns.path), ns.yes)
    return 0


def fetch_snow(spark: SparkSession, paths: config.Paths, series: str, rasters: str, start: str, end: str, policy: str, stats_only: bool = False) -> dict[str, int]:
    """Add the weeks that wanted pixels lack to the stored series; figures of what is stored then."""
    stored = spark.read.parquet(series) if Path(series).exists() else spark.createDataFrame([], snow.SERIES)
    if not stats_only:
        weeks = snow.without_codes(snow.long_form(stored))
        runs = formatters.format_runs(geojson.read_features(spark, f"file://{paths.raw('runs').resolve()}"))
        wanted = snow.needed(policy, snow.run_pixels(runs).select("tile", "row", "col").distinct(), stored)
        asked = snow.missing_weeks(wanted, weeks, start, end)
        found = snow.extract(spark.read.parquet(rasters), asked, end)
        new = found.select("tile", "row", "col", F.year("date").alias("year"), (snow.week_index(F.col("date")) + 1).alias("week"), "snow", "persistence")
        made = materialize(snow.to_series(snow.upsert_weeks(weeks.select(new.columns), new)), "series")
        made.write.mode("overwrite").parquet(series)
        stored = made
    return remote.archive_stats(stored)


def clear_caches(spark: SparkSession, folder: Path, sure: bool = False, ask=input) -> int:
    """Say what the caches of a folder hold, ask, and delete them; how many were deleted."""
    found = sorted(p.parent.parent for p in folder.resolve().glob("**/[ab]/_SUCCESS"))
    for path in found:
        files = [p for p in path.rglob("*") if p.is_file()]
        rows = sum(spark.read.parquet(f"file://{p}").count() for p in path.iterdir() if (p / "_SUCCESS").exists())
        print(remote.stats_text({str(path): rows, "size_bytes": sum(p.stat().st_size for p in files)}))
    if not found or not (sure or ask(f"delete {len(found)} caches? ").strip().lower() in ("y", "yes")):
        return 0
    for path in found:
        Cache(spark, f"file://{path}", "string").clear()
    return len(found)


if __name__ == "__main__":
    raise SystemExit(main())
