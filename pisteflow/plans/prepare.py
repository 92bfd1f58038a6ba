"""The whole run: raw layers to clustered areas and all output files."""

from __future__ import annotations

import time
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pisteflow.operators import relational, topology
from pisteflow.plans import clustering, enrich, export, formatters, snow
from pisteflow.plans.lineage import materialize, whole_structs
from pisteflow.sources import geojson, osm, sinks
from pisteflow.sources.config import Paths, files_to_merge


class Timer:
    """O1: nested timings of phases and operations."""

    def __init__(self):
        self.took: list[tuple[int, str, float]] = []
        self._depth = 0

    @contextmanager
    def phase(self, name: str):
        began, self._depth = time.perf_counter(), self._depth + 1
        try:
            yield
        finally:
            self._depth -= 1
            self.took.append((self._depth, name, time.perf_counter() - began))

    def slow(self, over_s: float = 1.0) -> list[str]:
        return [n for _, n, s in self.took if s > over_s]


def normalised_runs(runs: DataFrame) -> DataFrame:
    """N1 between the formatter and the rest: lines are merged and joined, all else passes."""
    from pisteflow.functions import geo, ids

    # Written out, because row numbers have to stay the same wherever they are used.
    lines = materialize(runs.where("geometry.type = 'LineString'").withColumn("ordinal", F.monotonically_increasing_id()), "lines")
    own = [c for c in runs.columns if c not in ("id", "geometry", "viewportHint", "ordinal")]
    props = F.to_json(F.struct(*own), {"ignoreNullFields": "false"})
    merged = topology.normalise_runs(lines.select("ordinal", F.col("geometry.parts")[0].alias("coords"), props.alias("props")))
    kind = runs.select(*own).schema
    geometry = F.struct(F.lit("LineString").alias("type"), F.array("coords").alias("parts"), F.array(F.lit(0)).alias("poly"))
    made = merged.select(geometry.alias("geometry"), F.from_json("props", kind).alias("p")).select(ids.feature_id("run", F.col("geometry")).alias("id"), "geometry", "p.*", geo.viewport_hint(F.col("geometry")).alias("viewportHint"))
    rest = runs.where("geometry.type <> 'LineString'").drop("ordinal")
    return made.select(*rest.columns).union(rest)


def convert(spark: SparkSession, paths: Paths) -> list[str]:
    """S3, K2: downloaded OSM JSON of each layer to GeoJSON, where there is some; names of the layers made."""
    made = []
    for layer in paths.layers:
        source = paths.osm_json(layer)
        if source.exists():
            with whole_structs(spark):
                features = osm.to_features(geojson.read_elements(spark, _uri(source)))
                sinks.write_geojson(features, str(paths.raw(layer)))
            made.append(layer)
    return made


def _uri(path: Path) -> str:
    return f"file://{Path(path).resolve()}"


def prepare(
    spark: SparkSession,
    paths: Paths,
    elevation: DataFrame | None = None,
    places: DataFrame | None = None,
    timer: Timer | None = None,
    bbox: tuple[float, float, float, float] | None = None,
    snow_cover: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Phases 2 and 3: read, format, enrich and cluster; (objects, statistics).

    elevation: (key, value); places: (key, place); snow_cover: weekly pixel series. bbox bounds the
    second source, as queries bound the first.
    """
    timer = timer or Timer()
    with whole_structs(spark), timer.phase("prepare"):
        areas = formatters.format_landuse(geojson.read_features(spark, _uri(paths.raw("ski_areas"))))
        second, sites = paths.root / "input_second_source.geojson", paths.root / "input_ski_area_sites.osmjson"
        if second.exists():
            read = geojson.read_features(spark, _uri(second), geojson.SECOND_SOURCE_PROPERTIES)
            areas = areas.unionByName(formatters.format_second_source(geojson.inside_bbox(read, *bbox) if bbox else read))
        runs = formatters.format_runs(geojson.read_features(spark, _uri(paths.raw("runs"))))
        lifts = formatters.format_lifts(geojson.read_features(spark, _uri(paths.raw("lifts"))))
        spots = formatters.format_spots(geojson.read_features(spark, _uri(paths.raw("spots"))))
        if sites.exists():
            read = geojson.read_sites(spark, _uri(sites))
            made = formatters.format_sites(read)
            areas = areas.unionByName(made)
            named = made.select("id", F.col("sources")[0]["id"].alias("osm"))
            links = read.select(F.concat_ws("/", "type", F.col("id").cast("string")).alias("osm"), F.explode("members").alias("m")).join(named, "osm").select(F.concat_ws("/", "m.type", F.col("m.ref").cast("string")).alias("member"), F.col("id").alias("site")).distinct()
            runs, lifts, spots = (relational.attach_sites(df, links) for df in (runs, lifts, spots))
        runs = normalised_runs(runs)
        if elevation is not None:
            runs = enrich.add_profile(enrich.add_elevations(runs, elevation), elevation)
            lifts, spots = (enrich.add_elevations(df, elevation) for df in (lifts, spots))
        if places is not None:
            runs, lifts, spots = (enrich.add_places(df, places) for df in (runs, lifts, spots))
        with timer.phase("cluster"):
            objects, stats = clustering.cluster(clustering.load(areas, runs, lifts, spots), places)
        if snow_cover is not None:
            with timer.phase("snow cover"):
                stats = materialize(with_snow_cover(objects, stats, snow_cover), "statistics")
        return objects, stats


def run_histories(objects: DataFrame, snow_cover: DataFrame) -> DataFrame:
    """C4: (key, snowCoverHistory) of runs that any pixel is known of."""
    pixels = snow.run_pixels(objects.where("type = 'run'"), "key")
    rows = snow.history(pixels, snow.pixel_days(snow.long_form(snow_cover)), ["key"])
    return snow.nested_history(rows, ["key"]).withColumnRenamed("history", "snowCoverHistory")


def with_snow_cover(objects: DataFrame, stats: DataFrame, snow_cover: DataFrame) -> DataFrame:
    """Statistics with the histories of an area's runs, overall and by activity."""
    runs = objects.where("type = 'run'")
    pixels = materialize(snow.run_pixels(runs, "key"), "run-pixels")
    members = runs.select(F.explode("ski_areas").alias("ski_area"), "key", "activities")
    rows = snow.area_statistics(members, pixels, snow.pixel_days(snow.long_form(snow_cover)))
    per = snow.nested_history(rows, ["ski_area", "activity"])
    cover = per.groupBy("ski_area").agg(
        F.max(F.when(F.col("activity") == "overall", F.col("history"))).alias("overall"),
        F.map_from_entries(F.filter(F.array_sort(F.collect_list(F.struct("activity", "history"))), lambda x: x["activity"] != "overall")).alias("byActivity"),
    )
    joined = stats.join(cover, "ski_area", "left")
    s = F.col("statistics")
    nested = F.when(F.col("overall").isNotNull(), F.struct("overall", "byActivity"))
    return joined.select("ski_area", F.struct(*(s[f.name].alias(f.name) for f in stats.schema["statistics"].dataType.fields), nested.alias("snowCover")).alias("statistics"))


def layer(objects: DataFrame, areas: DataFrame, kind: str) -> DataFrame:
    """A layer's objects with their own properties as columns, and what is nested in them."""
    rows = relational.nest_summaries(objects.where(F.col("type") == kind), areas, F.struct("id", "name", export.summary_json().alias("feature")), out="areas")
    if kind == "lift":
        stations = spot_columns(objects.where("type = 'spot' and spot_type = 'lift_station'"))
        base = sinks.with_nulls(F.struct("type", "id", "spotType", "sources", "places", "viewportHint"))
        feature = sinks.feature_json(F.col("geometry"), sinks.merged_json(base, export.spot_properties()), text=True)
        rows = relational.nest_stations(rows, stations, feature)
    if kind == "spot":
        return spot_columns(rows, "areas")
    return _own_columns(rows, kind, "areas", *(("station_ids", "stations") if kind == "lift" else ()))


def _own_columns(rows: DataFrame, kind: str, *more: str) -> DataFrame:
    schema = formatters.layer_schema(rows.sparkSession, kind)
    own = [F.col(f"p.{f.name}") for f in schema.fields if f.name not in ("skiAreas", "stations")]
    return rows.select("key", "geometry", *more, F.from_json("properties", schema).alias("p")).select("key", "geometry", *more, *own)


def spot_columns(rows: DataFrame, *more: str) -> DataFrame:
    """A spot's columns; a station's lift, and its position where no tag tells it, are those found."""
    made = _own_columns(rows, "spot", *more)
    return made.withColumns({"liftId": F.coalesce("stationLift", "liftId"), "position": F.coalesce("position", "stationPosition")}).drop("stationLift", "stationPosition")


def outputs(objects: DataFrame, stats: DataFrame, paths: Paths, snow_cover: DataFrame | None = None) -> None:
    """Phase 4: GeoJSON, map layer and CSV of every layer, and one package of all."""
    paths.make()
    with whole_structs(objects.sparkSession):
        areas = objects.where("type = 'skiArea'").join(stats.withColumnRenamed("ski_area", "key"), "key", "left").withColumn("id", F.col("key"))
        areas = materialize(areas, "areas")
        layers = {kind: materialize(layer(objects, areas, kind), f"{kind}-layer") for kind in ("lift", "run", "spot")}
        if snow_cover is not None:
            layers["run"] = layers["run"].join(run_histories(objects, snow_cover), "key", "left")
        package = sinks.GeoPackage(str(paths.package), fresh=True)
        for kind, name in (("skiArea", "ski_areas"), ("lift", "lifts"), ("run", "runs"), ("spot", "spots")):
            rows = areas if kind == "skiArea" else layers[kind]
            made = areas.select("geometry", sinks.with_nulls(export.area_properties()).alias("properties")) if kind == "skiArea" else export.features(rows, kind)
            sinks.write_geojson(made, str(paths.output(name)))
            sinks.write_geojson(export.MAP_LAYERS[kind](rows), str(paths.output(name, "map")))
            sinks.write_csv(export.csv_lines(rows, kind), str(paths.output(name, "csv")), export.CSV_HEADERS[kind])
            flat = export.package_columns(rows, kind)
            if kind == "skiArea":
                # All areas are points once, so that those which are points come with them.
                package.add(export.points_of_areas(flat), name)
                flat = flat.where("geometry.type <> 'Point'")
            package.add(flat, name)
        package.index()
        package.close()


def merge_outputs(spark: SparkSession, directories: list[str], target: str) -> dict[str, int]:
    """GeoJSON and CSV are appended, packages keep the first row of an id; rows by file."""
    out: dict[str, int] = {}
    Path(target, "csv").mkdir(parents=True, exist_ok=True)
    by_name: dict[str, list[Path]] = {}
    for kind in ("geojson", "csv"):
        for p in files_to_merge(directories, kind):
            by_name.setdefault(f"csv/{p.name}" if kind == "csv" else p.name, []).append(p)
    for name, files in by_name.items():
        lines = [spark.read.text(f"file://{p.resolve()}").withColumn("i", F.lit(i)) for i, p in enumerate(files)]
        if name.endswith(".csv"):
            header = next((p.open().readline().rstrip("\n") for p in files if p.stat().st_size), "")
            rows = [df.where(F.col("value") != header).select(F.col("value").alias("line")) for df in lines]
            out[name] = sinks.write_csv(_stacked(rows), str(Path(target, name)), header)
        else:
            rows = [df.select(F.regexp_replace(F.trim("value"), ",$", "").alias("line")).where(F.col("line").startswith('{"type":"Feature"') & ~F.col("line").startswith('{"type":"FeatureCollection"')) for df in lines]
            out[name] = sinks.write_feature_lines(_stacked(rows), str(Path(target, name)))
    packages = files_to_merge(directories, "gpkg")
    if packages:
        merged = sinks.GeoPackage(str(Path(target, "ski_data.gpkg")))
        for p in packages:
            out |= merged.merge(str(p))
        merged.close()
    return out


def _stacked(frames: list[DataFrame]) -> DataFrame:
    every = frames[0]
    for f in frames[1:]:
        every = every.union(f)
    return every
