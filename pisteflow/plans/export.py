"""Outputs: CSV rows, map-layer features and GeoPackage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import csvtext, geo, vocab
from pisteflow.functions.jsnum import js_round, number_text, to_fixed
from pisteflow.functions.reduce import nonzero
from pisteflow.sources.sinks import feature_json, json_list, merged_json, place_text, with_nulls

#: K4: columns of the CSV files, fixed values.
CSV_HEADERS = {
    "run": "name,ref,countries,regions,localities,ski_area_names,difficulty,color,oneway,lit,gladed,patrolled,grooming,uses,inclined_length_m,descent_m,ascent_m,average_pitch_%,max_pitch_%,min_elevation_m,max_elevation_m,difficulty_convention,wikidata_id,websites,{site},id,geometry,lat,lng,ski_area_ids,sources,description",
    "lift": "name,ref,ref_fr_cairn,lift_type,status,access,countries,regions,localities,ski_area_names,oneway,duration_sec,capacity,occupancy,detachable,bubble,heating,inclined_length_m,vertical_m,speed_m_per_s,vertical_speed_m_per_s,min_elevation_m,max_elevation_m,overall_pitch_%,wikidata_id,websites,{site},id,geometry,lat,lng,ski_area_ids,sources,description",
    "skiArea": "name,countries,regions,localities,status,has_downhill,has_nordic,downhill_distance_km,nordic_distance_km,vertical_m,min_elevation_m,max_elevation_m,lift_count,surface_lifts_count,run_convention,wikidata_id,websites,{site},id,geometry,lat,lng,sources",
    "spot": "id,spot_type,longitude,latitude,sources,ski_areas,countries,regions,localities,dismount,name,position,entry,exit",
}
CSV_HEADERS = {k: v.replace("{site}", csvtext.SITE_NAME) for k, v in CSV_HEADERS.items()}
#: K27.
CSV_FILES = {"skiArea": "ski_areas.csv", "run": "runs.csv", "lift": "lifts.csv", "spot": "spots.csv"}
#: Zoom range of each map layer.
TILE_ZOOMS = {"ski_areas": (5, 15), "runs": (9, 15), "lifts": (0, 15), "spots": (9, 15)}


def run_elevation(geometry: Column) -> Column:
    """Inclined length, descent, ascent, pitches and extremes of a 3-D line; null without elevations."""
    line = geometry["parts"][0]
    z = F.transform(line, geo.elevation)
    known = (geometry["type"] == "LineString") & F.forall(z, lambda v: v.isNotNull()) & (F.size(line) > 1)
    steps = F.zip_with(F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.struct((geo.haversine_km(a[0], a[1], b[0], b[1]) * 1000).alias("h"), (F.get(b, 2) - F.get(a, 2)).alias("v")))
    total = lambda f: F.aggregate(F.transform(steps, f), F.lit(0.0), lambda s, x: s + x)
    run = total(lambda s: s["h"])
    pitch = lambda s: F.when(s["h"] > 0, F.abs(s["v"]) / s["h"])
    made = F.struct(
        total(lambda s: F.sqrt(s["h"] * s["h"] + s["v"] * s["v"])).alias("inclined"),
        total(lambda s: F.greatest(-s["v"], F.lit(0.0))).alias("descent"),
        total(lambda s: F.greatest(s["v"], F.lit(0.0))).alias("ascent"),
        F.when(run > 0, total(lambda s: F.abs(s["v"])) / run).alias("average_pitch"),
        F.array_max(F.transform(steps, pitch)).alias("max_pitch"),
        F.array_min(z).alias("lowest"),
        F.array_max(z).alias("highest"),
    )
    return F.when(known, made)


def lift_elevation(geometry: Column, duration: Column) -> Column:
    """Inclined length, vertical, speeds, extremes and overall pitch of a 3-D lift."""
    line = geometry["parts"][0]
    z = F.transform(line, geo.elevation)
    known = (geometry["type"] == "LineString") & F.forall(z, lambda v: v.isNotNull()) & (F.size(line) > 1)
    level = geo.line_km(line) * 1000
    vertical = F.abs(F.element_at(z, -1) - F.element_at(z, 1))
    inclined = F.sqrt(level * level + vertical * vertical)
    takes = F.when(duration > 0, duration)
    made = F.struct(inclined.alias("inclined"), vertical.alias("vertical"), (inclined / takes).alias("speed"), (vertical / takes).alias("vertical_speed"), F.array_min(z).alias("lowest"), F.array_max(z).alias("highest"), F.when(level > 0, vertical / level).alias("pitch"))
    return F.when(known, made)


def colour_name(convention: Column, difficulty: Column) -> Column:
    out = F.lit("grey")
    for rule, colours in vocab.RUN_COLOURS.items():
        for level, colour in colours.items():
            out = F.when((convention == rule) & (difficulty == level), colour).otherwise(out)
    return out


def colour_value(name: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in vocab.COLOUR_VALUES.items() for x in kv)), name)


def csv_run() -> Column:
    """F32. Input columns: those of a formatted run, and areas array<struct<id, name>>."""
    e = run_elevation(F.col("geometry"))
    c = F.col
    return csvtext.row([
        csvtext.escape(c("name")), csvtext.escape(c("ref")), *csvtext.places(c("places")), csvtext.area_names(c("areas")),
        c("difficulty"), colour_name(c("difficultyConvention"), c("difficulty")), csvtext.yes_no(c("oneway")), csvtext.yes_no(c("lit")), csvtext.yes_no(c("gladed")), csvtext.yes_no(c("patrolled")),
        c("grooming"), F.array_join("uses", ";"), to_fixed(e["inclined"], 0), to_fixed(e["descent"], 0), to_fixed(e["ascent"], 0), to_fixed(e["average_pitch"], 2), to_fixed(e["max_pitch"], 2),
        to_fixed(e["lowest"], 0), to_fixed(e["highest"], 0), c("difficultyConvention"), csvtext.escape(c("wikidataID")), csvtext.websites(c("websites")), csvtext.feature_url(c("id")), c("id"),
        *csvtext.geometry_cells(c("geometry")), csvtext.area_ids(c("areas")), csvtext.source_urls(c("sources")), csvtext.escape(c("description")),
    ])


def _plain(value: Column) -> Column:
    """A number as text, zero and null as nothing."""
    return number_text(nonzero(value.cast("double")))


def csv_lift() -> Column:
    """F32."""
    c = F.col
    e = lift_elevation(c("geometry"), c("duration"))
    return csvtext.row([
        csvtext.escape(c("name")), csvtext.escape(c("ref")), csvtext.escape(c("refFRCAIRN")), c("liftType"), c("status"), c("access"), *csvtext.places(c("places")), csvtext.area_names(c("areas")),
        csvtext.yes_no(c("oneway")), _plain(c("duration")), _plain(c("capacity")), _plain(c("occupancy")), csvtext.yes_no(c("detachable")), csvtext.yes_no(c("bubble")), csvtext.yes_no(c("heating")),
        to_fixed(e["inclined"], 0), to_fixed(e["vertical"], 0), to_fixed(e["speed"], 1), to_fixed(e["vertical_speed"], 2), to_fixed(e["lowest"], 0), to_fixed(e["highest"], 0), to_fixed(e["pitch"], 2),
        csvtext.escape(c("wikidataID")), csvtext.websites(c("websites")), csvtext.feature_url(c("id")), c("id"), *csvtext.geometry_cells(c("geometry")), csvtext.area_ids(c("areas")),
        csvtext.source_urls(c("sources")), csvtext.escape(c("description")),
    ])


def distance(stats: Column, activity: str) -> Column:
    """length over all difficulties of an activity; null where it isn't there."""
    levels = F.try_element_at(stats["runs"]["byActivity"], F.lit(activity))["byDifficulty"]
    return F.when(levels.isNotNull(), F.aggregate(F.map_values(levels), F.lit(0.0), lambda s, x: s + F.coalesce(x["lengthInKm"], F.lit(0.0))))


def lift_count(stats: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """F35."""
    of = stats["lifts"]["byType"]
    chosen = of if kinds is None else F.map_filter(of, lambda k, _: k.isin(*kinds))
    return F.coalesce(F.aggregate(F.map_values(chosen), F.lit(0).cast("long"), lambda s, x: s + x["count"]), F.lit(0).cast("long"))


def csv_ski_area() -> Column:
    """F32. Input columns: those of an area, and statistics."""
    c, s = F.col, F.col("statistics")
    low, high = nonzero(s["minElevation"]), nonzero(s["maxElevation"])
    whole = lambda x: js_round(x).cast("string")
    positive = lambda n: F.when(n > 0, n.cast("string"))
    return csvtext.row([
        csvtext.escape(c("name")), *csvtext.places(c("places")), c("status"), csvtext.yes_no(F.array_contains("activities", "downhill")), csvtext.yes_no(F.array_contains("activities", "nordic")),
        whole(distance(s, "downhill")), whole(distance(s, "nordic")), whole(high - low), whole(low), whole(high), positive(lift_count(s)), positive(lift_count(s, vocab.SURFACE_LIFTS)),
        c("runConvention"), csvtext.escape(c("wikidataID")), csvtext.websites(c("websites")), csvtext.feature_url(c("id")), c("id"), *csvtext.geometry_cells(c("geometry")), csvtext.source_urls(c("sources")),
    ])


def csv_spot() -> Column:
    """F33."""
    c = F.col
    p = F.col("geometry.parts")[0][0]
    station, crossing = c("spotType") == "lift_station", c("spotType") == "crossing"
    only = lambda cond, x: F.when(cond, x)
    return csvtext.row([
        c("id"), csvtext.escape(c("spotType")), to_fixed(p[0], 6), to_fixed(p[1], 6), csvtext.source_urls(c("sources")), csvtext.area_names(c("areas")), *csvtext.places(c("places")),
        only(crossing, csvtext.escape(c("dismount"))), only(station, csvtext.escape(c("name"))), only(station, csvtext.escape(c("position"))), only(station, csvtext.yes_no(c("entry"))), only(station, csvtext.yes_no(c("exit"))),
    ])


CSV_ROWS = {"run": csv_run, "lift": csv_lift, "skiArea": csv_ski_area, "spot": csv_spot}


def csv_lines(df: DataFrame, kind: str) -> DataFrame:
    return df.select(CSV_ROWS[kind]().alias("line"))


# -- map layers ----------------------------------------------------------------------------------


def map_use(use: Column) -> Column:
    """F30."""
    return F.when(use.isin("downhill", "nordic", "skitour"), use).otherwise("other")


def use_offsets(uses: Column) -> Column:
    """map of use to line offset, i - (n - 1) / 2 over sorted unique uses."""
    kinds = F.array_sort(F.array_distinct(F.transform(uses, map_use)))
    half = (F.size(kinds) - 1) / 2
    return F.map_from_entries(F.transform(kinds, lambda u, i: F.struct(u.alias("use"), (i - half).cast("double").alias("offset"))))


def short_name(name: Column) -> Column:
    """of a long name, what stands before a bracket."""
    return F.when(F.length(name) > 20, F.trim(F.split_part(name, F.lit("("), F.lit(1)))).otherwise(name)


def name_with_ref(name: Column, ref: Column) -> Column:
    """either, or both with a dash between."""
    return F.when(ref.isNull(), name).when(name.isNull(), ref).otherwise(F.concat(ref, F.lit(" - "), name))


def _area_ids() -> Column:
    return F.transform("areas", lambda a: a["id"]).alias("skiAreas")


def map_runs(df: DataFrame) -> DataFrame:
    """runs that aren't only connections; offsets of uses that a run has."""
    shown = df.where(~F.forall("uses", lambda u: u == "connection"))
    name = colour_name(F.col("difficultyConvention"), F.col("difficulty"))
    offset = lambda u: F.try_element_at(use_offsets(F.col("uses")), F.lit(u)).alias(u)
    named = F.struct("id", name_with_ref(F.col("name"), F.col("ref")).alias("name"), "difficulty", "oneway", "lit", "gladed", "patrolled", colour_value(name).alias("color"), name.alias("colorName"), "grooming", "snowmaking", "snowfarming", "tunnel", _area_ids())
    offsets = F.struct(*(offset(u) for u in ("downhill", "nordic", "skitour", "other")))
    return shown.select("geometry", merged_json(with_nulls(named), F.to_json(offsets)).alias("properties"))


def map_lifts(df: DataFrame) -> DataFrame:
    """F25."""
    kind = F.try_element_at(F.create_map(*(F.lit(x) for kv in vocab.LIFT_NAMES.items() for x in kv)), F.col("liftType"))
    name = F.when(F.col("name").isNotNull(), F.concat(F.col("name"), F.lit(" ("), kind, F.lit(")"))).otherwise(kind)
    colour = F.when(F.col("status") == "operating", vocab.LIFT_COLOURS["operating"]).otherwise(vocab.LIFT_COLOUR_OTHER)
    props = F.struct("id", name_with_ref(name, F.col("ref")).alias("name_and_type"), colour.alias("color"), "status", "access", F.col("station_ids").alias("stationIds"), _area_ids(), "tunnel")
    return df.select("geometry", with_nulls(props).alias("properties"))


def spot_properties() -> Column:
    """JSON text of what only some kinds of spots have; null for the others."""
    station = with_nulls(F.struct("name", "liftId", "position", "entry", "exit"))
    return F.when(F.col("spotType") == "lift_station", station).when(F.col("spotType") == "crossing", with_nulls(F.struct("dismount")))


def map_spots(df: DataFrame) -> DataFrame:
    """a spot's kind decides which properties it has."""
    return df.select("geometry", merged_json(with_nulls(F.struct("id", "spotType", _area_ids())), spot_properties()).alias("properties"))


def map_ski_areas(df: DataFrame) -> DataFrame:
    """One point for each part; flags only where true."""
    from pisteflow.operators.kernels import central

    s = F.col("statistics")
    flag = lambda a: F.when(F.array_contains("activities", a), True).alias(f"has_{a}")
    low, high = nonzero(s["minElevation"]), nonzero(s["maxElevation"])
    props = F.struct("id", short_name(F.col("name")).alias("name"), "status", js_round(distance(s, "downhill")).alias("downhillDistance"), js_round(distance(s, "nordic")).alias("nordicDistance"), js_round(high).alias("maxElevation"), js_round(high - low).alias("vertical"))
    pts = central(F.col("geometry"))
    kind = F.when(F.size(pts) > 1, "MultiPoint").otherwise("Point")
    return df.select(F.struct(kind.alias("type"), F.array(pts).alias("parts"), F.array(F.lit(0)).alias("poly")).alias("geometry"), merged_json(with_nulls(props), F.to_json(F.struct(flag("downhill"), flag("nordic")))).alias("properties"))


MAP_LAYERS = {"skiArea": map_ski_areas, "run": map_runs, "lift": map_lifts, "spot": map_spots}

# -- GeoJSON -------------------------------------------------------------------------------------


def area_properties() -> Column:
    """Properties of a ski area."""
    return F.struct("id", F.lit("skiArea").alias("type"), "name", "status", "activities", "sources", "websites", "wikidataID", "places", "runConvention", "viewportHint", "statistics")


def summary_json() -> Column:
    """A ski area as the feature that is nested in others."""
    return feature_json(F.col("geometry"), F.struct("id", "name", "activities", F.lit("skiArea").alias("type"), "status"))


def features(df: DataFrame, kind: str) -> DataFrame:
    """(geometry, properties) with ski areas, and for lifts stations, nested as features.

    df: a layer's columns, areas array<struct<id, name, feature>>, for lifts stations array<string>,
    for runs, where it is known, snowCoverHistory.
    """
    areas = F.concat(F.lit('{"skiAreas":'), json_list(F.transform("areas", lambda a: a["feature"])), F.lit("}"))
    own = {
        "run": ("type", "uses", "id", "name", "ref", "description", "difficulty", "difficultyConvention", "oneway", "lit", "gladed", "patrolled", "snowmaking", "snowfarming", "tunnel", "grooming", "status", "sources", "websites", "wikidataID", "places", "viewportHint", "elevationProfile"),
        "lift": ("type", "id", "name", "liftType", "status", "ref", "refFRCAIRN", "description", "access", "oneway", "occupancy", "capacity", "duration", "bubble", "heating", "detachable", "tunnel", "sources", "websites", "wikidataID", "places", "viewportHint"),
        "spot": ("type", "id", "spotType", "sources", "places", "viewportHint"),
    }[kind]
    parts = [with_nulls(F.struct(*own)), areas]
    if kind == "lift":
        parts.append(F.concat(F.lit('{"stations":'), json_list(F.coalesce("stations", F.array().cast("array<string>"))), F.lit("}")))
    if kind == "spot":
        parts.append(spot_properties())
    if kind == "run" and "snowCoverHistory" in df.columns:
        parts.append(F.to_json(F.struct("snowCoverHistory")))
    return df.select("geometry", merged_json(*parts).alias("properties"))


# -- GeoPackage ----------------------------------------------------------------------------------


def _package_places() -> list[Column]:
    of = {"country_codes": "iso3166_1Alpha2", "region_codes": "iso3166_2", "countries": "localized.en.country", "regions": "localized.en.region", "localities": "localized.en.locality"}
    return [place_text(F.col("places"), path).alias(name) for name, path in of.items()]


def _package_areas() -> list[Column]:
    names = F.filter(F.transform("areas", lambda a: a["name"]), lambda n: n != "")
    return [F.array_join(F.transform("areas", lambda a: a["id"]), ",").alias("ski_area_ids"), F.array_join(names, ",").alias("ski_area_names")]


def package_columns(df: DataFrame, kind: str) -> DataFrame:
    """Geometry and a layer's columns, by name, in their published order."""
    c = F.col
    common = [c("id").alias("feature_id"), c("name"), c("status"), F.to_json("sources").alias("sources"), F.to_json("websites").alias("websites"), c("wikidataID").alias("wikidata_id"), *_package_places()] if kind != "spot" else []
    own = {
        "skiArea": lambda: [F.array_join("activities", ",").alias("activities"), c("statistics.minElevation").alias("min_elevation"), c("statistics.maxElevation").alias("max_elevation"), F.to_json("statistics").alias("statistics"), c("runConvention").alias("run_convention")],
        "lift": lambda: [c("liftType").alias("lift_type"), c("access"), c("ref"), c("refFRCAIRN").alias("ref_fr_cairn"), c("description"), c("oneway"), c("occupancy"), c("capacity"), c("duration"), c("detachable"), c("bubble"), c("heating"), *_package_areas()],
        "run": lambda: [
            F.array_join("uses", ",").alias("uses"), c("ref"), c("description"), c("difficulty"), c("difficultyConvention").alias("difficulty_convention"), c("oneway"), c("lit"), c("gladed"), c("patrolled"), c("snowmaking"), c("snowfarming"), c("grooming"),
            F.array_join(F.transform("elevationProfile.heights", number_text), ",").alias("elevation_profile_heights"), c("elevationProfile.resolution").alias("elevation_profile_resolution"), *_package_areas(),
        ],
        "spot": lambda: [c("id").alias("feature_id"), c("spotType").alias("spot_type"), F.to_json("sources").alias("sources"), *_package_areas(), *_package_places(), c("dismount"), c("name"), c("position"), c("entry"), c("exit")],
    }[kind]()
    return df.select("geometry", *common, *own)


def points_of_areas(df: DataFrame) -> DataFrame:
    """K5: ski areas once more, at their centroids."""
    c = geo.centroid(F.col("geometry"))
    return df.withColumn("geometry", F.struct(F.lit("Point").alias("type"), F.array(F.array(c)).alias("parts"), F.array(F.lit(0)).alias("poly")))
