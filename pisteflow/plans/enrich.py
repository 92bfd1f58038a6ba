"""Elevation and places from staged tables (E1-E14, J15): distinct quantised keys, then joins."""

from __future__ import annotations

from functools import reduce as fold

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import geo, reduce
from pisteflow.functions.jsnum import round_tenth
from pisteflow.operators.relational import country_and_region

#: Geohash lengths of elevation and place keys, and the sampling distance of places (km).
ELEVATION_KEY, PLACE_KEY, PLACE_KM = 10, 6, 1.0


def elevation_keys(df: DataFrame) -> DataFrame:
    """Distinct keys of all positions of 2-D geometries, with the place of each."""
    flat = df.select(F.explode(geo.positions(F.col("geometry"))).alias("p")).where("size(p) = 2")
    return flat.select(geo.geohash(F.col("p")[0], F.col("p")[1], ELEVATION_KEY).alias("key"), F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat")).groupBy("key").agg(F.min(F.struct("lon", "lat")).alias("p")).select("key", "p.*")


def add_elevations(df: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Geometries get elevations, to a tenth, if all their positions have one.

    table: (key, value). Geometries that are 3-D already stay; one unknown position leaves 2-D.
    """
    flat = df.select(key, F.posexplode("geometry.parts").alias("i", "part")).select(key, "i", F.posexplode("part").alias("j", "p"))
    keyed = flat.withColumn("k", geo.geohash(F.col("p")[0], F.col("p")[1], ELEVATION_KEY))
    found = keyed.join(table.select(F.col("key").alias("k"), F.col("value").cast("double").alias("z")), "k", "left")
    point = F.when(F.size("p") > 2, F.col("p")).otherwise(F.array(F.col("p")[0], F.col("p")[1], round_tenth(F.col("z"))))
    missing = (F.size("p") == 2) & F.col("z").isNull()
    lines = found.groupBy(key, "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", point.alias("p")))), lambda x: x["p"]).alias("line"), F.max(missing).alias("missing"))
    parts = lines.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias("__parts"), F.max("missing").alias("__missing"))
    joined = df.join(parts, key, "left")
    g = F.col("geometry")
    return joined.withColumn("geometry", F.when(F.coalesce(~F.col("__missing"), F.lit(False)), F.struct(g["type"].alias("type"), F.col("__parts").alias("parts"), g["poly"].alias("poly"))).otherwise(g)).drop("__parts", "__missing")


def add_profile(df: DataFrame, table: DataFrame, key: str = "id", target: float = 25.0) -> DataFrame:
    """elevationProfile of lines; null if one of its points is unknown."""
    lines = df.where("geometry.type = 'LineString'").withColumn("__p", geo.profile_points(F.col("geometry.parts")[0], target))
    flat = lines.select(key, F.col("__p.resolution").alias("resolution"), F.posexplode("__p.points").alias("i", "p"))
    found = flat.withColumn("k", geo.geohash(F.col("p")[0], F.col("p")[1], ELEVATION_KEY)).join(table.select(F.col("key").alias("k"), F.col("value").cast("double").alias("z")), "k", "left")
    made = found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", round_tenth(F.col("z")).alias("z")))), lambda x: x["z"]).alias("heights"), F.first("resolution").alias("resolution"), F.max(F.col("z").isNull()).alias("missing"))
    profile = made.where("not missing").select(key, F.struct("heights", "resolution", F.lit(target).alias("targetResolution")).alias("elevationProfile"))
    return df.drop("elevationProfile").join(profile, key, "left")


def sample_tiles(points: DataFrame, tiles: DataFrame, zooms: tuple[int, ...], size: int = 512, decoder: str = "mapbox", key: str = "key") -> DataFrame:
    """Elevations of points (key, lon, lat) from pixels (z, x, y, px, py, r, g, b).

    Zooms are tried in order: a point takes the first zoom at which all four pixels are there.
    """
    decode = {"mapbox": geo.decode_mapbox, "terrarium": geo.decode_terrarium}[decoder]
    each = []
    for rank, zoom in enumerate(zooms):
        asked = points.select(key, F.explode(geo.corners(geo.tile_pixel(F.col("lon"), F.col("lat"), zoom, size), zoom, size)).alias("c")).select(key, "c.*")
        seen = asked.join(tiles.where(F.col("z") == zoom), ["x", "y", "px", "py"])
        height = decode(F.col("r").cast("double"), F.col("g").cast("double"), F.col("b").cast("double"))
        whole = seen.groupBy(key).agg(F.sum(height * F.col("w")).alias("value"), F.count("*").alias("n")).where("n = 4")
        each.append(whole.select(key, F.lit(rank).alias("rank"), "value"))
    every = fold(lambda a, b: a.union(b), each)
    best = every.groupBy(key).agg(F.min_by("value", "rank").alias("value"))
    return points.select(key).join(best, key, "left")


def decode_tiles(images: DataFrame) -> DataFrame:
    """Raw RGB tiles (z, x, y, width, rgb) to pixel rows; tiles marked missing have none."""
    n = F.col("width")
    pixel = F.explode(F.sequence(F.lit(0), n * n - 1)).alias("k")
    at = lambda o: F.conv(F.hex(F.substring(F.col("rgb"), F.col("k") * 3 + 1 + o, F.lit(1))), 16, 10).cast("int")
    flat = images.where("not coalesce(missing, false)").select("z", "x", "y", "width", "rgb", pixel)
    return flat.select("z", "x", "y", (F.col("k") % F.col("width")).cast("int").alias("px"), F.floor(F.col("k") / F.col("width")).cast("int").alias("py"), at(0).alias("r"), at(1).alias("g"), at(2).alias("b"))


def place_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, place key) sampled along geometries."""
    return df.select(key, F.explode(geo.points_each_km(F.col("geometry"), PLACE_KM)).alias("p")).select(key, geo.geohash(F.col("p")[0], F.col("p")[1], PLACE_KEY).alias("place_key")).distinct()


def add_places(df: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Unique, sorted places along each feature; table: (key, place)."""
    found = place_keys(df, key).join(table.select(F.col("key").alias("place_key"), "place"), "place_key").where("place is not null")
    kind = table.schema["place"].dataType.simpleString()
    per = found.groupBy(key).agg(F.array_sort(F.collect_set(F.to_json("place"))).alias("j"))
    made = per.select(key, reduce.sorted_places(reduce.unique_places(F.transform("j", lambda x: F.from_json(x, kind)))).alias("__places"))
    return df.join(made, key, "left").withColumn("places", F.coalesce("__places", "places")).drop("__places")


def photon_places(responses: DataFrame, iso: DataFrame) -> DataFrame:
    """(key, place) of geocoder properties (key, countrycode, state, county, city, locality)."""
    named = country_and_region(responses, iso)
    en = F.struct("country", "region", F.coalesce("city", "locality").alias("locality"))
    place = F.struct(F.upper("countrycode").alias("iso3166_1Alpha2"), F.col("region_code").alias("iso3166_2"), F.struct(en.alias("en")).alias("localized"))
    return named.select("key", F.when(F.col("countrycode").isNotNull(), place).alias("place"))


def hierarchy_place(levels: Column) -> Column:
    """Place of array<struct<placetype, name, name_en, iso>>; the first of each kind, English first."""
    first = lambda kind: F.get(F.filter(levels, lambda x: x["placetype"] == kind), 0)
    name = lambda kind: F.coalesce(first(kind)["name_en"], first(kind)["name"])
    en = F.struct(name("country").alias("country"), name("region").alias("region"), name("locality").alias("locality"))
    return F.when(first("country").isNotNull(), F.struct(first("country")["iso"].alias("iso3166_1Alpha2"), first("region")["iso"].alias("iso3166_2"), F.struct(en.alias("en")).alias("localized")))
