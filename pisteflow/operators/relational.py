"""Keyed lookups, upserts, deletes and unions of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_sites(features: DataFrame, members: DataFrame, key: str = "id") -> DataFrame:
    """Sites that list a feature's sources, appended to its skiAreas in key order."""
    of = features.select(F.col(key), F.explode("sources").alias("s")).select(key, F.col("s.id").alias("member"))
    sites = of.join(members, "member").groupBy(key).agg(F.array_sort(F.collect_set("site")).alias("__sites"))
    out = features.join(sites, key, "left")
    return out.withColumn("skiAreas", F.array_distinct(F.concat("skiAreas", F.coalesce("__sites", F.array().cast("array<string>"))))).drop("__sites")


def members_of(objects: DataFrame, key: str = "key") -> DataFrame:
    """(ski_area, key) of every object but ski areas."""
    return objects.where(F.col("type") != "skiArea").select(F.explode("ski_areas").alias("ski_area"), key)


def nest_summaries(objects: DataFrame, areas: DataFrame, summary: Column, key: str = "key", area_key: str = "key", out: str = "skiAreas") -> DataFrame:
    """Summaries (of any type) of an object's areas, ordered by area key."""
    links = objects.select(F.col(key).alias("__o"), F.explode("ski_areas").alias("__a"))
    named = areas.select(F.col(area_key).alias("__a"), summary.alias("__s"))
    nested = links.join(named, "__a").groupBy("__o").agg(F.transform(F.array_sort(F.collect_list(F.struct("__a", "__s"))), lambda x: x["__s"]).alias(out))
    joined = objects.drop(out).join(nested, objects[key] == nested["__o"], "left").drop("__o")
    return joined.withColumn(out, F.coalesce(out, F.array().cast(nested.schema[out].dataType)))


def nest_stations(lifts: DataFrame, stations: DataFrame, value: Column, key: str = "key") -> DataFrame:
    """A lift's stations in the order of its list; unknown ones are left out."""
    links = lifts.select(F.col(key).alias("__l"), F.posexplode("station_ids").alias("__p", "__s"))
    named = stations.select(F.col(key).alias("__s"), value.alias("__v"))
    nested = links.join(named, "__s").groupBy("__l").agg(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__v"))), lambda x: x["__v"]).alias("stations"))
    return lifts.drop("stations").join(nested, lifts[key] == nested["__l"], "left").drop("__l")


def without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in the other frame."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def eligible(df: DataFrame, activities: Column, unassigned_only: bool = False) -> DataFrame:
    """Rows sharing an activity (none asked: any), maybe only those in no ski area."""
    out = df.where((F.size(activities) == 0) | F.arrays_overlap("activities", activities))
    return out.where(F.size("ski_areas") == 0) if unassigned_only else out


def lookup(df: DataFrame, cache: DataFrame, key: str, now_ms: int, ttl_ms: int | None = None) -> DataFrame:
    """Value and hit of a cache (key, value, timestamp); entries past their time are misses.

    An entry of just that age is still fresh; a time of 0 means that none ever expires.
    """
    fresh = cache if not ttl_ms or ttl_ms < 0 else cache.where(F.col("timestamp") >= now_ms - ttl_ms)
    held = fresh.select(F.col("key").alias("__k"), F.col("value"), F.lit(True).alias("hit"))
    return df.drop("value", "hit").join(held, df[key] == held["__k"], "left").drop("__k").withColumn("hit", F.coalesce("hit", F.lit(False)))


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The last of each key wins; without an order column, updates beat the base."""
    columns = base.columns
    tagged = base.withColumn("__new", F.lit(0)).unionByName(updates.select(*columns).withColumn("__new", F.lit(1)))
    rank = F.struct("__new", *([order] if order else []))
    rest = [c for c in columns if c not in keys]
    last = tagged.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("r"))
    return last.select(*keys, "r.*").select(*columns)


def update(base: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Named columns take the value of a matching update; others never change."""
    own = [c for c in columns if c in updates.columns]
    new = updates.select(F.col(key).alias("__k"), F.lit(True).alias("__u"), *(F.col(c).alias(f"__{c}") for c in own))
    joined = base.join(new, base[key] == F.col("__k"), "left")
    return joined.select(*(F.when(F.col("__u"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in base.columns))


def delete_cascade(objects: DataFrame, gone: DataFrame, key: str = "key", lists: str = "ski_areas") -> DataFrame:
    """Rows go, and their keys leave every list.

    Only keys that are listed are gathered for a row, so lists stay as short as they are.
    """
    left = objects.join(gone.select(key), key, "left_anti")
    hits = left.select(key, F.explode(lists).alias("__a")).join(gone.select(F.col(key).alias("__a")), "__a", "left_semi").groupBy(key).agg(F.collect_set("__a").alias("__gone"))
    return left.join(hits, key, "left").withColumn(lists, F.when(F.col("__gone").isNull(), F.col(lists)).otherwise(F.filter(lists, lambda a: ~F.array_contains("__gone", a)))).drop("__gone")


def union_first_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """The row of the first frame that has a key; frames may lack columns."""
    tagged = [f.withColumn("__i", F.lit(i)) for i, f in enumerate(frames)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in every.columns if c not in (*keys, "__i")]
    return every.groupBy(*keys).agg(F.min_by(F.struct(*rest), "__i").alias("r")).select(*keys, "r.*")


def cache_size(cache: DataFrame) -> int:
    """A18."""
    return cache.count()


def cache_cleanup(cache: DataFrame, now_ms: int, ttl_ms: int) -> DataFrame:
    """Entries that have not expired."""
    return cache if ttl_ms <= 0 else cache.where(F.col("timestamp") >= now_ms - ttl_ms)


def country_and_region(places: DataFrame, iso: DataFrame) -> DataFrame:
    """Code to country, and state, else county, to region; the codes table is one row a region."""
    countries = iso.select(F.col("iso").alias("__c"), F.col("name").alias("country")).distinct()
    regions = iso.select(F.col("iso").alias("__rc"), F.explode("regions").alias("r")).select("__rc", F.col("r.name").alias("__rn"), F.col("r.iso").alias("region_code"))
    code = F.upper("countrycode")
    out = places.join(countries, code == F.col("__c"), "left").drop("__c")
    for n, part in (("s", "state"), ("t", "county")):
        named = regions.withColumnsRenamed({"region_code": f"__{n}", "__rn": f"__{n}n", "__rc": f"__{n}c"})
        out = out.join(named, (code == F.col(f"__{n}c")) & (F.col(part) == F.col(f"__{n}n")), "left").drop(f"__{n}c", f"__{n}n")
    country = F.when(code == "XK", F.coalesce("country", F.lit("Kosovo"))).otherwise(F.col("country"))
    return out.withColumn("country", country).withColumn("region_code", F.coalesce("__s", "__t")).withColumn("region", F.when(F.col("__s").isNotNull(), F.col("state")).when(F.col("__t").isNotNull(), F.col("county"))).drop("__s", "__t")


def by_tile(pixels: DataFrame) -> DataFrame:
    """J16."""
    return pixels.groupBy("tile").agg(F.array_sort(F.collect_set(F.struct("row", "col"))).alias("pixels"))
