"""Grouping of map objects into ski areas (C1-C32): passes A to F and what follows them.

Objects are one frame with a type. Passes that are order-dependent run the exact sequential search
within connected components of the proximity graph: areas of different components can't influence
each other. Every pass takes its state from a table in the shared folder.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import geo, ids, reduce
from pisteflow.operators import relational, spatial
from pisteflow.operators.graph import connected_components
from pisteflow.plans import statistics
from pisteflow.plans.formatters import convention
from pisteflow.plans.lineage import materialize, whole_structs

#: Radii in metres: of neighbours, of areas to merge into, and of stations on lifts.
NEAR_M, MERGE_M, STATION_M = 500.0, 250.0, 30.0
ALL = ("downhill", "nordic")
COLUMNS = (
    "key", "type", "source", "geometry", "is_polygon", "activities", "ski_areas", "is_basis", "in_polygon", "in_site",
    "lift_type", "difficulty", "spot_type", "station_ids", "status", "name", "snowmaking", "snowfarming", "sources",
    "websites", "wikidataID", "places", "runConvention", "viewportHint", "properties",
)


# -- C1-C5, C28: objects -------------------------------------------------------------------------


def _object(df: DataFrame, kind: str, activities: Column, own: dict[str, Column]) -> DataFrame:
    """Defaults of what a type doesn't have."""
    have = set(df.columns)
    null = lambda t: F.lit(None).cast(t)
    pick = lambda c, t: F.col(c) if c in have else null(t)
    default = {
        "key": F.col("id"), "type": F.lit(kind), "source": F.lit("unknown"), "geometry": F.col("geometry"), "is_polygon": F.lit(False),
        "activities": F.array_distinct(activities), "ski_areas": F.col("skiAreas") if "skiAreas" in have else F.array().cast("array<string>"),
        "is_basis": F.lit(False), "in_polygon": F.lit(False), "in_site": F.size("skiAreas") > 0 if "skiAreas" in have else F.lit(False),
        "lift_type": pick("liftType", "string"), "difficulty": pick("difficulty", "string"), "spot_type": pick("spotType", "string"),
        "station_ids": F.array().cast("array<string>"), "status": pick("status", "string"), "name": pick("name", "string"),
        "snowmaking": pick("snowmaking", "boolean"), "snowfarming": pick("snowfarming", "boolean"), "sources": F.col("sources"),
        "websites": F.col("websites") if "websites" in have else F.array().cast("array<string>"), "wikidataID": pick("wikidataID", "string"),
        "places": F.col("places"), "runConvention": pick("runConvention", "string"), "viewportHint": F.col("viewportHint"),
        "properties": F.to_json(F.struct(*(c for c in df.columns if c not in ("geometry", "ordinal")))),
    }
    return df.select(*((own | {}).get(c, default[c]).alias(c) for c in COLUMNS))


def prepare_ski_areas(df: DataFrame) -> DataFrame:
    """Ski areas of exactly one source."""
    return _object(df.where(F.size("sources") == 1), "skiArea", F.col("activities"), {"source": F.col("sources")[0]["type"], "is_polygon": geo.is_polygon(F.col("geometry")), "ski_areas": F.array().cast("array<string>"), "in_site": F.lit(False)})


def prepare_lifts(df: DataFrame) -> DataFrame:
    """Operating lifts serve downhill."""
    return _object(df, "lift", F.when(F.col("status") == "operating", F.array(F.lit("downhill"))).otherwise(F.array().cast("array<string>")), {})


def prepare_runs(df: DataFrame) -> DataFrame:
    """C4: unpatrolled backcountry outside of sites has no activity; which runs found new areas."""
    wild = (F.size("skiAreas") == 0) & (F.col("grooming") == "backcountry") & ~F.coalesce("patrolled", F.lit(False))
    known = F.array_compact(F.transform("uses", lambda u: F.when(u.isin("downhill", "snow_park"), "downhill").when(u == "nordic", "nordic")))
    activities = F.when(F.coalesce(wild, F.lit(False)), F.array().cast("array<string>")).otherwise(known)
    basis = (F.array_contains("uses", "downhill") | F.array_contains("uses", "nordic")) & (F.size(activities) > 0) & (F.size("skiAreas") == 0)
    return _object(df, "run", activities, {"is_basis": basis})


def prepare_spots(df: DataFrame) -> DataFrame:
    """C5, C28."""
    t = F.col("spotType")
    activities = F.when(t.isin("lift_station", "halfpipe"), F.array(F.lit("downhill"))).when(t.isNotNull(), F.array(*map(F.lit, ALL))).otherwise(F.array().cast("array<string>"))
    return _object(df, "spot", activities, {})


def load(ski_areas: DataFrame, runs: DataFrame, lifts: DataFrame, spots: DataFrame) -> DataFrame:
    """All objects; of equal keys the last type loaded wins, once each."""
    parts = [prepare_ski_areas(ski_areas), prepare_runs(runs), prepare_lifts(lifts), prepare_spots(spots)]
    every = parts[0].withColumn("__rank", F.lit(0))
    for rank, p in enumerate(parts[1:], 1):
        every = every.union(p.withColumn("__rank", F.lit(rank)))
    rest = [c for c in COLUMNS if c != "key"]
    last = every.groupBy("key").agg(F.max_by(F.struct(*rest), F.struct("__rank", "properties")).alias("r"))
    return last.select("key", "r.*").select(*COLUMNS)


# -- geometry of areas ---------------------------------------------------------------------------


def area_point(members: DataFrame, by: str = "ski_area") -> DataFrame:
    """(by, geometry): the mean of all member positions, at most 100 m from one of them."""
    flat = members.select(by, F.explode(geo.open_positions(F.col("geometry"))).alias("p")).select(by, F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
    centre = flat.groupBy(by).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    far = flat.join(centre, by).withColumn("d", geo.haversine_km(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")))
    near = far.groupBy(by).agg(F.min(F.struct("d", "x", "y", "cx", "cy")).alias("n"))
    n = F.col("n")
    spot = F.when(n["d"] > 0.1, geo.towards(n["x"], n["y"], n["cx"], n["cy"], 0.1)).otherwise(F.array(n["cx"], n["cy"]))
    return near.select(by, F.struct(F.lit("Point").alias("type"), F.array(F.array(spot)).alias("parts"), F.array(F.lit(0)).alias("poly")).alias("geometry"))


def member_rows(objects: DataFrame) -> DataFrame:
    """One row for each membership of an object that isn't an area."""
    return objects.where(F.col("type") != "skiArea").withColumn("ski_area", F.explode("ski_areas"))


def activities_of(members: DataFrame) -> DataFrame:
    """C20: (ski_area, activities) of downhill and nordic that members have."""
    each = members.select("ski_area", F.explode("activities").alias("a")).where(F.col("a").isin(*ALL))
    return each.groupBy("ski_area").agg(F.array_sort(F.collect_set("a")).alias("activities"))


def _apply_areas(objects: DataFrame, changes: DataFrame, columns: list[str]) -> DataFrame:
    """Areas take non-null values of changes (ski_area, columns)."""
    new = changes.select(F.col("ski_area").alias("__k"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = objects.join(new, (objects["key"] == new["__k"]) & (objects["type"] == "skiArea"), "left")
    return joined.select(*(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in COLUMNS))


def pass_a(objects: DataFrame) -> DataFrame:
    """Areas without activities take those, and a point, from their members."""
    members = member_rows(objects)
    asked = objects.where("type = 'skiArea' and size(activities) = 0").select(F.col("key").alias("ski_area"))
    found = members.join(asked, "ski_area", "left_semi")
    return _apply_areas(objects, area_point(found).join(activities_of(found), "ski_area", "left"), ["geometry", "activities"])


def mark(objects: DataFrame, found: DataFrame, in_polygon: bool) -> DataFrame:
    """C11: (ski_area, key) memberships are appended in area order; flags follow."""
    new = found.groupBy("key").agg(F.array_sort(F.collect_set("ski_area")).alias("__new")).withColumnRenamed("key", "__k")
    joined = objects.join(new, objects["key"] == new["__k"], "left")
    hit = F.col("__new").isNotNull()
    changed = {
        "ski_areas": F.when(hit, F.array_distinct(F.concat("ski_areas", "__new"))).otherwise(F.col("ski_areas")),
        "in_polygon": F.col("in_polygon") | (hit & F.lit(in_polygon)),
        "is_basis": F.col("is_basis") & ~hit,
    }
    return joined.select(*(changed.get(c, F.col(c)).alias(c) for c in COLUMNS))


def _with_found_activities(objects: DataFrame, found: DataFrame) -> DataFrame:
    """Areas of unknown activities take those of what they were assigned."""
    blank = objects.where("type = 'skiArea' and size(activities) = 0").select(F.col("key").alias("ski_area"))
    members = found.join(objects.where("type <> 'skiArea'").select("key", "activities"), "key").join(blank, "ski_area", "left_semi")
    return _apply_areas(objects, activities_of(members), ["activities"])


def pass_b(objects: DataFrame) -> DataFrame:
    """Polygons take what they hold; empty ones, and those mostly of site relations, go."""
    areas = objects.where("type = 'skiArea' and source = 'openstreetmap' and is_polygon")
    others = objects.where("type <> 'skiArea'")
    wanted = areas.select(F.col("key").alias("ski_area"), F.when(F.size("activities") > 0, F.col("activities")).otherwise(F.array(*map(F.lit, ALL))).alias("wanted"), "geometry")
    inside = spatial.contained(wanted.select("ski_area", "geometry"), others.select("key", "geometry"), "ski_area", "key")
    facts = others.select("key", "type", "activities", "ski_areas", "in_site", geo.weight_km(F.col("geometry")).alias("km"))
    found = inside.join(wanted.drop("geometry"), "ski_area").join(facts, "key").where(F.arrays_overlap("wanted", "activities") & ~F.array_contains("ski_areas", F.col("ski_area")))
    found = materialize(found.select("ski_area", "key", "type", "in_site", "km"), "inside")
    length = lambda cond: F.sum(F.when(F.col("type").isin("lift", "run") & cond, F.col("km")).otherwise(0.0))
    per = found.groupBy("ski_area").agg(F.count("*").alias("n"), length(F.lit(True)).alias("total"), length(F.col("in_site")).alias("site"))
    ratio = areas.select(F.col("key").alias("ski_area")).join(per, "ski_area", "left")
    gone = ratio.where("coalesce(n, 0) = 0 or total > 0 and site / total > 0.5").select(F.col("ski_area").alias("key"))
    kept = found.select("ski_area", "key").join(gone.withColumnRenamed("key", "ski_area"), "ski_area", "left_anti")
    left = relational.delete_cascade(objects, gone)
    return mark(_with_found_activities(left, kept), kept, True)


# -- C10, C16: sequential searches within components ---------------------------------------------


def _search(near: dict[str, list[str]], acts: dict[str, set[str]], start: str, first: list[str], activities: set[str], visited: set[str], allowed) -> list[str]:
    """Keys found from a start, depth first; activities narrow on the way, visits are shared.

    All unvisited neighbours of an object are visited at once, before the search goes on from any.
    """
    found = []
    held = [(start, first, activities)]
    while held:
        _, around, active = held.pop()
        fresh = [k for k in around if k not in visited and acts[k] & active and allowed(k)]
        visited.update(fresh)
        found += fresh
        # The first neighbour is gone into first, with all that follows from it.
        held += [(k, near.get(k, []), (acts[k] & active) or active) for k in reversed(fresh)]
    return found


def _graph(objects: DataFrame, metres: float) -> DataFrame:
    """(a, b) both ways: objects that aren't areas, near each other, sharing an activity."""
    facts = objects.where("type <> 'skiArea' and size(activities) > 0")
    left = facts.select(F.col("key").alias("lkey"), "geometry")
    right = facts.select(F.col("key").alias("rkey"), "geometry")
    pairs = spatial.within_distance(left, right, metres).where("lkey < rkey")
    acts = facts.select("key", "activities")
    both = pairs.join(acts.withColumnsRenamed({"key": "lkey", "activities": "la"}), "lkey").join(acts.withColumnsRenamed({"key": "rkey", "activities": "ra"}), "rkey").where(F.arrays_overlap("la", "ra"))
    return both.select(F.col("lkey").alias("a"), F.col("rkey").alias("b"))


def derived_places(areas: DataFrame, objects: DataFrame) -> DataFrame:
    """(area, lkey, geometry): all geometries of an area's members, or else its own.

    What is near the union of some shapes is near one of them, so they are never united.
    """
    by_member = member_rows(objects).select(F.col("ski_area").alias("area"), "key", "geometry").join(areas.select(F.col("key").alias("area")), "area", "left_semi")
    own = areas.select(F.col("key").alias("area"), "geometry").join(by_member.select("area").distinct(), "area", "left_anti")
    return by_member.select("area", F.concat_ws("|", "area", "key").alias("lkey"), "geometry").union(own.select("area", F.col("area").alias("lkey"), "geometry"))


def assign_greedily(objects: DataFrame, source: str, polygons_only: bool | None, edges: DataFrame | None = None) -> DataFrame:
    """C7 for passes C and E: in key order, each area takes what it reaches and no other has.

    polygons_only: True takes polygons (pass C), False the rest, None all.
    """
    edges = materialize(_graph(objects, NEAR_M), "near") if edges is None else edges
    areas = objects.where((F.col("type") == "skiArea") & (F.col("source") == source) & ~ids.is_placeholder(F.col("geometry")))
    if polygons_only is not None:
        areas = areas.where("is_polygon" if polygons_only else "not is_polygon")
    free = objects.where("type <> 'skiArea' and size(activities) > 0 and size(ski_areas) = 0").select(F.col("key").alias("rkey"), "geometry")
    places = derived_places(areas, objects)
    reach = spatial.within_distance(places.select("lkey", "geometry"), free, NEAR_M).join(places.select("lkey", "area"), "lkey").select("area", F.col("rkey").alias("key")).distinct()
    reach = materialize(reach, "reach")
    open_edges = edges.join(free.select(F.col("rkey").alias("a")), "a", "left_semi").join(free.select(F.col("rkey").alias("b")), "b", "left_semi")
    links = open_edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(reach.select(F.concat(F.lit("area:"), "area"), "key"))
    parts = materialize(connected_components(links), "components")

    acts = objects.select("key", F.concat_ws(",", "activities").alias("acts"))
    rows = (
        reach.select(F.lit("reach").alias("kind"), F.col("area").alias("a"), F.col("key").alias("b"), F.col("key").alias("node"))
        .union(open_edges.select(F.lit("edge"), "a", "b", "a"))
        .join(parts, "node")
        .join(acts.withColumnsRenamed({"key": "a", "acts": "a_acts"}), "a")
        .join(acts.withColumnsRenamed({"key": "b", "acts": "b_acts"}), "b")
        .select("component", "kind", "a", "b", "a_acts", "b_acts")
    )

    def replay(frame: pd.DataFrame) -> pd.DataFrame:
        near: dict[str, list[str]] = {}
        own_reach: dict[str, list[str]] = {}
        known: dict[str, set[str]] = {}
        for r in frame.itertuples():
            known[r.b] = set(filter(None, r.b_acts.split(",")))
            known[r.a] = set(filter(None, r.a_acts.split(",")))
            if r.kind == "reach":
                own_reach.setdefault(r.a, []).append(r.b)
            else:
                near.setdefault(r.a, []).append(r.b)
                near.setdefault(r.b, []).append(r.a)
        near = {k: sorted(v) for k, v in near.items()}
        taken: set[str] = set()
        out = []
        for area in sorted(own_reach):
            wanted = known[area] or set(ALL)
            got = _search(near, known, area, sorted(own_reach[area]), wanted, {area}, lambda k: k not in taken)
            taken.update(got)
            out += [(area, k) for k in got]
        return pd.DataFrame(out, columns=["ski_area", "key"])

    found = materialize(rows.groupBy("component").applyInPandas(replay, "ski_area string, key string"), "assigned")
    return mark(_with_found_activities(objects, found), found, False)


def pass_d(objects: DataFrame) -> DataFrame:
    """Second-source areas near objects of other areas merge into those."""
    areas = objects.where("type = 'skiArea'")
    second = areas.where("source = 'skimap.org'")
    others = objects.where("type <> 'skiArea' and size(ski_areas) > 0")
    near = spatial.within_distance(second.select(F.col("key").alias("lkey"), "geometry"), others.select(F.col("key").alias("rkey"), "geometry"), MERGE_M)
    targets = near.join(others.select(F.col("key").alias("rkey"), F.explode("ski_areas").alias("target")), "rkey").select(F.col("lkey").alias("from"), "target").distinct()
    first = areas.where("source <> 'skimap.org'").select(F.col("key").alias("target"))
    targets = materialize(targets.join(first, "target", "left_semi"), "merges")
    fields = ("geometry", "is_polygon", "activities", "name", "status", "websites", "wikidataID", "sources", "places")
    folded = targets.join(second.select(F.col("key").alias("from"), *fields), "from").groupBy("target").agg(F.array_sort(F.collect_list(F.struct(F.col("from"), F.struct(*(F.to_json(F.struct(c)).alias(c) if c in ("geometry", "places") else F.col(c) for c in fields)).alias("v")))).alias("others"))
    o = F.transform("others", lambda x: x["v"])
    joined = objects.join(folded, objects["key"] == folded["target"], "left")
    geometry_type, places_type = objects.schema["geometry"].dataType, objects.schema["places"].dataType
    geometry = lambda v: F.from_json(v["geometry"], f"geometry {geometry_type.simpleString()}")["geometry"]
    places = lambda v: F.from_json(v["places"], f"places {places_type.simpleString()}")["places"]
    first_of = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.get(F.filter(F.transform(o, lambda v: F.nullif(v[c], F.lit(""))), lambda v: v.isNotNull()), 0))
    placed = F.get(F.filter(F.transform(o, geometry), lambda g: ~ids.is_placeholder(g)), 0)
    from_first = F.forall("sources", lambda s: s["type"] == "openstreetmap") & (F.size("websites") > 0)
    merged = {
        "geometry": F.when(ids.is_placeholder(F.col("geometry")), F.coalesce(placed, F.col("geometry"))).otherwise(F.col("geometry")),
        "activities": F.array_distinct(F.concat("activities", F.flatten(F.transform(o, lambda v: v["activities"])))),
        "name": first_of("name"), "status": first_of("status"), "wikidataID": first_of("wikidataID"),
        "sources": reduce.unique_sources(F.concat("sources", F.flatten(F.transform(o, lambda v: v["sources"])))),
        "places": reduce.unique_places(F.concat("places", F.flatten(F.transform(o, places)))),
        "websites": F.when(from_first, F.col("websites")).otherwise(F.array_distinct(F.concat("websites", F.flatten(F.transform(o, lambda v: v["websites"]))))),
    }
    made = joined.select(*(F.when(F.col("target").isNotNull(), merged[c]).otherwise(F.col(c)).alias(c) if c in merged else F.col(c) for c in COLUMNS))
    return relational.delete_cascade(made, targets.select(F.col("from").alias("key")).distinct())


def pass_f(objects: DataFrame, edges: DataFrame) -> DataFrame:
    """Areas for runs that none took; an area's key is a hash of its members' keys.

    Seeds go in key order. Downhill needs a lift; without one only members of another activity stay.
    """
    seeds = objects.where("type = 'run' and is_basis").select("key")
    links = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(seeds.select(F.col("key").alias("src"), F.col("key").alias("dst")))
    parts = materialize(connected_components(links), "components")
    facts = objects.where("type <> 'skiArea'").select("key", "type", "is_basis", F.concat_ws(",", "activities").alias("acts"))
    nodes = parts.join(facts, parts["node"] == facts["key"]).select("component", F.lit("node").alias("kind"), F.col("key").alias("a"), F.lit("").alias("b"), "type", "is_basis", "acts")
    lines = edges.join(parts, edges["a"] == parts["node"]).select("component", F.lit("edge"), "a", "b", F.lit(""), F.lit(False), F.lit(""))
    wanted = nodes.where("is_basis").select("component").distinct()

    def replay(frame: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        near: dict[str, list[str]] = {}
        acts, kind, basis = {}, {}, []
        for r in frame.itertuples():
            if r.kind == "node":
                acts[r.a] = set(filter(None, r.acts.split(",")))
                kind[r.a] = r.type
                if r.is_basis:
                    basis.append(r.a)
            else:
                near.setdefault(r.a, []).append(r.b)
                near.setdefault(r.b, []).append(r.a)
        near = {k: sorted(v) for k, v in near.items()}
        out, done = [], set()
        for seed in sorted(basis):
            if seed in done:
                continue
            done.add(seed)
            active = acts[seed] & set(ALL)
            members = [seed, *_search(near, acts, seed, near.get(seed, []), active, {seed}, lambda k: True)]
            if "downhill" in active and not any(kind[k] == "lift" for k in members):
                active -= {"downhill"}
                members = [k for k in members if acts[k] & set(ALL) - {"downhill"}]
            if not active or not members:
                continue
            area = hashlib.sha1("|".join(sorted(members)).encode()).hexdigest()
            done.update(members)
            out += [(area, k, ",".join(sorted(active))) for k in members]
        return pd.DataFrame(out, columns=["ski_area", "key", "acts"])

    # A fixed number of partitions: small as the rows are, they'd be coalesced into one task for all components.
    tasks = 4 * objects.sparkSession.sparkContext.defaultParallelism
    found = nodes.union(lines).join(wanted, "component", "left_semi").repartition(tasks, "component").groupBy("component").applyInPandas(replay, "ski_area string, key string, acts string")
    found = materialize(found, "generated")
    members = found.select("ski_area", "key").join(objects.select("key", "geometry", "activities"), "key")
    made = area_point(members).join(found.groupBy("ski_area").agg(F.first("acts").alias("acts")), "ski_area")
    null = lambda c: F.lit(None).cast(objects.schema[c].dataType)
    empty = lambda c: F.array().cast(objects.schema[c].dataType)
    own = {
        "key": F.col("ski_area"), "type": F.lit("skiArea"), "source": F.lit("openstreetmap"), "geometry": F.col("geometry"), "is_polygon": F.lit(False),
        "activities": F.split("acts", ","), "ski_areas": F.array("ski_area"), "is_basis": F.lit(False), "in_polygon": F.lit(False), "in_site": F.lit(False),
        "status": F.lit("operating"), "runConvention": convention(F.col("geometry")), "viewportHint": geo.viewport_hint(F.col("geometry")),
        **{c: empty(c) for c in ("station_ids", "sources", "websites", "places")},
    }
    areas = made.select(*(own[c].alias(c) if c in own else null(c).alias(c) for c in COLUMNS))
    marked = mark(objects, found.select("ski_area", "key"), False)
    return marked.withColumn("is_basis", F.lit(False)).union(areas)


# -- C22-C25: stations, statistics, clean-up -----------------------------------------------------


def station_position(z: Column, heights: Column) -> Column:
    """Bottom or top quarter of the lift, else mid; null without elevations."""
    low, high = F.array_min(heights), F.array_max(heights)
    quarter = (high - low) * 0.25
    known = reduce.nonzero(z).isNotNull() & (F.size(heights) >= 2)
    return F.when(known, F.when(z <= low + quarter, "bottom").when(z >= high - quarter, "top").otherwise("mid"))


def associate_stations(objects: DataFrame) -> DataFrame:
    """Stations snap to the nearest lift within reach, those without one go.

    Ties prefer a lift in a ski area that the station shares.
    """
    stations = objects.where("type = 'spot' and spot_type = 'lift_station'")
    lifts = objects.where("type = 'lift'")
    points = stations.select(F.col("key").alias("lkey"), "geometry", F.col("ski_areas").alias("s_areas"))
    lines = lifts.select(F.col("key").alias("rkey"), "geometry", F.col("ski_areas").alias("l_areas"))
    best = materialize(spatial.nearest(points, lines, STATION_M, F.arrays_overlap("s_areas", "l_areas")), "stations")
    from pisteflow.operators.kernels import snap

    placed = best.join(points.select("lkey", F.col("geometry").alias("sg")), "lkey").join(lines.select("rkey", F.col("geometry").alias("lg")), "rkey")
    z = F.get(F.col("sg.parts")[0][0], 2)
    at = snap(F.col("lg"), F.slice(F.col("sg.parts")[0][0], 1, 2))
    placed = placed.select(F.col("lkey").alias("__k"), F.col("rkey").alias("__lift"), station_position(z, geo.elevations(F.col("lg"))).alias("__position"), F.when(z.isNotNull(), F.array(at[0], at[1], z)).otherwise(F.array(at[0], at[1])).alias("__p"))
    joined = objects.join(placed, (objects["key"] == placed["__k"]) & (objects["type"] == "spot"), "left")
    is_station = (F.col("type") == "spot") & (F.col("spot_type") == "lift_station")
    moved = F.struct(F.lit("Point").alias("type"), F.array(F.array("__p")).alias("parts"), F.array(F.lit(0)).alias("poly"))
    props = F.when(F.col("__lift").isNotNull(), F.concat(F.expr("substring(properties, 1, length(properties) - 1)"), F.lit(","), F.expr("substring(to_json(named_struct('stationLift', __lift, 'stationPosition', __position)), 2)"))).otherwise(F.col("properties"))
    kept = joined.where(~is_station | F.col("__lift").isNotNull())
    out = kept.select(*(F.when(F.col("__lift").isNotNull(), moved).otherwise(F.col(c)).alias(c) if c == "geometry" else props.alias(c) if c == "properties" else F.col(c) for c in COLUMNS))
    lists = best.groupBy(F.col("rkey").alias("__k")).agg(F.array_sort(F.collect_set("lkey")).alias("__s"))
    with_lists = out.join(lists, (out["key"] == lists["__k"]) & (out["type"] == "lift"), "left")
    return with_lists.select(*(F.coalesce("__s", "station_ids").alias(c) if c == "station_ids" else F.col(c) for c in COLUMNS))


def augment(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects, statistics): areas get convention, hint and places of their members.

    Areas without members go, unless a second source knows them.
    """
    members = member_rows(objects)
    stats = statistics.ski_area_statistics(members)
    counts = members.groupBy("ski_area").agg(F.count("*").alias("n"))
    placed = members.select("ski_area", F.explode_outer("places").alias("p")).where("p is not null").groupBy("ski_area").agg(F.array_sort(F.collect_set(F.to_json("p"))).alias("j"))
    kind = objects.schema["places"].dataType.elementType.simpleString()
    places = placed.select("ski_area", reduce.sorted_places(reduce.unique_places(F.transform("j", lambda x: F.from_json(x, kind)))).alias("places"))
    boxes = members.select("ski_area", geo.bbox(F.col("geometry")).alias("b")).groupBy("ski_area").agg(F.min("b.west").alias("w"), F.min("b.south").alias("s"), F.max("b.east").alias("e"), F.max("b.north").alias("n"))
    frame = F.struct(F.lit("MultiPoint").alias("type"), F.array(F.array(F.array("w", "s"), F.array("e", "n"))).alias("parts"), F.array(F.lit(0)).alias("poly"))
    hints = boxes.select("ski_area", geo.viewport_hint(frame).alias("viewportHint"))
    changes = hints.join(places, "ski_area", "left")
    updated = _apply_areas(objects, changes, ["viewportHint", "places"])
    updated = updated.withColumn("runConvention", F.when(F.col("type") == "skiArea", convention(F.col("geometry"))).otherwise(F.col("runConvention")))
    lonely = updated.where("type = 'skiArea'").join(counts.withColumnRenamed("ski_area", "key"), "key", "left_anti").where(~F.exists("sources", lambda s: s["type"] == "skimap.org"))
    return relational.delete_cascade(updated, lonely.select("key")), stats


def drop_placeholders(objects: DataFrame) -> DataFrame:
    """Areas that never got a place."""
    return objects.where(~((F.col("type") == "skiArea") & ids.is_placeholder(F.col("geometry"))))


def geocode_areas(objects: DataFrame, places: DataFrame) -> DataFrame:
    """Areas that got no place from their members take that of their centroid; places: (key, place)."""
    from pisteflow.plans.enrich import PLACE_KEY

    c = geo.centroid(F.col("geometry"))
    open_ = objects.where("type = 'skiArea' and size(places) = 0").select(F.col("key").alias("ski_area"), geo.geohash(c[0], c[1], PLACE_KEY).alias("__cell"))
    found = open_.join(places.select(F.col("key").alias("__cell"), "place").where("place is not null"), "__cell")
    kind = objects.schema["places"].dataType
    return _apply_areas(objects, found.groupBy("ski_area").agg(F.min("place").alias("p")).select("ski_area", F.array("p").cast(kind).alias("places")), ["places"])


def cluster(objects: DataFrame, places: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All passes in order; (objects, statistics)."""
    with whole_structs(objects.sparkSession):
        step = lambda df, name: materialize(df.select(*COLUMNS), name)
        objects = step(objects, "objects")
        objects = step(pass_a(objects), "pass-a")
        objects = step(pass_b(objects), "pass-b")
        edges = materialize(_graph(objects, NEAR_M), "near")
        objects = step(assign_greedily(objects, "openstreetmap", None, edges), "pass-c")
        objects = step(pass_d(objects), "pass-d")
        objects = step(assign_greedily(objects, "skimap.org", None, edges), "pass-e")
        objects = step(pass_f(objects, edges), "pass-f")
        objects = step(associate_stations(objects), "stations")
        objects, stats = augment(objects)
        if places is not None:
            objects = geocode_areas(step(objects, "augmented"), places)
        return step(drop_placeholders(objects), "clustered"), materialize(stats, "statistics")
