"""OSM elements to features (S3, S4): ways and relations assembled by joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import geo, tags, vocab


def polygon_tags(t: Column) -> Column:
    """The tags of a closed way make it a polygon."""
    value = lambda k: tags.tag(t, k)
    known = lambda k: value(k).isNotNull() & (value(k) != "no")
    parts = [known(k) if rule is True else value(k).isin(*rule["only"]) if "only" in rule else known(k) & ~value(k).isin(*rule["except"]) for k, rule in vocab.POLYGON_TAGS.items()]
    return F.coalesce(value("area") != "no", F.lit(True)) & tags.any_of(F.coalesce(p, F.lit(False)) for p in parts)


def _properties(df: DataFrame) -> Column:
    return F.struct(df["type"].alias("type"), df["id"].alias("id"), F.coalesce(df["tags"], F.create_map().cast("map<string,string>")).alias("tags"))


def join_rings(ways: list[list[list[float]]]) -> list[list[list[float]]]:
    """Closed rings out of open and closed lines that share end points; open rests are dropped."""
    rings, open_lines = [], []
    for w in ways:
        (rings if len(w) > 3 and w[0] == w[-1] else open_lines).append(w)
    while open_lines:
        line = list(open_lines.pop(0))
        grown = True
        while grown and line[0] != line[-1]:
            grown = False
            for k, other in enumerate(open_lines):
                if other[0] == line[-1]:
                    line += other[1:]
                elif other[-1] == line[-1]:
                    line += other[-2::-1]
                else:
                    continue
                open_lines.pop(k)
                grown = True
                break
        if len(line) > 3 and line[0] == line[-1]:
            rings.append(line)
    return rings


def _inside(point: list[float], ring: list[list[float]]) -> bool:
    x, y = point[0], point[1]
    hit = False
    for (ax, ay, *_), (bx, by, *_) in zip(ring, ring[1:], strict=False):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def _assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples():
            plain = lambda w: [[float(v) for v in p] for p in w["line"]]
            outer = join_rings([plain(w) for w in r.ways if w["role"] != "inner"])
            inner = join_rings([plain(w) for w in r.ways if w["role"] == "inner"])
            polygons = [[ring] for ring in outer]
            for hole in inner:
                home = next((p for p in polygons if _inside(hole[0], p[0])), None)
                if home is not None:
                    home.append(hole)
            if polygons:
                parts = [ring for p in polygons for ring in p]
                poly = [k for k, p in enumerate(polygons) for _ in p]
                rows.append((r.id, {"type": "Polygon" if len(polygons) == 1 else "MultiPolygon", "parts": parts, "poly": poly}))
        yield pd.DataFrame(rows, columns=["id", "geometry"])


def to_features(elements: DataFrame) -> DataFrame:
    """S3: (geometry, properties) of nodes, ways, and multipolygon relations.

    Nodes are features where they have tags, are a relation's member, or are in no way. Nothing is dropped as uninteresting. A relation's ways are gathered in one row, so its size
    bounds what one task holds; nothing else is grouped in Python.
    """
    nodes = elements.where("type = 'node'")
    in_ways = elements.where("type = 'way'").select(F.explode("nodes").alias("id")).distinct().withColumn("__in_way", F.lit(True))
    in_relations = elements.where("type = 'relation'").select(F.explode("members").alias("m")).where("m.type = 'node'").select(F.col("m.ref").alias("id")).distinct().withColumn("__member", F.lit(True))
    shown = nodes.join(in_ways, "id", "left").join(in_relations, "id", "left").where("size(tags) > 0 or __in_way is null or __member")
    points = shown.select(F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array("lon", "lat"))).alias("parts"), F.array(F.lit(0)).alias("poly")).alias("geometry"), _properties(shown).alias("properties"))

    ways = elements.where("type = 'way'")
    at = nodes.select(F.col("id").alias("node"), F.array("lon", "lat").alias("p"))
    placed = ways.select("id", F.posexplode("nodes").alias("pos", "node")).join(at, "node")
    lines = placed.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "p"))), lambda x: x["p"]).alias("line")).where("size(line) > 1")
    closed = (F.element_at("line", 1) == F.element_at("line", -1)) & (F.size("line") > 3)
    shaped = ways.join(lines, "id")
    kind = F.when(closed & polygon_tags(F.col("tags")), "Polygon").otherwise("LineString")
    way_rows = shaped.select(F.struct(kind.alias("type"), F.array("line").alias("parts"), F.array(F.lit(0)).alias("poly")).alias("geometry"), _properties(shaped).alias("properties"))

    areas = elements.where("type = 'relation'").where(tags.tag(F.col("tags"), "type").isin("multipolygon", "boundary"))
    member = areas.select("id", F.explode("members").alias("m")).where("m.type = 'way'").select("id", F.col("m.ref").alias("way"), F.coalesce("m.role", F.lit("")).alias("role"))
    gathered = member.join(lines.withColumnRenamed("id", "way"), "way").groupBy("id").agg(F.collect_list(F.struct("role", "line")).alias("ways"))
    made = gathered.mapInPandas(_assemble, f"id bigint, geometry {geo.GEOMETRY}")
    relations = areas.join(made, "id")
    relation_rows = relations.select("geometry", _properties(relations).alias("properties"))
    return points.union(way_rows).union(relation_rows)
