"""Merging overlapping and adjoining run lines.

Lines that share a segment, or later an end point, form components; components are found with a
distributed contraction, and the exact order-dependent walk runs within each one, so no task holds
more than a component.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pisteflow.functions import vocab
from pisteflow.operators.graph import connected_components

#: Properties that don't tell runs apart.
IGNORED = ("id", "sources", "skiAreas", "elevationProfile", "places", "viewportHint", "websites_order")
Line = list[tuple[float, ...]]


def degenerate(coords: Line) -> bool:
    """N6."""
    return len(coords) < 2 or len(set(coords)) == 1


# -- properties ----------------------------------------------------------------------------------


def _first_by_priority(field: str, values: list):
    known = [v for v in values if v is not None]
    return min(known, key=vocab.PRIORITIES[field].index) if known else None


def _joined(values: list) -> str | None:
    clean = list(dict.fromkeys(v.strip() for v in values if v and v.strip()))
    return ", ".join(clean) or None


def _unique(items: list, key=lambda x: x) -> list:
    out: dict = {}
    for x in items:
        out.setdefault(json.dumps(key(x), sort_keys=True), x)
    return list(out.values())


def merged_properties(runs: list[dict]) -> dict:
    """One value a field for runs that share an arc."""
    runs = _unique(runs, lambda r: r.get("id") or r)  # A12
    of = lambda f: [r.get(f) for r in runs]
    flat = lambda f: [x for r in runs for x in r.get(f) or []]
    ways = [v for v in of("oneway") if v is not None]
    out = dict(runs[0])
    out.update(
        {
            "uses": _unique(flat("uses")),
            "name": _joined(of("name")),
            "ref": _joined(of("ref")),
            "description": _joined(of("description")),
            "oneway": all(ways) if ways else None,
            "websites": _unique(flat("websites")),
            "skiAreas": _unique(flat("skiAreas")),
            "sources": _unique(flat("sources"), lambda s: [s["type"], s["id"]]),
            "places": _unique(flat("places")),
            "wikidataID": next((v for v in of("wikidataID") if v), None),
            "difficultyConvention": runs[0].get("difficultyConvention"),
        }
    )
    for field in vocab.PRIORITIES:
        out[field] = _first_by_priority(field, of(field))
    return out


def direction(runs: list[tuple[bool | None, bool]]) -> tuple[bool | None, bool]:
    """(oneway, reversed) of an arc from those of its runs, in order."""
    one, back = runs[0]
    for o, b in runs[1:]:
        if one and o and back != b:
            one = False
        elif one is False:
            back = b
        elif o is False:
            one = False
        elif not one and o:
            one, back = True, b
    return one, back


# -- N2: overlaps --------------------------------------------------------------------------------


def cut_arcs(lines: list[Line]) -> list[list[tuple[Line, bool]]]:
    """Each line as arcs (coordinates, reversed), cut where lines part or end.

    An arc shared by several lines is the same object, in the direction of the first of them.
    """
    around: dict[tuple, frozenset] = {}
    junction: set[tuple] = set()
    for c in lines:
        junction.update((c[0], c[-1]))
        for a, p, b in zip(c, c[1:], c[2:], strict=False):
            pair = frozenset((a, b))
            if around.setdefault(p, pair) != pair:
                junction.add(p)
    known: dict[tuple, Line] = {}
    out = []
    for c in lines:
        arcs, start = [], 0
        for i in range(1, len(c)):
            if c[i] in junction:
                piece = c[start : i + 1]
                start = i
                key, back = tuple(piece), tuple(reversed(piece))
                if back in known and key not in known:
                    arcs.append((known[back], True))
                else:
                    arcs.append((known.setdefault(key, piece), False))
        out.append(arcs)
    return out


def merge_overlaps(lines: list[tuple[Line, dict]]) -> list[tuple[Line, dict]]:
    """Maximal lines of consecutive arcs with the same runs; each arc is emitted once."""
    arcs = cut_arcs([c for c, _ in lines])
    runs: dict[int, list[tuple[bool, dict]]] = {}
    for (_, props), own in zip(lines, arcs, strict=True):
        for arc, back in own:
            runs.setdefault(id(arc), []).append((back, props))
    out: list[tuple[Line, dict]] = []
    chain: Line = []
    held: list | None = None

    def flush() -> None:
        nonlocal chain, held
        if held is not None and len(chain) > 1:
            props = merged_properties([p for _, p in held])
            props["oneway"] = direction([(p.get("oneway"), b) for b, p in held])[0]
            out.append((chain, props))
        chain, held = [], None

    for own in arcs:
        flush()
        for arc, back in own:
            entry = runs.pop(id(arc), None)
            if entry is None:
                flush()
                continue
            _, turned = direction([(p.get("oneway"), b) for b, p in entry])
            if held is None or held != entry or turned != back:
                flush()
            coords = arc[::-1] if turned else arc
            chain = chain + coords[1:] if chain and chain[-1] == coords[0] else list(coords)
            held = entry
    flush()
    return out


# -- N5, N7: adjoining lines ---------------------------------------------------------------------


def point_key(p: tuple[float, ...]) -> str:
    """A position to seven decimals."""
    return f"{p[0]:.7f},{p[1]:.7f}"


def same_run(props: dict) -> str:
    """What has to be equal for two lines to be parts of one run."""
    return json.dumps({k: v for k, v in props.items() if k not in IGNORED}, sort_keys=True)


def join_segments(lines: list[tuple[Line, dict]]) -> list[tuple[Line, dict]]:
    """Chains of equal runs, walked backwards and forwards from each line in order.

    From a point the first line that goes on is taken, else the first that has to be turned round;
    where that first one is used already, or has a direction, the chain ends.
    """
    lines = [x for x in lines if not degenerate(x[0])]
    kind = [same_run(p) for _, p in lines]
    starts: dict[str, list[int]] = {}
    ends: dict[str, list[int]] = {}
    for i, (c, _) in enumerate(lines):
        starts.setdefault(point_key(c[0]), []).append(i)
        ends.setdefault(point_key(c[-1]), []).append(i)
    done: set[int] = set()
    fixed = lambda i: lines[i][1].get("oneway") is True

    def step(point: tuple, i: int, onward: dict[str, list[int]], turned: dict[str, list[int]]) -> tuple[int, bool] | None:
        """The line that goes on from line i at a point, and whether it has to be turned round."""
        first = next((k for k in onward.get(point_key(point), ()) if k != i and kind[k] == kind[i]), None)
        if first is not None and first not in done:
            return first, False
        other = next((k for k in turned.get(point_key(point), ()) if k != i and kind[k] == kind[i]), None)
        return (other, True) if other is not None and not fixed(other) and other not in done else None

    out = []
    for i, (c, props) in enumerate(lines):
        if i in done:
            continue
        done.add(i)
        coords, members = list(c), [props]
        k = i
        while (s := step(coords[0], k, ends, starts)) is not None:
            k, turn = s
            done.add(k)
            piece = lines[k][0][::-1] if turn else lines[k][0]
            coords = list(piece[:-1]) + coords
            members.insert(0, lines[k][1])
        k = i
        while (s := step(coords[-1], k, starts, ends)) is not None:
            k, turn = s
            done.add(k)
            piece = lines[k][0][::-1] if turn else lines[k][0]
            coords = coords + list(piece[1:])
            members.append(lines[k][1])
        out.append((coords, merged_properties(members) if len(members) > 1 else props))
    return out


# -- distributed ---------------------------------------------------------------------------------


def _component_pairs(keyed: DataFrame) -> DataFrame:
    """Edges that join all lines of a key to the first of them; keyed: (key, ordinal)."""
    first = keyed.groupBy("key").agg(F.min("ordinal").alias("first"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(first, "key").where("ordinal <> first").select(F.col("first").alias("src"), F.col("ordinal").alias("dst")).distinct()


def _position(p: Column) -> Column:
    return F.concat_ws(",", F.transform(F.slice(p, 1, 2), lambda v: v.cast("string")))


def _by_component(lines: DataFrame, keyed: DataFrame, walk) -> DataFrame:
    parts = connected_components(_component_pairs(keyed))
    placed = lines.join(parts, lines["ordinal"] == parts["node"], "left").withColumn("component", F.coalesce("component", "ordinal")).drop("node")
    alone = placed.groupBy("component").agg(F.count("*").alias("members"))
    both = placed.join(alone, "component")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ordinal")
        got = walk([([tuple(map(float, p)) for p in c], json.loads(s)) for c, s in zip(frame["coords"], frame["props"], strict=True)])
        first = int(frame["ordinal"].iloc[0])
        return pd.DataFrame({"ordinal": [first] * len(got), "part": range(len(got)), "coords": [[list(p) for p in c] for c, _ in got], "props": [json.dumps(s, sort_keys=True) for _, s in got]})

    schema = "ordinal bigint, part int, coords array<array<double>>, props string"
    walked = both.where("members > 1").select("component", "ordinal", "coords", "props").groupBy("component").applyInPandas(run, schema)
    # A line alone is what it is; the walks would give it back.
    single = both.where("members = 1").select("ordinal", F.lit(0).alias("part"), "coords", "props")
    return single.union(walked)


def normalise_runs(lines: DataFrame) -> DataFrame:
    """Lines (ordinal, coords array<array<double>>, props JSON) merged where they overlap, then joined.

    ordinal is the order of input and unique; the result is (ordinal, part, coords, props).
    """
    lines = lines.where((F.size("coords") > 1) & (F.size(F.array_distinct("coords")) > 1))
    steps = F.zip_with(F.slice("coords", F.lit(1), F.size("coords") - 1), F.slice("coords", F.lit(2), F.size("coords") - 1), lambda a, b: F.concat_ws(";", F.least(_position(a), _position(b)), F.greatest(_position(a), _position(b))))
    shared = lines.select("ordinal", F.explode(F.array_distinct(steps)).alias("key"))
    merged = _by_component(lines, shared, merge_overlaps)
    order = merged.withColumn("ordinal", F.col("ordinal") * 1_000_000 + F.col("part")).drop("part")
    plain = F.from_json("props", "map<string,string>")
    key = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.map_filter(plain, lambda k, _: ~k.isin(*IGNORED))))))
    end = lambda p: F.concat_ws(",", F.format_string("%.7f", p[0]), F.format_string("%.7f", p[1]))
    ends = F.array_distinct(F.array(end(F.element_at("coords", 1)), end(F.element_at("coords", -1))))
    touching = order.select("ordinal", F.explode(ends).alias("end"), key.alias("run")).select("ordinal", F.concat_ws("|", "end", "run").alias("key"))
    return _by_component(order, touching, join_segments)
