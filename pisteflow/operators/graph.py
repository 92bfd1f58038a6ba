"""Connected components: star contractions while there are many edges, union in one task when few."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pisteflow.plans.lineage import discard, materialize

#: Up to so many edges (two keys each) are joined by one task; more are contracted by rounds of shuffles.
LOCAL_EDGES = 2_000_000


def labels(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of the edges, sorted, and the smallest end that each is joined to."""
    nodes, at = np.unique(np.concatenate((src, dst)), return_inverse=True)
    a, b = at[: len(src)], at[len(src) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[label]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _joined(edges: DataFrame) -> DataFrame:
    """(node, component) of a bounded number of edges, in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            ends = [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("a", "b")]
            nodes, least = labels(*ends)
            yield pa.RecordBatch.from_arrays([pa.array(x, held[0].column("a").type) for x in (nodes, least)], names=["node", "component"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest node.

    Each round links every node to the smallest node among its neighbours, first for the larger
    neighbours, then for the smaller ones. Edges never outgrow the input and the number of rounds
    is logarithmic in practice. A hub's edges are a skewed join side that AQE can split, and its
    minimum is pre-aggregated before the shuffle. State goes through the shared folder each round.
    LOCAL_EDGES edges or fewer are not worth a shuffle: one task joins them.

    Self-loops give a component of one node; null ends are dropped; repeated edges are harmless.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    current = materialize(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if current.count() <= LOCAL_EDGES:
        return _joined(current)
    loops = current.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    first, current = current, current.where("a <> b")
    before = None
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = materialize(small.union(lower.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None:
            discard(current)
        current = following
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).union(loops)
    out = materialize(found.groupBy("node").agg(F.min("component").alias("component")), "components")
    discard(first)
    return out
