"""Reducers over lists and groups (A7-A16, A20, T13), as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pisteflow.functions import vocab


def priority(values: Column, field: str) -> Column:
    """Of an array, the value that comes first in the field's priorities; null comes last."""
    order = F.array(*map(F.lit, vocab.PRIORITIES[field]))
    known = F.filter(values, lambda v: v.isNotNull())
    ranked = F.transform(known, lambda v: F.struct(F.array_position(order, v).alias("r"), v.alias("v")))
    return F.array_min(F.filter(ranked, lambda x: x["r"] > 0))["v"]


def priority_agg(value: Column, field: str) -> Column:
    """A8 over a group, without collecting it."""
    order = F.array(*map(F.lit, vocab.PRIORITIES[field]))
    return F.min_by(value, F.nullif(F.array_position(order, value), F.lit(0)))


def oneway(values: Column) -> Column:
    """A10: true only if all known values are; null if none is known."""
    known = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.forall(known, lambda v: v))


def unique_joined(values: Column, between: str = ", ") -> Column:
    """Trimmed, non-empty, first-seen unique values in one text; null if there are none."""
    clean = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    return F.nullif(F.array_join(F.array_distinct(clean), between), F.lit(""))


def unique_by(items: Column, key) -> Column:
    """The first item of each key, in order."""
    keys = F.transform(items, key)
    return F.filter(items, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def unique_sources(sources: Column) -> Column:
    """A13."""
    return unique_by(sources, lambda s: F.to_json(F.struct(s["type"].alias("t"), s["id"].alias("i"))))


def _place_key(p: Column) -> Column:
    return F.to_json(F.struct(p["iso3166_1Alpha2"].alias("c"), p["iso3166_2"].alias("r"), p["localized"]["en"]["locality"].alias("l")))


def unique_places(places: Column) -> Column:
    """A14."""
    return unique_by(places, _place_key)


def sorted_places(places: Column) -> Column:
    """By locality, region and country; nulls last."""
    en = lambda p, f: p["localized"]["en"][f]

    def compare(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for f in ("country", "region", "locality"):
            x, y = en(a, f), en(b, f)
            one = F.when(x.isNull() & y.isNull(), 0).when(x.isNull(), 1).when(y.isNull(), -1).when(F.lower(x) < F.lower(y), -1).when(F.lower(x) > F.lower(y), 1).when(x < y, -1).when(x > y, 1).otherwise(0)
            out = F.when(one != 0, one).otherwise(out)
        return out

    return F.array_sort(places, compare)


def merged_unique(*arrays: Column) -> Column:
    """All values, first seen first."""
    return F.array_distinct(F.flatten(F.array(*arrays)))


def nonzero(x: Column) -> Column:
    """Zero counts as missing."""
    return F.nullif(x, F.lit(0.0))


def served_max(runs: Column, lifts: Column) -> Column:
    """The lower of both maxima; a missing side yields the other."""
    return F.least(nonzero(runs), nonzero(lifts))


def served_min(runs: Column, lifts: Column) -> Column:
    """The higher of both minima; a missing side yields the other."""
    return F.greatest(nonzero(runs), nonzero(lifts))


def clean_join(values: Column, between: str = ";") -> Column:
    """Sorted unique values in one text; empty when there are none."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(values))), between)
