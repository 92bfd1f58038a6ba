"""Column functions over open-ended tag maps (T1-T10, T17-T19, and the tag rules of F2-F10).

A tag that is absent is a null value; an empty string is a value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pisteflow.functions import vocab


def tag(tags: Column, key: str) -> Column:
    """T5: the value of a tag, or null."""
    return F.try_element_at(tags, F.lit(key))


def has_tag(tags: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def first_defined(tags: Column, *keys: str) -> Column:
    """The first defined of several tags."""
    return F.coalesce(*(tag(tags, k) for k in keys))


def boolean(value: Column) -> Column:
    """T4: yes, no, or null."""
    return F.when(value == "yes", True).when(value == "no", False)


def number(value: Column) -> Column:
    """Numeric text; blank text is 0, hexadecimal is read, anything else is null."""
    bare = F.trim(value)
    is_hex = bare.rlike("^0[xX][0-9a-fA-F]+$")
    return (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(bare == "", F.lit(0.0))
        .when(is_hex, F.conv(F.substring(bare, 3, 100), 16, 10).cast("double"))
        .when(bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), bare.try_cast("double"))
    )


def is_numeric(value: Column) -> Column:
    """The text begins with a finite number."""
    return F.coalesce(value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)"), F.lit(False))


def first_value(tags: Column, key: str) -> Column:
    """The first of a list separated by semicolons, as it is written."""
    return F.split_part(tag(tags, key), F.lit(";"), F.lit(1))


def ref(tags: Column) -> Column:
    """T9."""
    return first_defined(tags, "piste:loc_ref", "piste:ref", "loc_ref", "ref")


def name(tags: Column, key: str, fallback: str | None = None, ref_value: Column | None = None) -> Column:
    """All names under a key and its language variants, else under a fallback key; unique, joined.

    A leading ref goes with the spaces and the dash after it; without either it stays. Special
    characters of the ref are taken literally.
    """
    roots = [key, *([fallback] if fallback else [])]
    keys = F.map_keys(tags)
    of = lambda root: F.array_sort(F.filter(keys, lambda k: (k == root) | k.startswith(root + ":")))
    found = of(key)
    if fallback:
        found = F.when(F.size(found) > 0, found).otherwise(of(fallback)) if len(roots) > 1 else found
    values = F.array_distinct(F.transform(found, lambda k: F.try_element_at(tags, k)))
    joined = F.when(F.size(found) > 0, F.array_join(values, ", "))
    if ref_value is None:
        return joined
    quoted = F.concat(F.lit(r"^\Q"), ref_value, F.lit(r"\E(?:\s*-?\s+|-\s*)"))
    return F.when(F.coalesce(ref_value, F.lit("")) == "", joined).otherwise(F.regexp_replace(joined, quoted, F.lit("")))


def unsupported(tags: Column, key: str) -> Column:
    """The feature is gone, by its own key or by a state tag."""
    states = vocab.UNSUPPORTED_STATES
    return F.coalesce(tag(tags, key).isin(*states), F.lit(False)) | any_of(F.coalesce(tag(tags, s) == "yes", F.lit(False)) for s in states)


def any_of(parts: Iterable[Column]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | p
    return out


def status_and_value(tags: Column, key: str) -> Column:
    """struct<status, value> of a key, by the lifecycle of its feature; empty values are null.

    Unsupported states give nulls. Where the key is there, `key=state` takes the value of the tag
    that the state names; only where it isn't, `state:key=value` counts. Otherwise `state=yes`
    beside it gives the status, and without that the feature operates.
    """
    filled = lambda k: F.nullif(tag(tags, k), F.lit(""))
    make = lambda status, value: F.struct(F.lit(status).cast("string").alias("status"), value.alias("value"))
    there = has_tag(tags, key)
    out = F.when(unsupported(tags, key), make(None, F.lit(None).cast("string")))
    for s in vocab.LIFECYCLE_STATES:
        out = out.when(tag(tags, key) == s, make(s, filled(s)))
    for s in vocab.LIFECYCLE_STATES:
        out = out.when(~there & has_tag(tags, f"{s}:{key}"), make(s, filled(f"{s}:{key}")))
    for s in vocab.LIFECYCLE_STATES:
        out = out.when(tag(tags, s) == "yes", make(s, filled(key)))
    return out.otherwise(make("operating", filled(key)))


def run_uses(value: Column) -> Column:
    """known uses of a list separated by semicolons."""
    parts = F.transform(F.split(value, ";"), lambda t: F.lower(F.trim(t)))
    known = F.filter(parts, lambda t: t.isin(*vocab.RUN_USES))
    return F.coalesce(known, F.array().cast("array<string>"))


def gladed(tags: Column) -> Column:
    """F4."""
    wooded = (tag(tags, "natural") == "wood") | (tag(tags, "landuse") == "forest")
    return F.coalesce(boolean(first_defined(tags, "piste:gladed", "gladed")), F.when(wooded, True))


def oneway(tags: Column, uses: Column) -> Column:
    """the tag, else true for downhill runs."""
    return F.coalesce(boolean(first_defined(tags, "piste:oneway", "oneway")), F.when(F.array_contains(uses, "downhill"), True))


def grooming(tags: Column) -> Column:
    """F6."""
    raw = tag(tags, "piste:grooming")
    first_plus = F.regexp_replace(raw, "^([^;]*);", "$1+")
    kinds = F.split(first_plus, r"\+")
    both = F.array_contains(kinds, "classic") & F.array_contains(kinds, "skating")
    hard = tag(tags, "piste:difficulty").isin("expert", "freeride", "extreme") | (raw == "no")
    return F.when(both, "classic+skating").when(first_plus.isin(*vocab.GROOMINGS), first_plus).when(hard, "backcountry")


def difficulty(tags: Column) -> Column:
    """F7."""
    value = tag(tags, "piste:difficulty")
    return F.when(value.isin(*vocab.DIFFICULTIES), value)


def lift_status_and_type(tags: Column) -> Column:
    """struct<status, value>; value is a known lift type or null."""
    aerial, rail = status_and_value(tags, "aerialway"), status_and_value(tags, "railway")
    kind = F.when(aerial["value"].isNotNull(), aerial["value"]).otherwise(F.when(rail["value"].isin(*vocab.RAILWAY_KINDS), "railway").otherwise(rail["value"]))
    status = F.when(aerial["value"].isNotNull(), aerial["status"]).otherwise(rail["status"])
    return F.struct(status.alias("status"), F.when(kind.isin(*vocab.LIFT_TYPES), kind).alias("value"))


def duration_seconds(value: Column) -> Column:
    """minutes as a number, or mm:ss; in seconds, half up."""
    parts = F.split(value, ":")
    minutes, seconds = F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")
    plain = F.floor(F.trim(value).try_cast("double") * 60 + 0.5)
    return F.when(F.size(parts) == 2, F.floor(minutes * 60 + seconds + 0.5)).when(F.size(parts) == 1, plain).cast("double")


def osm_id(kind: Column, ident: Column) -> Column:
    """F23."""
    return F.concat_ws("/", kind, ident.cast("string"))
