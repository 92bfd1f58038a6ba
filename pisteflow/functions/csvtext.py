"""Cells of the published CSV files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pisteflow.functions import geo, reduce
from pisteflow.functions.jsnum import to_fixed

#: Name of the site that shows features (a column of the CSV files), and its address before an id.
#: Set both to those of the publishing site.
SITE_NAME, FEATURE_URL = "map_site", "https://map.example/?obj="
#: Where a source's page is.
SOURCE_URL = {"openstreetmap": "https://www.openstreetmap.org/", "skimap.org": "https://www.skimap.org/SkiAreas/view/"}


def escape(value: Column) -> Column:
    """Quoted if it holds a comma, quote, line break or semicolon; null is empty."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.isNull(), F.lit("")).when(value.rlike(r'[,"\n\r;]'), quoted).otherwise(value)


def yes_no(value: Column) -> Column:
    """T12."""
    return F.when(value, "yes").when(~value, "no").otherwise("")


def feature_url(ident: Column) -> Column:
    """T14."""
    return F.concat(F.lit(FEATURE_URL), ident)


def source_urls(sources: Column) -> Column:
    """Addresses, sorted, joined by one space."""
    url = lambda s: F.concat(F.when(s["type"] == "openstreetmap", SOURCE_URL["openstreetmap"]).otherwise(SOURCE_URL["skimap.org"]), s["id"])
    return escape(F.array_join(F.array_sort(F.transform(sources, url)), " "))


def websites(values: Column) -> Column:
    """Sorted, joined by one space."""
    return escape(F.array_join(F.array_sort(values), " "))


def area_names(areas: Column) -> Column:
    """Names of ski areas (id, name), sorted, joined by commas; one without a name is empty."""
    named = F.array_sort(F.transform(areas, lambda a: F.struct(F.coalesce(a["name"], F.lit("null")).alias("by"), F.coalesce(a["name"], F.lit("")).alias("n"))))
    return escape(F.array_join(F.transform(named, lambda x: x["n"]), ","))


def area_ids(areas: Column) -> Column:
    """Ids of ski areas in their order, joined by semicolons, never quoted."""
    return F.array_join(F.transform(areas, lambda a: a["id"]), ";")


def list_cell(values: Column) -> Column:
    """Sorted unique values that aren't empty, joined by semicolons."""
    return escape(reduce.clean_join(F.filter(values, lambda v: v != ""), ";"))


def places(value: Column) -> list[Column]:
    """Countries, regions and localities."""
    of = lambda field: F.transform(value, lambda p: p["localized"]["en"][field])
    return [list_cell(of(field)) for field in ("country", "region", "locality")]


def geometry_cells(geometry: Column) -> list[Column]:
    """type, latitude and longitude of the centroid to six decimals."""
    c = geo.centroid(geometry)
    return [geometry["type"], to_fixed(c[1], 6), to_fixed(c[0], 6)]


def row(cells: list[Column]) -> Column:
    """F32: one line; null cells are empty."""
    return F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("")) for c in cells))
