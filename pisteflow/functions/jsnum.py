"""Number text and rounding as in the published outputs, which follow ECMAScript."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def js_round(x: Column) -> Column:
    """Round half up, also below zero (-2.5 gives -2). T16, E15."""
    return F.floor(x + 0.5)


def round_tenth(z: Column) -> Column:
    """Elevation to a tenth, half up."""
    return js_round(z * 10) / 10


def number_text(x: Column) -> Column:
    """Shortest round-trip decimal without exponent or trailing `.0`, for |x| in [1e-6, 1e21).

    Java's text has the same digits but an exponent outside [1e-3, 1e7) and `.0` on integers, so
    the digits are taken from it and the point is put back.
    """
    text = x.cast("string")
    mantissa, exponent = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    bare = F.replace(mantissa, F.lit("-"), F.lit(""))
    whole = F.split_part(bare, F.lit("."), F.lit(1))
    part = F.split_part(bare, F.lit("."), F.lit(2))
    digits = F.concat(whole, F.when(part == "0", F.lit("")).otherwise(part))
    point = F.length(whole) + F.coalesce(exponent, F.lit(0))
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits))))
    )
    return F.when(x == 0, F.lit("0")).otherwise(F.concat(sign, plain))


def legacy_float(text: Column) -> Column:
    """Decimal text read digit by digit, as older readers did; ids published then need it.

    The integer part accumulates exactly; each decimal adds digit * place, with place divided by
    ten in floating point, which drifts by an ulp or so.
    """
    sign = F.when(text.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    bare = F.replace(text, F.lit("-"), F.lit(""))
    whole = F.split_part(bare, F.lit("."), F.lit(1)).cast("double")
    digits = F.filter(F.split(F.split_part(bare, F.lit("."), F.lit(2)), ""), lambda d: d != "")
    start = F.struct(whole.alias("m"), F.lit(0.1).alias("p"))
    step = lambda a, d: F.struct((a["m"] + a["p"] * d.cast("double")).alias("m"), (a["p"] / 10).alias("p"))
    return sign * F.aggregate(digits, start, step, lambda a: a["m"])


def to_fixed(x: Column, places: int) -> Column:
    """Fixed decimals; half away from zero on the exact binary value, `-0` for small negatives."""
    return F.format_string(f"%.{places}f", x)
