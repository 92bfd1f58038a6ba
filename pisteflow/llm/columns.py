"""Extra columns of any name on their way through an operator."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shielded(df: DataFrame, used: Iterable[str], outputs: Iterable[str] = ()) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """df with its extra columns under names that nothing else has, and what gives them back.

    used: columns that the operator reads, which keep their names. outputs: columns that the
    operator adds; input columns of these names are left out. The second result takes the
    operator's frame and returns the input's columns in their order, then the outputs.
    """
    used, outputs = list(used), list(outputs)
    kept = [c for c in df.columns if c not in outputs]
    safe = {c: c if c in used else f"__extra_column_{k}" for k, c in enumerate(kept)}
    inner = df.select(*(F.col(f"`{c}`").alias(s) for c, s in safe.items()))

    def restored(out: DataFrame, added: Iterable[str] = outputs) -> DataFrame:
        return out.select(*(F.col(s).alias(c) for c, s in safe.items()), *(F.col(c) for c in added))

    return inner, restored
