"""Arrays to rows.

The optimizer infers ``size(a) > 0`` from an explode of a plain column and
pushes it below every projection that makes the array, as a copy of all their
expressions.  An explode of an expression is left alone.  A filter on a
computed column is pushed in the same way; ``where_late`` is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(array: Column | str) -> Column:
    """One row per element."""
    return F.explode(F.filter(array, lambda x: x.isNotNull()))


def each_with_pos(array: Column | str, pos: str, name: str) -> Column:
    """One row per element, with its place from 0."""
    return F.posexplode(F.filter(array, lambda x: x.isNotNull())).alias(pos, name)


def no_texts() -> Column:
    return F.array().cast("array<string>")


def where_late(df: DataFrame, condition: Column | str, beside: str | None = None) -> DataFrame:
    """The rows for which a computed condition holds, filtered where they are computed and not by a copy below.

    Column ``beside`` stays as it is, so that rows partitioned by it are known to be.
    """
    kept = F.col(condition) if isinstance(condition, str) else condition
    rest = [c for c in df.columns if c != beside]
    row = F.explode(F.when(kept, F.array(F.struct(*rest)))).alias("_r")
    return df.select(*([] if beside is None else [beside]), row).select(*[c if c == beside else F.col(f"_r.{c}") for c in df.columns])
