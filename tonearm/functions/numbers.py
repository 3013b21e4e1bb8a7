"""Numeric helpers that never divide by zero (Spark runs in ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        F.try_divide(part.cast("double"), whole.cast("double")) * 100
    )


def bucket_label(low: Column, high: Column) -> Column:
    """``3-5`` for a closed range, ``101+`` where the upper bound is null."""
    return F.when(high.isNull(), F.concat(low.cast("string"), F.lit("+"))).otherwise(
        F.concat_ws("-", low.cast("string"), high.cast("string"))
    )


def overlap_count(a: Column, b: Column) -> Column:
    """Distinct values that both lists hold."""
    return F.size(F.array_intersect(a, b))


def overlap_percent(a: Column, b: Column) -> Column:
    """Shared values as a share of the shorter list, 0 where a list is empty or absent."""
    shorter = F.least(F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0)))
    return F.when(shorter <= 0, F.lit(0.0)).otherwise(
        F.try_divide(overlap_count(a, b).cast("double"), shorter.cast("double")) * 100
    )
