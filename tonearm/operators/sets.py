"""Unions, differences, de-duplication, samples and heads of groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keys_in_both(a: DataFrame, b: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` that occur in ``b``."""
    return a.select(key).dropna().distinct().join(b.select(F.col(other_key or key).alias(key)).distinct(), key, "left_semi")


def keys_missing(a: DataFrame, b: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` that do not occur in ``b``."""
    return a.select(key).dropna().distinct().join(b.select(F.col(other_key or key).alias(key)).distinct(), key, "left_anti")


def distinct_items(df: DataFrame, list_column: str, name: str = "item") -> DataFrame:
    """Union of all lists into one set."""
    return df.select(F.explode(list_column).alias(name)).distinct()


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One whole row per key, the lowest in ``order``.

    An aggregate, not a window: partial results combine before the shuffle, so
    a key that holds a third of the rows does not pile up in one task.
    """
    rest = [c for c in df.columns if c != key]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    best = df.groupBy(key).agg(F.min(F.struct(ranked.alias("o"), F.struct(*rest).alias("r"))).alias("b"))
    return best.select(key, "b.r.*")


def head_per_group(df: DataFrame, group: str | list[str], n: int, *order: Column, name: str = "rank") -> DataFrame:
    """The first n rows of each group with their 1-based rank.

    Spark limits each group to n rows within every task before the shuffle.
    """
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def repeatable_sample(df: DataFrame, n: int, column: str, seed: int = 42) -> DataFrame:
    """At most n rows in a seeded hash order: the same rows whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(column)), F.col(column)).limit(n)
