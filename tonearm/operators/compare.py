"""Model lists against an outside recommender's lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names_or_none, overlap_percent
from .sets import head_per_group


def ranked_list(df: DataFrame, group: str | list[str], value: str, order_col: str, n: int, name: str) -> DataFrame:
    """One list of at most n values per group, in ascending ``order_col``.

    Rows beyond n leave before the lists are built, so no list grows with the data.
    """
    head = head_per_group(df, group, n, F.col(order_col).asc(), F.col(value).asc(), name="_rank")
    items = F.array_sort(F.collect_list(F.struct("_rank", F.col(value).alias("v"))))
    keys = [group] if isinstance(group, str) else group
    return head.groupBy(*keys).agg(items.alias("_items")).select(*keys, F.col("_items.v").alias(name))


def seed_keys(df: DataFrame) -> list[str]:
    """What tells seeds apart: their id where the frame has it, as many seeds may share a name such as "Unknown Artist"."""
    return [c for c in ("source_artist_id", "source_artist") if c in df.columns]


def model_lists(recommendations: DataFrame, n: int = 10) -> DataFrame:
    """Per seed the first n recommended names, the seed itself left out."""
    others = recommendations.filter("rank > 1")
    named = others.withColumn(
        "artist_name", F.coalesce("artist_name", F.concat(F.lit("Unknown Artist ("), F.col("artist_id"), F.lit(")")))
    )
    return ranked_list(named, seed_keys(named), "artist_name", "rank", n, "model_recommendations")


def compare_lists(model: DataFrame, external: DataFrame) -> DataFrame:
    """Overlap of both lists per seed; one whose name has no outside list overlaps 0 %."""
    outside = external.select(F.col("artist_name").alias("source_artist"), F.col("similar").alias("external_recommendations"))
    joined = model.join(outside, "source_artist", "left").withColumn(
        "external_recommendations", F.coalesce("external_recommendations", F.array().cast("array<string>"))
    )
    both = F.array_intersect("model_recommendations", "external_recommendations")
    return joined.withColumn("overlap", both).select(
        *(c for c in ("source_artist_id",) if c in model.columns),
        F.col("source_artist").alias("artist_name"),
        "model_recommendations",
        "external_recommendations",
        "overlap",
        overlap_percent(F.col("model_recommendations"), F.col("external_recommendations")).alias("overlap_percentage"),
        names_or_none(F.col("overlap")).alias("common_names"),
    )


def mean_overlap(comparison: DataFrame) -> DataFrame:
    return comparison.agg(F.count(F.lit(1)).alias("artists"), F.avg("overlap_percentage").alias("mean_overlap"))
