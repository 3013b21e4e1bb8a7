"""Profiles of a table and of the stages between two tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import item_count, percent
from .stats import combine_rows


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and the optimiser's size estimate in bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(float(size)).alias("estimated_bytes"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share for every column, in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[_count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return row.select("_rows", F.explode(items).alias("c")).select(
        "c.*", percent(F.col("c.nulls"), F.col("_rows")).alias("null_pct")
    )


def unique_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null values of each column, one row.

    Each column is grouped by itself: one narrow shuffle of its distinct values.
    """
    rows = [df.select(c).dropna().distinct().agg(F.count(F.lit(1)).alias(f"unique_{c}")) for c in columns]
    return combine_rows(*rows)


def duplicate_profile(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that share their key with another row (all members), their share, and the extras.

    ``extra_rows`` is rows less distinct keys. Null counts as a value.
    """
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    row = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    )
    return row.withColumn("duplicate_pct", percent(F.col("duplicate_rows"), F.col("rows")))


def duplicate_members(df: DataFrame, key: str, sample: int | None = None) -> DataFrame:
    """All rows of the duplicated keys, or of the first ``sample`` of them."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    if sample is not None:
        keys = keys.orderBy(key).limit(sample)
    return df.join(keys, key, "left_semi")


def rows_per_key(df: DataFrame, key: str, name: str = "listen_count") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def spread(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact median, minimum and maximum.

    The median merges per-value counts; made for count columns, whose distinct
    values are few next to the rows.
    """
    return df.agg(
        F.avg(column).alias("mean"),
        F.expr(f"percentile({column}, 0.5)").alias("median"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of all rows; the total is that of the grouped counts, so the rows are read once."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percentage", percent(F.col("n"), counts.agg(F.sum("n")).scalar()))


def coverage(a: DataFrame, b: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """How many distinct keys of ``a`` occur in ``b``. Null is no key."""
    left = a.select(key).dropna().distinct()
    right = b.select(F.col(other_key or key).alias(key)).dropna().distinct().withColumn("_hit", F.lit(1))
    row = left.join(right, key, "left").agg(
        F.count(F.lit(1)).alias("total_keys"), _count_if(F.col("_hit").isNotNull()).alias("found_keys")
    )
    return row.select(
        "total_keys",
        "found_keys",
        (F.col("total_keys") - F.col("found_keys")).alias("missing_keys"),
        percent(F.col("found_keys"), F.col("total_keys")).alias("found_pct"),
    )


def mapping_coverage(listens: DataFrame, mapping: DataFrame) -> DataFrame:
    """Listens with and without a recording id, over the join of both tables.

    Listens are counted per message id first, and the mapping per message id
    too, so a hot id or a block of null ids is one row in the join.
    """
    plays = listens.groupBy("recording_msid").agg(F.count(F.lit(1)).alias("plays"))
    rows = mapping.groupBy("recording_msid").agg(
        F.count("recording_mbid").alias("with_mbid"), (F.count(F.lit(1)) - F.count("recording_mbid")).alias("without_mbid")
    )
    joined = plays.join(rows, "recording_msid", "left")
    absent = F.when(F.col("with_mbid").isNull(), F.col("plays")).otherwise(F.col("plays") * F.col("without_mbid"))
    row = joined.agg(
        F.coalesce(F.sum(F.col("plays") * F.coalesce("with_mbid", F.lit(0))), F.lit(0)).alias("mapped_count"),
        F.coalesce(F.sum(absent), F.lit(0)).alias("unmapped_count"),
    )
    return quality_metrics(row)


def quality_metrics(counts: DataFrame) -> DataFrame:
    """Percentages out of ``mapped_count`` and ``unmapped_count``; no row where both are 0."""
    total = F.col("mapped_count") + F.col("unmapped_count")
    return (
        counts.withColumn("total", total)
        .filter("total > 0")
        .select(
            percent(F.col("mapped_count"), F.col("total")).alias("mapped"),
            percent(F.col("unmapped_count"), F.col("total")).alias("unmapped"),
            "total",
            "mapped_count",
            "unmapped_count",
            percent(F.col("mapped_count"), F.col("total")).alias("quality_score"),
        )
    )


def quality_from_percents(stats: DataFrame) -> DataFrame:
    """The same row out of percentages ``mapped`` and ``unmapped``.

    ``total``, ``mapped_count`` and ``unmapped_count`` are used where the frame
    has them; counts that are missing follow from the total, which is 100 then.
    """
    has = set(stats.columns)
    if "total" in has:
        total = F.col("total").cast("long")
    elif {"mapped_count", "unmapped_count"} <= has:
        total = (F.col("mapped_count") + F.col("unmapped_count")).cast("long")
    else:
        total = F.lit(100).cast("long")

    def count(name: str, share: str) -> Column:
        whole = F.col(name) if name in has else (total * F.col(share) / 100)
        return whole.cast("long").alias(name)

    return stats.select(
        "mapped",
        "unmapped",
        total.alias("total"),
        count("mapped_count", "mapped"),
        count("unmapped_count", "unmapped"),
        F.col("mapped").alias("quality_score"),
    )


def coverage_by_level(listens: DataFrame, mapping: DataFrame) -> DataFrame:
    """Plays per match level; listens without a mapping row are ``unlisted``."""
    plays = listens.groupBy("recording_msid").agg(F.count(F.lit(1)).alias("plays"))
    levels = mapping.groupBy("recording_msid", "match_type").agg(F.count(F.lit(1)).alias("n"))
    return (
        plays.join(levels, "recording_msid", "left")
        .groupBy(F.coalesce("match_type", F.lit("unlisted")).alias("match_type"))
        .agg(F.sum(F.col("plays") * F.coalesce("n", F.lit(1))).alias("plays"))
    )


def artists_per_recording(canonical: DataFrame, delimiter: str = ";") -> DataFrame:
    return canonical.withColumn("artist_count", item_count(F.col("artist_mbids"), delimiter))


def multi_artist_share(canonical: DataFrame, delimiter: str = ";") -> DataFrame:
    counted = artists_per_recording(canonical, delimiter)
    row = counted.agg(
        F.count(F.lit(1)).alias("recordings"),
        _count_if(F.col("artist_count") > 1).alias("multi_artist"),
        F.avg("artist_count").alias("avg_artists"),
    )
    return row.withColumn("multi_artist_pct", percent(F.col("multi_artist"), F.col("recordings")))


def canonicalisation_effect(canonical_mapping: DataFrame) -> DataFrame:
    """Distinct recording ids before and after redirects, and the rows that changed."""
    ids = unique_counts(canonical_mapping, "recording_mbid", "canonical_mbid")
    moved = canonical_mapping.agg(
        F.count(F.lit(1)).alias("rows"), _count_if(F.col("recording_mbid") != F.col("canonical_mbid")).alias("redirected_rows")
    )
    row = combine_rows(ids, moved)
    before, after = F.col("unique_recording_mbid"), F.col("unique_canonical_mbid")
    return row.select(
        before.alias("before"),
        after.alias("after"),
        (before - after).alias("reduction"),
        percent(before - after, before).alias("reduction_pct"),
        "redirected_rows",
        percent(F.col("redirected_rows"), F.col("rows")).alias("redirected_pct"),
    )


def redirect_profile(redirects: DataFrame) -> DataFrame:
    """Self-redirects, and distinct targets that are redirected themselves."""
    row = redirects.agg(
        F.count(F.lit(1)).alias("rows"),
        _count_if(F.col("recording_mbid") == F.col("canonical_recording_mbid")).alias("self_redirects"),
    ).withColumn("self_redirect_pct", percent(F.col("self_redirects"), F.col("rows")))
    targets = redirects.select(F.col("canonical_recording_mbid").alias("recording_mbid")).dropna().distinct()
    chained = targets.join(redirects.select("recording_mbid").distinct(), "recording_mbid", "left_semi").agg(
        F.count(F.lit(1)).alias("redirected_targets")
    )
    return combine_rows(row, chained)


def stage_flow(stages: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """One row per stage out of one-row, one-column counts before and after it."""
    rows = []
    for no, (step, before, after) in enumerate(stages, 1):
        both = before.toDF("original_count").unionByName(after.toDF("processed_count"), allowMissingColumns=True)
        rows.append(
            both.agg(F.max("original_count").alias("original_count"), F.max("processed_count").alias("processed_count")).select(
                F.lit(no).alias("step_no"), F.lit(step).alias("step"), "original_count", "processed_count"
            )
        )
    flow = reduce(DataFrame.unionByName, rows)
    kept = percent(F.col("processed_count"), F.col("original_count"))
    return (
        flow.withColumn("retention_pct", kept)
        .withColumn("loss_count", F.col("original_count") - F.col("processed_count"))
        .withColumn("loss_pct", F.lit(100.0) - F.col("retention_pct"))
    )


def overall_retention(flow: DataFrame) -> DataFrame:
    """First stage's input against last stage's output."""
    row = flow.agg(
        F.min_by("original_count", "step_no").alias("starting_count"), F.max_by("processed_count", "step_no").alias("ending_count")
    )
    kept = percent(F.col("ending_count"), F.col("starting_count"))
    return row.withColumn("retention_pct", kept).withColumn("loss_pct", F.lit(100.0) - F.col("retention_pct"))


def main_losses(flow: DataFrame, threshold: float = 10.0) -> DataFrame:
    return flow.filter(F.col("loss_pct") > threshold)
