"""How artists spread over listener counts.

Everything derives from the distribution itself: one row per distinct listener
count, at most sqrt(2 * entries) rows, aggregated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import bucket_label, percent
from ..schemas import LISTENER_BUCKETS
from .stats import artist_totals, key_totals

PERCENTILES = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def listener_distribution(counts: DataFrame) -> DataFrame:
    """(listener_count, artist_count)."""
    return (
        artist_totals(counts)
        .groupBy(F.col("unique_listeners").alias("listener_count"))
        .agg(F.count(F.lit(1)).alias("artist_count"))
    )


def listener_percentiles(counts: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Percentiles of listeners per artist and the maximum.

    Exact percentiles merge per-value counts between tasks, and there are few
    distinct listener counts; ``exact=False`` uses the mergeable sketch.
    """
    per_artist = artist_totals(counts)
    if exact:
        aggs = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY unique_listeners)").alias(n) for n, p in PERCENTILES.items()]
    else:
        aggs = [F.percentile_approx("unique_listeners", p, accuracy).alias(n) for n, p in PERCENTILES.items()]
    return per_artist.agg(*aggs, F.max("unique_listeners").alias("max"))


def listener_buckets(distribution: DataFrame, buckets=LISTENER_BUCKETS) -> DataFrame:
    """Artists per listener range with their share, empty ranges kept: one pass, one row, then unfolded."""
    lc, n = F.col("listener_count"), F.col("artist_count")
    sums = []
    for i, (low, high) in enumerate(buckets):
        inside = (lc >= low) if high is None else lc.between(low, high)
        sums.append(F.coalesce(F.sum(F.when(inside, n)), F.lit(0)).alias(f"b{i}"))
    row = distribution.agg(*sums, F.coalesce(F.sum(n), F.lit(0)).alias("total"), F.max(lc).alias("top"))
    items = []
    for i, (low, high) in enumerate(buckets):
        bound = F.lit(high).cast("long")
        items.append(
            F.struct(
                bucket_label(F.lit(low), bound).alias("label"),
                F.lit(low).cast("long").alias("low"),
                F.coalesce(bound, F.col("top")).alias("high"),
                F.col(f"b{i}").alias("count"),
                percent(F.col(f"b{i}"), F.col("total")).alias("percentage"),
            )
        )
    return row.select(F.explode(F.array(*items)).alias("b")).select("b.*")


def listener_spread(counts: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of listeners per artist."""
    return artist_totals(counts).agg(
        F.avg("unique_listeners").alias("mean"), F.stddev_samp("unique_listeners").alias("stddev")
    )


def single_listener_artists(distribution: DataFrame) -> DataFrame:
    single = F.coalesce(F.sum(F.when(F.col("listener_count") == 1, F.col("artist_count"))), F.lit(0))
    row = distribution.agg(single.alias("single_listener_artists"), F.sum("artist_count").alias("total_artists"))
    return row.withColumn("percentage", percent(F.col("single_listener_artists"), F.col("total_artists")))


def first_points(distribution: DataFrame, n: int = 100) -> DataFrame:
    return distribution.orderBy("listener_count").limit(n)


def cumulative_distribution(distribution: DataFrame, n: int = 100) -> DataFrame:
    """Cumulative share of artists over the n lowest listener counts."""
    order = W.orderBy("listener_count")
    running = F.sum("artist_count").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("artist_count").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    curve = distribution.select("listener_count", "artist_count", running.alias("cumulative_artists"), total.alias("_total"))
    head = curve.orderBy("listener_count").limit(n)
    return head.withColumn("cumulative_pct", percent(F.col("cumulative_artists"), F.col("_total"))).drop("_total")


def distribution_summary(counts: DataFrame) -> DataFrame:
    """One row: artists, users, exact percentiles, mean, spread; one pass over the counts."""
    return key_totals(counts).agg(
        F.count("artist_keys").alias("total_artists"),
        F.count("user_keys").alias("total_users"),
        *[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY artist_keys)").alias(n) for n, p in PERCENTILES.items()],
        F.max("artist_keys").alias("max"),
        F.avg("artist_keys").alias("mean"),
        F.stddev_samp("artist_keys").alias("stddev"),
    )
