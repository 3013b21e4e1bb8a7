"""Dataset statistics over the user-artist counts.

The counts hold one row per (user, artist), so distinct artists of a user are
its rows. Per-user and per-artist totals are aggregated once and shared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import percent
from ..schemas import ACTIVITY_BANDS
from .indexing import with_row_index


def combine_rows(*rows: DataFrame) -> DataFrame:
    """One row out of one-row frames with different columns."""
    frames = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return frames.agg(*[F.max(c).alias(c) for c in frames.columns])


def user_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("user_id").agg(
        F.sum("listen_count").alias("total_listens"), F.count("artist_id").alias("unique_artists")
    )


def artist_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("artist_id").agg(
        F.sum("listen_count").alias("total_listens"), F.count("user_id").alias("unique_listeners")
    )


def key_totals(counts: DataFrame) -> DataFrame:
    """Totals per user and per artist in one pass over the counts.

    ``user_keys`` / ``artist_keys`` hold the entries of a user's / an artist's
    row and are null in rows of the other kind.
    """
    both = counts.groupingSets([["user_id"], ["artist_id"]], "user_id", "artist_id").agg(
        F.grouping("artist_id").alias("is_user"), F.sum("listen_count").alias("listens"), F.count(F.lit(1)).alias("n")
    )
    user = F.col("is_user") == 1
    return both.select(
        F.when(user, F.col("n")).alias("user_keys"),
        F.when(user, F.col("listens")).alias("user_listens"),
        F.when(~user, F.col("n")).alias("artist_keys"),
    )


def dataset_statistics(counts: DataFrame) -> DataFrame:
    """One row: users, artists, entries, listens and the three averages."""
    return key_totals(counts).agg(
        F.count("user_keys").alias("total_users"),
        F.count("artist_keys").alias("total_artists"),
        F.sum("user_keys").alias("total_entries"),
        F.sum("user_listens").alias("total_listens"),
        F.avg("user_listens").alias("avg_listens_per_user"),
        F.avg("user_keys").alias("avg_artists_per_user"),
        F.avg("artist_keys").alias("avg_users_per_artist"),
    )


def top_rows(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The n highest rows, ties by ascending id. Each task keeps n rows."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(n)


def top_artists(counts: DataFrame, n: int = 50) -> DataFrame:
    return top_rows(artist_totals(counts), "total_listens", "artist_id", n)


def top_users(counts: DataFrame, n: int = 50) -> DataFrame:
    return top_rows(user_totals(counts), "total_listens", "user_id", n)


def artists_per_thousand(totals: DataFrame, n: int = 20) -> DataFrame:
    """Distinct artists per 1000 listens of the n users with most listens."""
    return top_rows(totals, "total_listens", "user_id", n).withColumn(
        "artists_per_1000", F.try_divide(F.col("unique_artists").cast("double"), F.col("total_listens").cast("double")) * 1000
    )


def listening_trend(totals: DataFrame) -> DataFrame:
    """Least-squares line of listens on distinct artists."""
    x, y = F.col("unique_artists").cast("double"), F.col("total_listens").cast("double")
    return totals.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Fixed-width histogram, the last bin closed, empty bins kept.

    Two passes: the range, then one grouped count. A constant column gets a
    range of one around its value.
    """
    span = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    low = span.select("lo").scalar()
    width = span.select((F.col("hi") - F.col("lo")) / bins).scalar()
    counted = (
        df.filter(F.col(column).isNotNull())
        .select(F.least(F.floor((F.col(column).cast("double") - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.col("lo"),
        ((F.col("hi") - F.col("lo")) / bins).alias("w"),
    )
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def _cuts(n: Column) -> tuple[Column, Column, Column]:
    """Last positions (exclusive) of the top 1 %, 10 % and 50 % of n users."""
    one = F.greatest(F.lit(1), F.floor(n * 0.01))
    return one, F.floor(n * 0.1), F.floor(n * 0.5)


def activity_shares(totals: DataFrame) -> DataFrame:
    """Share of all listens held by each activity band of the users.

    Users with equal totals are interchangeable here, so the ranking runs on
    the frequency table (total, users), which has at most sqrt(2 * listens)
    rows however many users there are.
    """
    freq = totals.groupBy("total_listens").agg(F.count(F.lit(1)).alias("n"))
    order = W.orderBy(F.col("total_listens").desc())
    ranked = freq.withColumn("upto", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ranked = ranked.withColumn("users", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    n_users = F.col("users")
    one, ten, half = _cuts(n_users)
    # The second band starts after the first, which is never empty.
    bounds = [(F.lit(0), one), (one, ten), (ten, half), (half, n_users)]
    before = F.col("upto") - F.col("n")
    sums = []
    for i, (lo, hi) in enumerate(bounds):
        inside = F.greatest(F.lit(0), F.least(F.col("upto"), hi) - F.greatest(before, lo))
        sums.append(F.sum(inside * F.col("total_listens")).alias(f"b{i}"))
    one_row = ranked.agg(*sums, F.sum(F.col("n") * F.col("total_listens")).alias("all_listens"))
    bands = F.array(
        *[
            F.struct(F.lit(name).alias("band"), percent(F.col(f"b{i}"), F.col("all_listens")).alias("share_pct"))
            for i, name in enumerate(ACTIVITY_BANDS)
        ]
    )
    return one_row.select(F.explode(bands).alias("b")).select("b.*")


def activity_bands(totals: DataFrame) -> DataFrame:
    """Each user with its activity rank (0-based) and band."""
    indexed = with_row_index(
        totals.select("user_id", "total_listens"), F.col("total_listens").desc(), F.col("user_id").asc(), name="position"
    )
    one, ten, half = _cuts(indexed.agg(F.max("position") + 1).scalar())
    pos = F.col("position")
    return indexed.withColumn(
        "band",
        F.when(pos < one, ACTIVITY_BANDS[0])
        .when(pos < ten, ACTIVITY_BANDS[1])
        .when(pos < half, ACTIVITY_BANDS[2])
        .otherwise(ACTIVITY_BANDS[3]),
    )
