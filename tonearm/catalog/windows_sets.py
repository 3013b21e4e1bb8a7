"""Positions, running shares, heads of groups, samples and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import split_items
from ..operators import distribution, indexing, profile, resolve, sets, stats
from ..plans.adapters import Tables
from ..session import scratch_path
from ..sources.listens import parse_months, read_landed_listens
from .aggregates import BANDS_SQL
from .base import query, rounded
from .ingest import _MONTHLY, _RECS, user_recommendations


@query("wn01_artist_index", "SELECT artist_id, row_number() OVER (ORDER BY artist_id) - 1 AS item_idx FROM (SELECT DISTINCT artist_id FROM counts) a")
def wn01(t: Tables) -> DataFrame:
    return indexing.dense_index(t.counts, "artist_id", "item_idx").select("artist_id", "item_idx")


@query("wn01_user_index", "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM counts) a")
def wn01_users(t: Tables) -> DataFrame:
    return indexing.dense_index(t.counts, "user_id", "user_idx").select("user_id", "user_idx")


@query("wn02_rank_per_seed", _RECS + "SELECT source_artist_id, rank, artist_id, round(similarity_score, 6) AS similarity_score FROM recs")
def wn02(t: Tables) -> DataFrame:
    recs = user_recommendations(t).drop("rank")
    ranked = sets.head_per_group(recs, "source_artist_id", 20, F.col("similarity_score").desc(), F.col("artist_id").asc())
    return rounded(ranked.select("source_artist_id", "rank", "artist_id", "similarity_score"), "similarity_score")


@query(
    "wn03_cumulative_distribution",
    """
    SELECT listener_count, artist_count, CAST(run AS BIGINT) AS cumulative_artists, round(run::DOUBLE / total * 100, 6) AS cumulative_pct
    FROM (SELECT *, sum(artist_count) OVER (ORDER BY listener_count) AS run, sum(artist_count) OVER () AS total,
                 row_number() OVER (ORDER BY listener_count) AS rn FROM distribution) t WHERE rn <= 100
    """,
)
def wn03(t: Tables) -> DataFrame:
    return rounded(distribution.cumulative_distribution(distribution.listener_distribution(t.counts)), "cumulative_pct")


@query("wn04_activity_bands", BANDS_SQL + "SELECT user_id, total_listens, position, band FROM banded")
def wn04(t: Tables) -> DataFrame:
    return stats.activity_bands(stats.user_totals(t.counts)).select("user_id", "total_listens", "position", "band")


@query("wn05_share_of_total", "SELECT event_type, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM events) * 100, 6) AS percentage FROM events GROUP BY event_type", views=False)
def wn05(t: Tables) -> DataFrame:
    return rounded(profile.value_shares(t.read("events"), "event_type"), "percentage")


@query("sl01_top_recordings", "SELECT recording_msid, count(*) AS listen_count FROM listens GROUP BY recording_msid ORDER BY listen_count DESC, recording_msid LIMIT 30")
def sl01(t: Tables) -> DataFrame:
    return stats.top_rows(profile.rows_per_key(t.listens, "recording_msid"), "listen_count", "recording_msid", 30)


@query("sl02_head_per_seed", _RECS + "SELECT source_artist_id, artist_id, CAST(rank - 1 AS INTEGER) AS place FROM recs WHERE rank BETWEEN 2 AND 11")
def sl02(t: Tables) -> DataFrame:
    others = user_recommendations(t).filter("rank > 1").select("source_artist_id", "artist_id", F.col("rank").alias("r"))
    return sets.head_per_group(others, "source_artist_id", 10, F.col("r").asc(), name="place").drop("r")


@query("sl03_sorted_counts", "SELECT user_id, artist_id, listen_count FROM counts ORDER BY user_id, artist_id")
def sl03(t: Tables) -> DataFrame:
    return t.counts.orderBy("user_id", "artist_id")


@query("sl04_ordered_ids", "SELECT DISTINCT artist_id FROM counts ORDER BY artist_id")
def sl04(t: Tables) -> DataFrame:
    return t.counts.select("artist_id").distinct().orderBy("artist_id")


@query("sl05_first_points", "SELECT listener_count, artist_count FROM distribution ORDER BY listener_count LIMIT 100")
def sl05(t: Tables) -> DataFrame:
    return distribution.first_points(distribution.listener_distribution(t.counts))


@query("smp01_seed_sample")
def smp01(t: Tables) -> DataFrame:
    """At most ten seeds of the recommendation table, the same on every run."""
    return sets.repeatable_sample(user_recommendations(t).select("source_artist_id").distinct(), 10, "source_artist_id")


@query("smp02_value_sample")
def smp02(t: Tables) -> DataFrame:
    """At most 1000 message ids, seed 42."""
    return sets.repeatable_sample(t.mapping.select("recording_msid"), 1000, "recording_msid", 42)


@query("smp02_sample_members", "SELECT least(1000, count(*)) AS sampled, least(1000, count(*)) AS members FROM msid_mapping")
def smp02_members(t: Tables) -> DataFrame:
    """Size of the sample, and how many of its distinct rows the table holds."""
    sample = sets.repeatable_sample(t.mapping.select("recording_msid"), 1000, "recording_msid", 42)
    known = sample.distinct().join(t.mapping.select("recording_msid"), "recording_msid", "left_semi")
    return stats.combine_rows(sample.agg(F.count(F.lit(1)).alias("sampled")), known.agg(F.count(F.lit(1)).alias("members")))


@query("set01_union_of_months", _MONTHLY + "SELECT user_id, count(*) AS plays FROM monthly WHERE month IN (1, 6, 12) GROUP BY user_id")
def set01(t: Tables) -> DataFrame:
    months = [t.monthly_listens.filter(F.col("month") == m) for m in (1, 6, 12)]
    return sets.union_all(*months).groupBy("user_id").agg(F.count(F.lit(1)).alias("plays"))


@query("set01_twelve_months", _MONTHLY + "SELECT month, count(*) AS plays, count(DISTINCT user_id) AS users FROM monthly GROUP BY month")
def set01_twelve(t: Tables) -> DataFrame:
    """All twelve months as one table: landed by month, their union is one scan."""
    path = scratch_path(t.spark, "twelve-months")
    t.monthly_listens.write.partitionBy("month").parquet(path)
    every = read_landed_listens(t.spark, path, parse_months("1-12"))
    pairs = every.groupBy("month", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("month").agg(F.sum("n").alias("plays"), F.count(F.lit(1)).alias("users"))


@query("set02_distinct_pairs", "SELECT DISTINCT user_id, recording_msid FROM listens")
def set02(t: Tables) -> DataFrame:
    return t.listens.distinct()


@query(
    "set03_best_mapping",
    """
    SELECT recording_msid, recording_mbid, match_type FROM (
      SELECT *, row_number() OVER (PARTITION BY recording_msid ORDER BY
        CASE match_type WHEN 'exact_match' THEN 0 WHEN 'high_quality' THEN 1 WHEN 'med_quality' THEN 2 WHEN 'low_quality' THEN 3 ELSE 4 END,
        recording_mbid) AS rn
      FROM (SELECT concat('n', p_name) AS recording_msid, recording_mbid, match_type FROM part
            JOIN msid_mapping ON recording_msid = concat('s', p_partkey)) m) t
    WHERE rn = 1
    """,
)
def set03(t: Tables) -> DataFrame:
    """Parts of one name share a message id here; the best match of each is kept."""
    names = t.read("part").select(F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("recording_msid"), F.concat(F.lit("n"), "p_name").alias("n"))
    shared = t.mapping.join(names, "recording_msid").select(F.col("n").alias("recording_msid"), "recording_mbid", "match_type")
    return resolve.best_mapping(shared)


@query(
    "set03_first_per_key",
    "SELECT p_name, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_partkey) AS rn FROM part) t WHERE rn = 1",
    views=False,
)
def set03_first(t: Tables) -> DataFrame:
    part = t.read("part").select("p_name", "p_partkey", "p_size")
    return sets.first_per_key(part, "p_name", -F.col("p_size"), F.col("p_partkey"))


@query("set04_keys_in_both", "SELECT DISTINCT canonical_recording_mbid FROM redirects WHERE canonical_recording_mbid IN (SELECT recording_mbid FROM canonical)")
def set04(t: Tables) -> DataFrame:
    return sets.keys_in_both(t.redirects, t.canonical, "canonical_recording_mbid", "recording_mbid")


@query("set05_keys_missing", "SELECT DISTINCT canonical_recording_mbid FROM redirects WHERE canonical_recording_mbid NOT IN (SELECT recording_mbid FROM canonical)")
def set05(t: Tables) -> DataFrame:
    return sets.keys_missing(t.redirects, t.canonical, "canonical_recording_mbid", "recording_mbid")


@query("set06_all_artists", "SELECT DISTINCT unnest(string_split(artist_mbids, ';')) AS artist_id FROM canonical WHERE artist_mbids <> ''")
def set06(t: Tables) -> DataFrame:
    lists = t.canonical.filter("artist_mbids <> ''").select(split_items(F.col("artist_mbids")).alias("ids"))
    return sets.distinct_items(lists, "ids", "artist_id")
