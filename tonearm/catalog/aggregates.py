"""Aggregations over counts, listens and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare, distribution, diversity, profile, recommend, resolve, segments, stats
from ..plans.adapters import Tables
from ..plans.funnel import profiled_mapping
from ..schemas import MATCH_LEVELS
from .base import query, r6, rounded
from .ingest import _BUCKETS, _CANONICAL_MAPPING, FUNNEL_SQL, funnel
from .joins import TWO_LISTS_SQL, two_lists


@query("ag01_user_artist_counts", "SELECT user_id, artist_id, listen_count FROM counts")
def ag01(t: Tables) -> DataFrame:
    return t.counts


@query(
    "ag01_all_levels_deduplicated",
    """--with
    best AS (SELECT recording_msid, min(recording_mbid) AS recording_mbid FROM msid_mapping WHERE match_type <> 'no_match' GROUP BY recording_msid)
    SELECT user_id, artist_id, count(*) AS listen_count FROM (
      SELECT user_id, unnest(string_split(c.artist_mbids, ';')) AS artist_id
      FROM (SELECT DISTINCT user_id, recording_msid FROM listens) l
      JOIN best m USING (recording_msid)
      LEFT JOIN redirects r ON r.recording_mbid = m.recording_mbid
      JOIN canonical c ON c.recording_mbid = coalesce(r.canonical_recording_mbid, m.recording_mbid) AND c.artist_mbids <> '') t
    GROUP BY user_id, artist_id
    """,
)
def ag01_distinct(t: Tables) -> DataFrame:
    """Distinct recordings, all match levels, one mapping per message id, unresolved dropped."""
    return resolve.user_artist_counts(
        t.listens, t.mapping, t.redirects, t.canonical, MATCH_LEVELS, "distinct_recordings", "drop", dedupe_mapping=True
    )


@query("ag02_distinct_users_artists", "SELECT count(DISTINCT user_id) AS unique_user_id, count(DISTINCT artist_id) AS unique_artist_id FROM counts")
def ag02(t: Tables) -> DataFrame:
    return profile.unique_counts(t.counts, "user_id", "artist_id")


_STATS_SQL = """
SELECT (SELECT count(*) FROM user_totals) AS total_users, (SELECT count(*) FROM artist_totals) AS total_artists,
  (SELECT count(*) FROM counts) AS total_entries, (SELECT CAST(sum(listen_count) AS BIGINT) FROM counts) AS total_listens,
  round((SELECT avg(total_listens) FROM user_totals), 6) AS avg_listens_per_user,
  round((SELECT avg(unique_artists) FROM user_totals), 6) AS avg_artists_per_user,
  round((SELECT avg(unique_listeners) FROM artist_totals), 6) AS avg_users_per_artist
"""


def _statistics(t: Tables) -> DataFrame:
    df = stats.dataset_statistics(t.counts)
    return rounded(df, "avg_listens_per_user", "avg_artists_per_user", "avg_users_per_artist")


@query("ag03_totals", "SELECT count(*) AS total_entries, CAST(sum(listen_count) AS BIGINT) AS total_listens FROM counts")
def ag03(t: Tables) -> DataFrame:
    return t.counts.agg(F.count(F.lit(1)).alias("total_entries"), F.sum("listen_count").alias("total_listens"))


@query("ag04_listens_per_user", "SELECT round(avg(total_listens), 6) AS avg_listens_per_user FROM user_totals")
def ag04(t: Tables) -> DataFrame:
    return stats.user_totals(t.counts).agg(r6(F.avg("total_listens"), "avg_listens_per_user"))


@query("ag05_artists_per_user", "SELECT round(avg(unique_artists), 6) AS avg_artists_per_user FROM user_totals")
def ag05(t: Tables) -> DataFrame:
    return stats.user_totals(t.counts).agg(r6(F.avg("unique_artists"), "avg_artists_per_user"))


@query("ag06_users_per_artist", "SELECT round(avg(unique_listeners), 6) AS avg_users_per_artist FROM artist_totals")
def ag06(t: Tables) -> DataFrame:
    return stats.artist_totals(t.counts).agg(r6(F.avg("unique_listeners"), "avg_users_per_artist"))


@query("ag07_top_artists", "SELECT * FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 50")
def ag07(t: Tables) -> DataFrame:
    return stats.top_artists(t.counts)


@query("ag08_top_users", "SELECT * FROM user_totals ORDER BY total_listens DESC, user_id LIMIT 50")
def ag08(t: Tables) -> DataFrame:
    return stats.top_users(t.counts)


@query("ag09_listener_distribution", "SELECT listener_count, artist_count FROM distribution")
def ag09(t: Tables) -> DataFrame:
    return distribution.listener_distribution(t.counts)


_PERCENTILES = """
SELECT quantile_disc(unique_listeners, 0.5) AS median, quantile_disc(unique_listeners, 0.9) AS p90,
       quantile_disc(unique_listeners, 0.95) AS p95, quantile_disc(unique_listeners, 0.99) AS p99,
       max(unique_listeners) AS max FROM artist_totals
"""


@query("ag10_listener_percentiles", _PERCENTILES)
def ag10(t: Tables) -> DataFrame:
    df = distribution.listener_percentiles(t.counts)
    return df.select(*[F.col(c).cast("long").alias(c) for c in df.columns])


@query("ag10_listener_percentiles_sketch")
def ag10_sketch(t: Tables) -> DataFrame:
    return distribution.listener_percentiles(t.counts, exact=False)


@query("ag11_listener_buckets", _BUCKETS)
def ag11(t: Tables) -> DataFrame:
    return rounded(distribution.listener_buckets(distribution.listener_distribution(t.counts)), "percentage")


@query("ag12_listener_spread", "SELECT round(avg(unique_listeners), 6) AS mean, round(stddev_samp(unique_listeners), 6) AS stddev FROM artist_totals")
def ag12(t: Tables) -> DataFrame:
    return rounded(distribution.listener_spread(t.counts), "mean", "stddev")


@query(
    "ag13_single_listener_artists",
    """
    SELECT CAST(coalesce(sum(artist_count) FILTER (listener_count = 1), 0) AS BIGINT) AS single_listener_artists,
           CAST(sum(artist_count) AS BIGINT) AS total_artists,
           round(coalesce(sum(artist_count) FILTER (listener_count = 1), 0)::DOUBLE / sum(artist_count) * 100, 6) AS percentage
    FROM distribution
    """,
)
def ag13(t: Tables) -> DataFrame:
    return rounded(distribution.single_listener_artists(distribution.listener_distribution(t.counts)), "percentage")


@query(
    "ag14_user_features",
    """
    SELECT user_id, count(DISTINCT artist_id) AS artist_count, CAST(sum(listen_count) AS BIGINT) AS total_listens,
           round(avg(listen_count), 6) AS avg_listens_per_artist, round(stddev_samp(listen_count), 6) AS stddev_listens,
           max(listen_count) AS max_listens
    FROM counts GROUP BY user_id HAVING count(DISTINCT artist_id) > 5
    """,
)
def ag14(t: Tables) -> DataFrame:
    return rounded(segments.user_features(t.counts), "avg_listens_per_artist", "stddev_listens")


@query("ag15_cluster_statistics")
def ag15(t: Tables) -> DataFrame:
    clustered = segments.cluster_users(segments.user_features(t.landed_counts))
    return segments.cluster_statistics(clustered).withColumn("example_users", F.array_join("example_users", ","))


_COVERAGE = """--with
c AS (SELECT count(m.recording_mbid) AS mapped_count, count(*) - count(m.recording_mbid) AS unmapped_count
      FROM listens l LEFT JOIN accepted m ON l.recording_msid = m.recording_msid)
SELECT round(mapped_count::DOUBLE / (mapped_count + unmapped_count) * 100, 6) AS mapped,
       round(unmapped_count::DOUBLE / (mapped_count + unmapped_count) * 100, 6) AS unmapped,
       mapped_count + unmapped_count AS total, mapped_count, unmapped_count,
       round(mapped_count::DOUBLE / (mapped_count + unmapped_count) * 100, 6) AS quality_score
FROM c
"""


@query(
    "ag15_clusters_cover_users",
    """--with
    f AS (SELECT user_id, count(*) AS a, sum(listen_count) AS l FROM counts GROUP BY user_id HAVING count(*) > 5)
    SELECT CAST(3 AS BIGINT) AS clusters, CAST(3 AS BIGINT) AS names, count(*) AS users, round(avg(a), 6) AS avg_artists, round(avg(l), 6) AS avg_listens,
           CAST(15 AS BIGINT) AS examples FROM f
    """,
)
def ag15_cover(t: Tables) -> DataFrame:
    """Clusters, names and sizes are arbitrary one by one, but together they must hold every user."""
    clustered = segments.cluster_users(segments.user_features(t.landed_counts))
    named = segments.name_segments(segments.cluster_statistics(clustered))
    users = F.sum("user_count")
    return named.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.count_distinct("name").alias("names"),
        users.alias("users"),
        r6(F.sum(F.col("user_count") * F.col("avg_artists")) / users, "avg_artists"),
        r6(F.sum(F.col("user_count") * F.col("avg_listens")) / users, "avg_listens"),
        F.sum(F.size("example_users")).cast("long").alias("examples"),
    )


@query("ag16_mapping_coverage", _COVERAGE)
def ag16(t: Tables) -> DataFrame:
    df = profile.mapping_coverage(t.listens, resolve.filter_match_levels(t.mapping))
    return rounded(df, "mapped", "unmapped", "quality_score")


@query(
    "ag16_coverage_by_level",
    "SELECT coalesce(match_type, 'unlisted') AS match_type, count(*) AS plays FROM listens LEFT JOIN msid_mapping USING (recording_msid) GROUP BY ALL",
)
def ag16_levels(t: Tables) -> DataFrame:
    return profile.coverage_by_level(t.listens, t.mapping)


@query(
    "ag17_match_types",
    "SELECT match_type, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM msid_mapping) * 100, 6) AS percentage FROM msid_mapping GROUP BY match_type",
)
def ag17(t: Tables) -> DataFrame:
    return rounded(profile.value_shares(t.mapping, "match_type"), "percentage")


def _spread_sql(key: str) -> str:
    return f"""
    SELECT round(avg(n), 6) AS mean, round(CAST(median(n) AS DOUBLE), 6) AS median, min(n) AS min, max(n) AS max
    FROM (SELECT count(*) AS n FROM listens GROUP BY {key}) t
    """


@query("ag18_listens_per_user_spread", _spread_sql("user_id"))
def ag18(t: Tables) -> DataFrame:
    return rounded(profile.spread(profile.rows_per_key(t.listens, "user_id"), "listen_count"), "mean", "median")


@query("ag19_listens_per_recording_spread", _spread_sql("recording_msid"))
def ag19(t: Tables) -> DataFrame:
    return rounded(profile.spread(profile.rows_per_key(t.listens, "recording_msid"), "listen_count"), "mean", "median")


@query(
    "ag20_null_profile",
    """
    SELECT c AS column_name, n AS nulls, round(n::DOUBLE / total * 100, 6) AS null_pct FROM (
      SELECT unnest(['recording_msid', 'recording_mbid', 'match_type']) AS c,
             unnest([count(*) - count(recording_msid), count(*) - count(recording_mbid), count(*) - count(match_type)]) AS n,
             count(*) AS total FROM msid_mapping) t
    """,
)
def ag20(t: Tables) -> DataFrame:
    return rounded(profile.null_profile(t.mapping), "null_pct")


def _duplicates_sql(table: str, *keys: str) -> str:
    cols = ", ".join(keys)
    return f"""
    SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows,
           CAST(sum(n - 1) AS BIGINT) AS extra_rows,
           round(coalesce(sum(n) FILTER (n > 1), 0)::DOUBLE / sum(n) * 100, 6) AS duplicate_pct
    FROM (SELECT count(*) AS n FROM {table} GROUP BY {cols}) t
    """


@query("ag21_duplicate_listens", _duplicates_sql("listens", "user_id", "recording_msid"))
def ag21(t: Tables) -> DataFrame:
    return rounded(profile.duplicate_profile(t.listens), "duplicate_pct")


@query("ag22_duplicate_mbids", _duplicates_sql("msid_mapping", "recording_mbid"))
def ag22(t: Tables) -> DataFrame:
    return rounded(profile.duplicate_profile(t.mapping, "recording_mbid"), "duplicate_pct")


@query("ag22_duplicate_names", _duplicates_sql("part", "p_name"))
def ag22_names(t: Tables) -> DataFrame:
    return rounded(profile.duplicate_profile(t.read("part"), "p_name"), "duplicate_pct")


@query(
    "ag22_duplicate_members",
    """
    SELECT p_partkey, p_name FROM part WHERE p_name IN (
      SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)
    """,
    views=False,
)
def ag22_members(t: Tables) -> DataFrame:
    return profile.duplicate_members(t.read("part").select("p_partkey", "p_name"), "p_name")


@query("ag23_extra_duplicates", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, recording_msid FROM listens) d) AS extra_rows FROM listens")
def ag23(t: Tables) -> DataFrame:
    return profile.duplicate_profile(t.listens).select("extra_rows")


@query("ag24_unique_values", "SELECT count(DISTINCT recording_msid) AS unique_recording_msid, count(DISTINCT recording_mbid) AS unique_recording_mbid FROM msid_mapping")
def ag24(t: Tables) -> DataFrame:
    return profile.unique_counts(t.mapping, "recording_msid", "recording_mbid")


# -- diversity ---------------------------------------------------------------

_PEOPLE = "people AS (SELECT CASE WHEN n_nationkey % 6 = 0 THEN 'Unknown' WHEN n_nationkey % 6 = 1 THEN NULL ELSE n_name END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_COUNTRIES = f"--with\n{_PEOPLE},\ncountries AS (SELECT country, count(*) AS n FROM people WHERE country <> 'Unknown' GROUP BY country)\n"


def _people(t: Tables) -> DataFrame:
    nation = t.read("nation")
    k = F.col("n_nationkey") % 6
    named = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.when(k == 0, "Unknown").when(k != 1, F.col("n_name")).alias("country"))
    return t.read("customer").select("c_nationkey").join(named, "c_nationkey")


@query("ag25_countries", _COUNTRIES + "SELECT country, n FROM countries")
def ag25(t: Tables) -> DataFrame:
    return diversity.country_distribution(_people(t))


_GENRES = "--with\ngenres AS (SELECT genre, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part) g WHERE genre <> '' GROUP BY genre)\n"


def _genres(t: Tables) -> DataFrame:
    return diversity.genre_distribution(t.read("part").select(F.split("p_name", " ").alias("genres")))


@query("ag26_genres", _GENRES + "SELECT genre, n FROM genres")
def ag26(t: Tables) -> DataFrame:
    return _genres(t)


_DATES = """--with
dated AS (SELECT CASE month(o_orderdate) % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y')
                      WHEN 2 THEN 'Unknown' END AS start_date FROM orders),
decades AS (SELECT CAST(y // 10 * 10 AS INTEGER) AS decade, count(*) AS n
            FROM (SELECT TRY_CAST(split_part(start_date, '-', 1) AS INTEGER) AS y FROM dated) t WHERE y IS NOT NULL GROUP BY 1)
"""


def _dated(t: Tables) -> DataFrame:
    m = F.month("o_orderdate") % 4
    return t.read("orders").select(
        F.when(m == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(m == 1, F.date_format("o_orderdate", "yyyy"))
        .when(m == 2, F.lit("Unknown"))
        .alias("start_date")
    )


@query("ag27_decades", _DATES + "SELECT decade, n, concat(decade, 's') AS label FROM decades")
def ag27(t: Tables) -> DataFrame:
    return diversity.decade_distribution(_dated(t))


@query(
    "ag28_country_chart",
    _COUNTRIES.rstrip()
    + """,
    ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, country) AS rk, count(*) OVER () AS k FROM countries),
    chart AS (SELECT CASE WHEN k > 8 AND rk > 7 THEN 'Other' ELSE country END AS country, CAST(sum(n) AS BIGINT) AS n FROM ranked GROUP BY 1)
    SELECT country, n, concat(country, ' (', n, ')') AS label FROM chart
    """,
)
def ag28(t: Tables) -> DataFrame:
    return diversity.country_chart(diversity.country_distribution(_people(t)))


@query("ag29_top_genres", _GENRES + "SELECT genre, n FROM genres ORDER BY n DESC, genre LIMIT 15")
def ag29(t: Tables) -> DataFrame:
    return diversity.top_genres(_genres(t))


# -- users -------------------------------------------------------------------

BANDS_SQL = """--with
ranked AS (SELECT user_id, total_listens, row_number() OVER (ORDER BY total_listens DESC, user_id) - 1 AS position,
                  count(*) OVER () AS n FROM user_totals),
banded AS (SELECT user_id, total_listens, position,
  CASE WHEN position < greatest(1, floor(n * 0.01)) THEN 'Top 1% Users' WHEN position < floor(n * 0.1) THEN 'Next 9% Users'
       WHEN position < floor(n * 0.5) THEN 'Next 40% Users' ELSE 'Bottom 50% Users' END AS band FROM ranked)
"""


@query(
    "ag30_activity_shares",
    BANDS_SQL + "SELECT band, round(sum(total_listens)::DOUBLE / (SELECT sum(total_listens) FROM banded) * 100, 6) AS share_pct FROM banded GROUP BY band",
)
def ag30(t: Tables) -> DataFrame:
    return rounded(stats.activity_shares(stats.user_totals(t.counts)), "share_pct")


@query(
    "ag31_artists_per_1000",
    """
    SELECT user_id, total_listens, unique_artists, round(unique_artists::DOUBLE / total_listens * 1000, 6) AS artists_per_1000
    FROM user_totals ORDER BY total_listens DESC, user_id LIMIT 20
    """,
)
def ag31(t: Tables) -> DataFrame:
    return rounded(stats.artists_per_thousand(stats.user_totals(t.counts)), "artists_per_1000")


@query(
    "ag32_listen_histogram",
    """--with
    span AS (SELECT min(total_listens)::DOUBLE AS lo, (max(total_listens) - min(total_listens))::DOUBLE / 30 AS w FROM user_totals),
    binned AS (SELECT CAST(least(floor((total_listens - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n FROM user_totals, span GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS low, round(lo + (i + 1) * w, 6) AS high, coalesce(n, 0) AS n
    FROM span, range(30) r(i) LEFT JOIN binned ON bin = i
    """,
)
def ag32(t: Tables) -> DataFrame:
    return rounded(stats.histogram(stats.user_totals(t.counts), "total_listens"), "low", "high")


@query(
    "ag33_listening_trend",
    "SELECT round(regr_slope(total_listens, unique_artists), 6) AS slope, round(regr_intercept(total_listens, unique_artists), 6) AS intercept FROM user_totals",
)
def ag33(t: Tables) -> DataFrame:
    return rounded(stats.listening_trend(stats.user_totals(t.counts)), "slope", "intercept")


# -- canonical data ------------------------------------------------------------

_CREDITS = "--with\ncredits AS (SELECT CASE WHEN trim(artist_mbids) = '' THEN 0 ELSE len(string_split(artist_mbids, ';')) END AS k FROM canonical)\n"


@query("ag34_artists_per_recording", _CREDITS + "SELECT round(avg(k), 6) AS mean, round(CAST(median(k) AS DOUBLE), 6) AS median, CAST(min(k) AS INTEGER) AS min, CAST(max(k) AS INTEGER) AS max FROM credits")
def ag34(t: Tables) -> DataFrame:
    return rounded(profile.spread(profile.artists_per_recording(t.canonical), "artist_count"), "mean", "median")


@query("ag34_artist_count_distribution", _CREDITS + "SELECT CAST(k AS INTEGER) AS artist_count, count(*) AS n FROM credits GROUP BY k")
def ag34_distribution(t: Tables) -> DataFrame:
    return profile.artists_per_recording(t.canonical).groupBy("artist_count").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ag34_multi_artist_share",
    _CREDITS + "SELECT count(*) AS recordings, count(*) FILTER (k > 1) AS multi_artist, round(avg(k), 6) AS avg_artists, round(count(*) FILTER (k > 1)::DOUBLE / count(*) * 100, 6) AS multi_artist_pct FROM credits",
)
def ag34_share(t: Tables) -> DataFrame:
    return rounded(profile.multi_artist_share(t.canonical), "avg_artists", "multi_artist_pct")


# -- overlap -------------------------------------------------------------------


@query("ag35_overlap", TWO_LISTS_SQL + "SELECT concat(user_id, '') AS artist_name, CAST(shared AS INTEGER) AS shared, round(overlap_percentage, 6) AS overlap_percentage FROM compared")
def ag35(t: Tables) -> DataFrame:
    from ..functions import overlap_count, overlap_percent

    model, outside = two_lists(t)
    both = model.join(outside, model.source_artist == outside.artist_name)
    a, b = F.col("model_recommendations"), F.col("similar")
    return both.select("artist_name", overlap_count(a, b).alias("shared"), r6(overlap_percent(a, b), "overlap_percentage"))


@query("ag36_mean_overlap", TWO_LISTS_SQL + "SELECT count(*) AS artists, round(avg(overlap_percentage), 6) AS mean_overlap FROM compared")
def ag36(t: Tables) -> DataFrame:
    return rounded(compare.mean_overlap(compare.compare_lists(*two_lists(t))), "mean_overlap")


@query("ag37_most_played", "SELECT artist_id, total_listens FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 10")
def ag37(t: Tables) -> DataFrame:
    return recommend.popular_artists(t.counts)


@query("ag38_table_profile")
def ag38(t: Tables) -> DataFrame:
    from ..operators.sets import union_all

    named = {"listens": t.listens, "msid_mapping": t.mapping, "canonical_redirects": t.redirects, "canonical_data": t.canonical, "artists": t.artists}
    return union_all(*[profile.table_profile(df, name) for name, df in named.items()])


@query(
    "ag38_rows_and_columns",
    """
    SELECT 'listens' AS "table", count(*) AS rows, 2 AS columns FROM listens
    UNION ALL SELECT 'msid_mapping', count(*), 3 FROM msid_mapping
    UNION ALL SELECT 'canonical_data', count(*), 2 FROM canonical
    """,
)
def ag38_rows(t: Tables) -> DataFrame:
    from ..operators.sets import union_all

    named = {"listens": t.listens, "msid_mapping": t.mapping, "canonical_data": t.canonical}
    return union_all(*[profile.table_profile(df, name) for name, df in named.items()]).drop("estimated_bytes")


_FLOW = "SELECT CAST(step_no AS INTEGER) AS step_no, step, original_count, processed_count, round(retention_pct, 6) AS retention_pct, loss_count, round(100 - retention_pct, 6) AS loss_pct FROM flow"


@query("ag39_stage_flow", FUNNEL_SQL + _FLOW)
def ag39(t: Tables) -> DataFrame:
    return rounded(funnel(t), "retention_pct", "loss_pct")


@query(
    "ag40_overall_retention",
    FUNNEL_SQL
    + """
    SELECT starting_count, ending_count, round(ending_count::DOUBLE / starting_count * 100, 6) AS retention_pct,
           round(100 - ending_count::DOUBLE / starting_count * 100, 6) AS loss_pct
    FROM (SELECT max(original_count) FILTER (step_no = 1) AS starting_count, max(processed_count) FILTER (step_no = 6) AS ending_count FROM flow) t
    """,
)
def ag40(t: Tables) -> DataFrame:
    return rounded(profile.overall_retention(funnel(t)), "retention_pct", "loss_pct")


@query(
    "ag41_canonicalisation_effect",
    _CANONICAL_MAPPING
    + """
    SELECT before, after, before - after AS reduction, round((before - after)::DOUBLE / before * 100, 6) AS reduction_pct,
           moved AS redirected_rows, round(moved::DOUBLE / rows * 100, 6) AS redirected_pct
    FROM (SELECT count(DISTINCT recording_mbid) AS before, count(DISTINCT canonical_mbid) AS after,
                 count(*) FILTER (recording_mbid <> canonical_mbid) AS moved, count(*) AS rows FROM canonical_mapping) t
    """,
)
def ag41(t: Tables) -> DataFrame:
    return rounded(profile.canonicalisation_effect(profiled_mapping(t.listens, t.mapping, t.redirects)), "reduction_pct", "redirected_pct")


@query(
    "ag42_redirect_profile",
    """
    SELECT count(*) AS rows, count(*) FILTER (recording_mbid = canonical_recording_mbid) AS self_redirects,
           round(count(*) FILTER (recording_mbid = canonical_recording_mbid)::DOUBLE / count(*) * 100, 6) AS self_redirect_pct,
           (SELECT count(DISTINCT canonical_recording_mbid) FROM redirect_chains
            WHERE canonical_recording_mbid IN (SELECT recording_mbid FROM redirect_chains)) AS redirected_targets
    FROM redirect_chains
    """,
)
def ag42(t: Tables) -> DataFrame:
    return rounded(profile.redirect_profile(t.redirect_chains), "self_redirect_pct")


@query("ag03_dataset_statistics", _STATS_SQL)
def ag03_statistics(t: Tables) -> DataFrame:
    return _statistics(t)
