"""The report's dataset jobs as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent
from ..operators.profile import quality_from_percents, quality_metrics
from ..operators.sets import union_all
from ..plans import reports
from ..plans.adapters import Tables
from ..session import scratch_path
from ..sources import results, sinks
from .aggregates import _COVERAGE, _STATS_SQL
from .base import query, r6, rounded
from .ingest import _BUCKETS, _RECS, FUNNEL_SQL, funnel, user_recommendations
from .joins import TWO_LISTS_SQL, two_lists
from .recommender import _FEATURES_SQL, given_clusters


@query(
    "rp01_dataset_summary",
    "SELECT artist_id, total_listens, unique_listeners, coalesce(name, 'Unknown Artist') AS name FROM (SELECT * FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 20) t LEFT JOIN artists ON artist_mbid = artist_id",
)
def rp01(t: Tables) -> DataFrame:
    """The summary document written as JSON, its top artists unfolded again."""
    path = scratch_path(t.spark, "summary")
    document = reports.summary_document(t.counts, t.artists)
    sinks.write_json(document, path, one_file=True)
    read = results.read_dataset(t.spark, path, document.schema)
    return read.select(F.explode("top_artists").alias("a")).select("a.artist_id", "a.total_listens", "a.unique_listeners", "a.name")


@query("rp01_summary_statistics", _STATS_SQL)
def rp01_statistics(t: Tables) -> DataFrame:
    df = reports.dataset_summary(t.counts, t.artists)["dataset_statistics"]
    return rounded(df, "avg_listens_per_user", "avg_artists_per_user", "avg_users_per_artist")


@query(
    "rp02_recommendation_analysis",
    _RECS + "SELECT source_artist, array_to_string(list(concat(rank, ':', artist_name) ORDER BY rank), '|') AS listed FROM recs WHERE rank > 1 GROUP BY source_artist",
)
def rp02(t: Tables) -> DataFrame:
    df = reports.recommendation_analysis(user_recommendations(t), t.artists)
    line = F.transform("recommendations", lambda r: F.concat(r["rank"].cast("string"), F.lit(":"), r["artist_name"]))
    return df.select("source_artist", F.array_join(line, "|").alias("listed"))


_SAME_NAMES = _RECS.rstrip() + """,
unnamed AS (SELECT * REPLACE (CASE WHEN CAST(substr(source_artist_id, 2) AS BIGINT) % 3 = 0 THEN 'Unknown Artist' ELSE source_artist END AS source_artist) FROM recs)
"""


def same_named(t: Tables) -> DataFrame:
    """Recommendations of which every third seed is an "Unknown Artist"."""
    unnamed = F.substring("source_artist_id", 2, 20).cast("long") % 3 == 0
    recs = user_recommendations(t)
    return recs.withColumn("source_artist", F.when(unnamed, F.lit("Unknown Artist")).otherwise(F.col("source_artist")))


@query(
    "rp02_same_named_seeds",
    _SAME_NAMES + "SELECT source_artist_id, source_artist, array_to_string(list(concat(rank, ':', artist_name) ORDER BY rank), '|') AS listed FROM unnamed WHERE rank > 1 GROUP BY ALL",
)
def rp02_same_named(t: Tables) -> DataFrame:
    """Each seed keeps a list of its own, whatever it is called."""
    line = F.transform("recommendations", lambda r: F.concat(r["rank"].cast("string"), F.lit(":"), r["artist_name"]))
    return reports.recommendation_analysis(same_named(t), t.artists).select("source_artist_id", "source_artist", F.array_join(line, "|").alias("listed"))


@query(
    "rp04_same_named_seeds",
    _SAME_NAMES
    + """
    SELECT source_artist_id, source_artist AS artist_name, CAST(count(*) FILTER (artist_name = 'Unknown Artist') > 0 AS INTEGER) AS shared
    FROM unnamed WHERE rank BETWEEN 2 AND 11 GROUP BY ALL
    """,
)
def rp04_same_named(t: Tables) -> DataFrame:
    """Every seed's own ten against an outside list that names one artist."""
    recs = same_named(t)
    outside = recs.select(F.col("source_artist").alias("artist_name")).distinct().withColumn("similar", F.array(F.lit("Unknown Artist")))
    df = reports.external_comparison(recs, outside, seeds=None)
    return df.select("source_artist_id", "artist_name", F.size("overlap").alias("shared"))


@query("snk03_same_named_seeds", _SAME_NAMES + "SELECT source_artist_id, source_artist, rank, artist_id FROM unnamed")
def snk03_same_named(t: Tables) -> DataFrame:
    """Written to a folder per seed and read back."""
    path = scratch_path(t.spark, "same-named")
    sinks.write_recommendations(same_named(t).filter("artist_id is not null"), path)
    return results.read_recommendations(t.spark, path).select("source_artist_id", "source_artist", "rank", "artist_id")


@query(
    "rp03_artist_diversity",
    """--with
    best AS (SELECT artist_id FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 20),
    m AS (SELECT a.* FROM best b JOIN artist_metadata a ON a.artist_mbid = b.artist_id)
    SELECT 'country' AS kind, country AS value, count(*) AS n FROM m WHERE country <> 'Unknown' GROUP BY country
    UNION ALL SELECT 'genre', genre, count(*) FROM (SELECT unnest(genres) AS genre FROM m) g WHERE genre <> '' GROUP BY genre
    UNION ALL SELECT 'decade', concat(y // 10 * 10, ''), count(*) FROM (SELECT TRY_CAST(split_part(start_date, '-', 1) AS INTEGER) AS y FROM m) d
      WHERE y IS NOT NULL GROUP BY 2
    """,
)
def rp03(t: Tables) -> DataFrame:
    parts = reports.artist_diversity(t.counts, t.artist_metadata)
    row = lambda kind, df, c: df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"), "n")
    return union_all(
        row("country", parts["country_distribution"], "country"),
        row("genre", parts["genre_distribution"], "genre"),
        row("decade", parts["decade_distribution"], "decade"),
    )


@query("rp04_external_comparison")
def rp04(t: Tables) -> DataFrame:
    """Ten sampled seeds against outside lists, the report's sample size."""
    model, outside = two_lists(t)
    recs = model.select("source_artist", F.posexplode("model_recommendations").alias("pos", "artist_name")).select(
        "source_artist", (F.col("pos") + 2).alias("rank"), F.col("artist_name").alias("artist_id"), "artist_name"
    )
    df = reports.external_comparison(recs, outside)
    return df.select("artist_name", F.size("overlap").alias("shared"), r6("overlap_percentage"), "common_names")


@query("rp04_external_comparison_all", TWO_LISTS_SQL + "SELECT concat(user_id, '') AS artist_name, CAST(shared AS INTEGER) AS shared, round(overlap_percentage, 6) AS overlap_percentage FROM compared")
def rp04_all(t: Tables) -> DataFrame:
    model, outside = two_lists(t)
    recs = model.select("source_artist", F.posexplode("model_recommendations").alias("pos", "artist_name")).select(
        "source_artist", (F.col("pos") + 2).alias("rank"), F.col("artist_name").alias("artist_id"), "artist_name"
    )
    df = reports.external_comparison(recs, outside, seeds=None)
    return df.select("artist_name", F.size("overlap").alias("shared"), r6("overlap_percentage"))


@query("rp05_similarity_network")
def rp05(t: Tables) -> DataFrame:
    """Nodes of the network of the report's sample of seeds, with degree and community."""
    return reports.similarity_network(user_recommendations(t), t.artists)["nodes"]


@query("rp06_user_segments")
def rp06(t: Tables) -> DataFrame:
    stats = reports.user_segments(t.landed_counts)["cluster_stats"]
    return stats.withColumn("example_users", F.array_join("example_users", ","))


@query(
    "rp06_given_segments",
    _FEATURES_SQL
    + """
    SELECT 'cluster_stats' AS dataset, cluster_id AS cluster, user_count AS users, avg_artists AS x, avg_listens AS y FROM stats
    UNION ALL SELECT 'points', cluster, 1, artist_count, total_listens FROM given
    UNION ALL SELECT 'centroids', cluster, 0, round(avg(artist_count), 6), round(avg(total_listens), 6) FROM given GROUP BY cluster
    """,
)
def rp06_given(t: Tables) -> DataFrame:
    """The three datasets of the segments over given clusters, one below the other."""
    made = reports.segment_datasets(given_clusters(t))
    columns = {"cluster_stats": ("cluster_id", "user_count", "avg_artists", "avg_listens"), "points": ("cluster", None, "artist_count", "total_listens"), "centroids": ("cluster", None, "centre_artists", "centre_listens")}

    def part(name: str) -> DataFrame:
        cluster, users, x, y = columns[name]
        count = F.col(users) if users else F.lit(int(name == "points")).cast("long")
        return made[name].select(F.lit(name).alias("dataset"), F.col(cluster).alias("cluster"), count.alias("users"), r6(x, "x"), r6(y, "y"))

    return union_all(*map(part, columns))


@query("rp07_listener_buckets", _BUCKETS)
def rp07(t: Tables) -> DataFrame:
    return rounded(reports.listener_report(t.counts)["buckets"], "percentage")


@query(
    "rp07_listener_summary",
    """
    SELECT (SELECT count(*) FROM artist_totals) AS total_artists, (SELECT count(*) FROM user_totals) AS total_users,
      quantile_disc(unique_listeners, 0.5) AS median, quantile_disc(unique_listeners, 0.9) AS p90,
      quantile_disc(unique_listeners, 0.95) AS p95, quantile_disc(unique_listeners, 0.99) AS p99, max(unique_listeners) AS max,
      round(avg(unique_listeners), 6) AS mean, round(stddev_samp(unique_listeners), 6) AS stddev
    FROM artist_totals
    """,
)
def rp07_summary(t: Tables) -> DataFrame:
    df = reports.listener_report(t.counts)["summary"]
    whole = ("median", "p90", "p95", "p99", "max")
    return df.select(*[F.col(c).cast("long").alias(c) if c in whole else r6(c) if c in ("mean", "stddev") else F.col(c) for c in df.columns])


@query("rp08_mapping_quality", _COVERAGE)
def rp08(t: Tables) -> DataFrame:
    from ..operators.resolve import filter_match_levels

    return rounded(reports.mapping_quality(t.listens, filter_match_levels(t.mapping)), "mapped", "unmapped", "quality_score")


@query(
    "rp08_quality_from_log",
    """--with
    c AS (SELECT CAST(1000 * count(m.recording_mbid) AS BIGINT) AS a, CAST(1000 * (count(*) - count(m.recording_mbid)) AS BIGINT) AS b
          FROM listens l LEFT JOIN accepted m ON l.recording_msid = m.recording_msid)
    SELECT round(a::DOUBLE / (a + b) * 100, 6) AS mapped, a + b AS total, round(a::DOUBLE / (a + b) * 100, 6) AS quality_score FROM c
    """,
)
def rp08_log(t: Tables) -> DataFrame:
    """Mapping quality out of the log line a run leaves."""
    from ..operators.resolve import filter_match_levels

    path = scratch_path(t.spark, "quality-log")
    q = reports.mapping_quality(t.listens, filter_match_levels(t.mapping))
    line = F.concat(
        F.lit("MSID to MBID mapping: "),
        F.format_number(F.col("mapped_count") * 1000, 0),
        F.lit(" mapped ("),
        F.format_number("mapped", 1),
        F.lit("%), "),
        F.format_number(F.col("unmapped_count") * 1000, 0),
        F.lit(" unmapped"),
    )
    q.select(line.alias("value")).write.text(path)
    return rounded(quality_metrics(results.read_mapping_counts(t.spark, path)), "mapped", "quality_score").select("mapped", "total", "quality_score")


@query(
    "rp08_quality_from_percents",
    """--with
    p AS (SELECT round(100.0::DOUBLE * count(*) FILTER (match_type <> 'no_match') / count(*), 3) AS mapped, count(*) AS total FROM msid_mapping)
    SELECT mapped, round(100 - mapped, 3) AS unmapped, total, CAST(floor(total * mapped / 100) AS BIGINT) AS mapped_count,
           CAST(floor(total * round(100 - mapped, 3) / 100) AS BIGINT) AS unmapped_count, mapped AS quality_score FROM p
    """,
)
def rp08_percents(t: Tables) -> DataFrame:
    matched = F.count_if(F.col("match_type") != "no_match")
    row = t.mapping.agg(F.round(percent(matched, F.count(F.lit(1))), 3).alias("mapped"), F.count(F.lit(1)).alias("total"))
    return quality_from_percents(row.withColumn("unmapped", F.round(F.lit(100.0) - F.col("mapped"), 3)))


@query("rp09_full_report")
def rp09(t: Tables) -> DataFrame:
    """Write every dataset of the report; lists their names and rows."""
    recs = user_recommendations(t, counts=t.landed_counts)
    external = two_lists(t)[1]
    out = scratch_path(t.spark, "report")
    paths = reports.full_report(t.landed_counts, t.artists, recs, t.artist_metadata, external, out)
    rows = [t.spark.read.text(p).agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(n)) for n, p in paths.items()]
    return union_all(*rows)


@query("rp10_stage_profile", FUNNEL_SQL + "SELECT step, processed_count, loss_count FROM flow")
def rp10(t: Tables) -> DataFrame:
    return funnel(t).select("step", "processed_count", "loss_count")


@query(
    "rp11_executive_summary",
    """
    SELECT (SELECT count(*) FROM user_totals) AS total_users, (SELECT count(*) FROM artist_totals) AS total_artists,
      (SELECT CAST(sum(listen_count) AS BIGINT) FROM counts) AS total_listens,
      CAST(round((SELECT avg(unique_artists) FROM user_totals)) AS BIGINT) AS avg_artists_per_user,
      CAST(round((SELECT avg(total_listens) FROM user_totals)) AS BIGINT) AS avg_listens_per_user,
      coalesce(name, 'Unknown') AS top_artist, total_listens AS top_artist_listens, unique_listeners AS top_artist_listeners
    FROM (SELECT * FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 1) t LEFT JOIN artists ON artist_mbid = artist_id
    """,
)
def rp11(t: Tables) -> DataFrame:
    return reports.executive_summary(t.counts, t.artists)
