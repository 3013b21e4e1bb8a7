"""Matrix, weights, factor model, similar items, seeds, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import recommend, segments
from ..plans import jobs
from ..plans.adapters import Tables
from ..session import scratch_path
from ..sources import sinks
from .base import query, r6, rounded
from .ingest import SIMILAR_SQL, label_vectors
from .joins import _INDEX



@query("ml01_matrix", _INDEX + "SELECT user_idx, item_idx, listen_count FROM counts JOIN ai USING (artist_id) JOIN ui USING (user_id)")
def ml01(t: Tables) -> DataFrame:
    entries, _, _ = recommend.build_matrix(t.landed_counts)
    return entries


@query(
    "ml02_bm25_weights",
    """
    SELECT c.user_id, c.artist_id,
      round(c.listen_count * 101.0::DOUBLE / (100.0::DOUBLE * (0.2::DOUBLE + 0.8::DOUBLE * u.total_listens / (SELECT avg(total_listens) FROM user_totals)) + c.listen_count)
        * (ln((SELECT count(*) FROM user_totals)::DOUBLE) - ln(1 + a.unique_listeners::DOUBLE)), 6) AS weight
    FROM counts c JOIN user_totals u USING (user_id) JOIN artist_totals a USING (artist_id)
    """,
)
def ml02(t: Tables) -> DataFrame:
    return rounded(recommend.bm25_weights(t.landed_counts), "weight")


def _weighted(t: Tables) -> tuple[DataFrame, DataFrame]:
    weights = recommend.bm25_weights(t.landed_counts)
    artists = recommend.dense_index(t.landed_counts, "artist_id", "item_idx")
    users = recommend.dense_index(t.landed_counts, "user_id", "user_idx")
    entries = weights.join(artists, "artist_id").join(users, "user_id").select("user_idx", "item_idx", "weight")
    return entries, artists


@query(
    "ml03_factors_per_artist",
    "SELECT DISTINCT artist_id, CAST(64 AS INTEGER) AS factors, TRUE AS finite FROM counts",
)
def ml03_shape(t: Tables) -> DataFrame:
    """Every artist has a vector of the asked length, and no number in it is lost."""
    entries, artists = _weighted(t)
    model = recommend.train_model(entries)
    finite = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return recommend.artist_factors(model, artists).select("artist_id", F.size("features").alias("factors"), finite.alias("finite"))


@query("ml03_factor_model")
def ml03(t: Tables) -> DataFrame:
    """Factors per artist with their length, and the training loss."""
    entries, artists = _weighted(t)
    model = recommend.train_model(entries)
    loss = recommend.training_loss(model, entries).select("loss").scalar()
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + (x * x).cast("double")))
    return recommend.artist_factors(model, artists).select("artist_id", F.size("features").alias("factors"), norm.alias("norm"), loss.alias("loss"))


_SIMILAR = SIMILAR_SQL + "SELECT seed_id, item_id, round(score, 6) AS score, rank FROM similar_vectors"


@query("ml04_similar_items", _SIMILAR, views=False)
def ml04(t: Tables) -> DataFrame:
    return rounded(recommend.similar_items(*label_vectors(t)), "score")


@query("ml04_similar_items_blocked", _SIMILAR, views=False)
def ml04_blocked(t: Tables) -> DataFrame:
    """The way for many seeds: blocks of seeds against blocks of items."""
    seeds, items = label_vectors(t)
    return rounded(recommend.similar_items(seeds, items, seeds_per_block=4, items_per_block=200), "score")


@query("ml05_recommendations")
def ml05(t: Tables) -> DataFrame:
    """The most played artists' 20 nearest artists with names."""
    model, index = jobs.model_for(t.spark, t.landed_counts, scratch_path(t.spark, "model"))
    return jobs.recommendations_for(t.spark, t.landed_counts, model, index, t.artists)


@query(
    "ml05_recommendation_shape",
    """--with
    top AS (SELECT artist_id, total_listens FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 10)
    SELECT artist_id AS source_artist_id, coalesce(name, 'Unknown Artist') AS source_artist, CAST(20 AS BIGINT) AS n,
           CAST(20 AS BIGINT) AS artists, CAST(1 AS INTEGER) AS first_rank, CAST(20 AS INTEGER) AS last_rank, 1.0::DOUBLE AS best, TRUE AS holds_itself
    FROM top LEFT JOIN artists ON artist_mbid = artist_id
    """,
)
def ml05_shape(t: Tables) -> DataFrame:
    """Each of the ten most played artists has 20 ranked ones, itself among them, the best at similarity 1."""
    model, index = jobs.model_for(t.spark, t.landed_counts, scratch_path(t.spark, "model"))
    recs = jobs.recommendations_for(t.spark, t.landed_counts, model, index, t.artists)
    return recs.groupBy("source_artist_id", "source_artist").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("artist_id").alias("artists"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.round(F.max("similarity_score"), 4).alias("best"),
        F.bool_or(F.col("artist_id") == F.col("source_artist_id")).alias("holds_itself"),
    )


@query(
    "ml06_seeds_popular_and_defaults",
    """
    SELECT artist_id FROM (SELECT artist_id FROM artist_totals ORDER BY total_listens DESC, artist_id LIMIT 10) t
    UNION SELECT artist_id FROM artist_totals WHERE artist_id IN ('Brand#1', 'Brand#7', 'nobody')
    """,
)
def ml06(t: Tables) -> DataFrame:
    return recommend.select_seeds(t.landed_counts, None, ["Brand#1", "Brand#7", "nobody"])


@query(
    "ml06_seeds_requested",
    "SELECT DISTINCT concat('m', p_partkey) AS artist_id FROM part WHERE concat('m', p_partkey) IN (SELECT artist_id FROM counts)",
)
def ml06_requested(t: Tables) -> DataFrame:
    wanted = t.read("part").select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("artist_id"))
    return recommend.select_seeds(t.landed_counts, wanted)


@query(
    "ml07_standardised_features",
    """--with
    f AS (SELECT user_id, count(*)::DOUBLE AS a, sum(listen_count)::DOUBLE AS l, avg(listen_count) AS m,
                 stddev_samp(listen_count) AS s, max(listen_count)::DOUBLE AS x
          FROM counts GROUP BY user_id HAVING count(*) > 5)
    SELECT user_id, round((a - (SELECT avg(a) FROM f)) / (SELECT stddev_samp(a) FROM f), 5) AS z_artists,
           round((l - (SELECT avg(l) FROM f)) / (SELECT stddev_samp(l) FROM f), 5) AS z_listens,
           round((x - (SELECT avg(x) FROM f)) / (SELECT stddev_samp(x) FROM f), 5) AS z_max
    FROM f
    """,
)
def ml07(t: Tables) -> DataFrame:
    scaled = segments.standardise(segments.user_features(t.landed_counts))
    at = lambda i, name: F.round(F.col(f"x{i}"), 5).alias(name)
    return scaled.select("user_id", at(0, "z_artists"), at(1, "z_listens"), at(4, "z_max"))


@query("ml08_user_clusters")
def ml08(t: Tables) -> DataFrame:
    return segments.cluster_users(segments.user_features(t.landed_counts)).select("user_id", "cluster")


@query("ml09_named_segments")
def ml09(t: Tables) -> DataFrame:
    clustered = segments.cluster_users(segments.user_features(t.landed_counts))
    named = segments.name_segments(segments.cluster_statistics(clustered))
    return named.withColumn("example_users", F.array_join("example_users", ","))


@query("ml10_segment_centroids")
def ml10(t: Tables) -> DataFrame:
    clustered = segments.cluster_users(segments.user_features(t.landed_counts))
    return rounded(segments.segment_centroids(clustered), "centre_artists", "centre_listens")


@query(
    "ml11_points_of_all_users",
    "SELECT user_id, count(*) AS artist_count, CAST(sum(listen_count) AS BIGINT) AS total_listens, TRUE AS clustered FROM counts GROUP BY user_id HAVING count(*) > 5",
)
def ml11_points(t: Tables) -> DataFrame:
    points = segments.chart_points(segments.cluster_users(segments.user_features(t.landed_counts)))
    return points.select("user_id", "artist_count", "total_listens", F.col("cluster").between(0, 2).alias("clustered"))


@query("ml11_segment_points")
def ml11(t: Tables) -> DataFrame:
    return segments.chart_points(segments.cluster_users(segments.user_features(t.landed_counts)))


_FEATURES_SQL = """--with
f AS (SELECT user_id, count(*) AS artist_count, CAST(sum(listen_count) AS BIGINT) AS total_listens, avg(listen_count) AS avg_listens_per_artist,
             stddev_samp(listen_count) AS stddev_listens, max(listen_count) AS max_listens
      FROM counts GROUP BY user_id HAVING count(*) > 5),
given AS (SELECT *, CAST(user_id % 3 AS INTEGER) AS cluster FROM f),
stats AS (SELECT cluster AS cluster_id, count(*) AS user_count, round(avg(artist_count), 6) AS avg_artists, round(avg(total_listens), 6) AS avg_listens,
                 round(avg(avg_listens_per_artist), 6) AS avg_listens_per_artist, array_to_string(list_sort(list(user_id))[1:5], ',') AS example_users
          FROM given GROUP BY cluster)
"""


def given_clusters(t: Tables) -> DataFrame:
    """Users in three groups by their number: what is computed of clusters can be checked row by row."""
    features = segments.user_features(t.landed_counts)
    return features.withColumn("cluster", (F.col("user_id") % 3).cast("int"))


@query(
    "ml08_nearest_centres",
    _FEATURES_SQL.rstrip()
    + """,
    z AS (SELECT user_id, cluster, (artist_count - avg(artist_count) OVER ()) / stddev_samp(artist_count) OVER () AS x0, (total_listens - avg(total_listens) OVER ()) / stddev_samp(total_listens) OVER () AS x1,
                 (avg_listens_per_artist - avg(avg_listens_per_artist) OVER ()) / stddev_samp(avg_listens_per_artist) OVER () AS x2,
                 (stddev_listens - avg(stddev_listens) OVER ()) / stddev_samp(stddev_listens) OVER () AS x3, (max_listens - avg(max_listens) OVER ()) / stddev_samp(max_listens) OVER () AS x4 FROM given),
    c AS (SELECT cluster AS no, avg(x0) AS c0, avg(x1) AS c1, avg(x2) AS c2, avg(x3) AS c3, avg(x4) AS c4 FROM z GROUP BY cluster),
    d AS (SELECT user_id, no, (x0-c0)*(x0-c0) + (x1-c1)*(x1-c1) + (x2-c2)*(x2-c2) + (x3-c3)*(x3-c3) + (x4-c4)*(x4-c4) AS d FROM z, c)
    SELECT user_id, CAST(arg_min(no, d) AS INTEGER) AS cluster FROM d GROUP BY user_id
    """,
)
def ml08_nearest(t: Tables) -> DataFrame:
    """Every user at the nearest of three given centres, the means of the three groups."""
    points = segments.standardise(given_clusters(t))
    means = points.groupBy("cluster").agg(*(F.avg(f"x{i}") for i in range(len(segments.FEATURES)))).orderBy("cluster").collect()
    return segments.assign(points.drop("cluster"), [list(r)[1:] for r in means]).select("user_id", "cluster")


@query("ag15_given_clusters", _FEATURES_SQL + "SELECT * FROM stats")
def ag15_given(t: Tables) -> DataFrame:
    stats = segments.cluster_statistics(given_clusters(t)).withColumn("example_users", F.array_join("example_users", ","))
    return rounded(stats, "avg_artists", "avg_listens", "avg_listens_per_artist")


@query(
    "ml09_given_clusters",
    _FEATURES_SQL.rstrip()
    + """,
    power AS (SELECT arg_max(cluster_id, avg_listens_per_artist) AS p FROM stats),
    explorer AS (SELECT arg_max(cluster_id, avg_artists) AS e FROM stats, power WHERE cluster_id <> p)
    SELECT cluster_id, user_count, CASE cluster_id WHEN p THEN 'Power Users' WHEN e THEN 'Explorers' ELSE 'Casual Listeners' END AS name FROM stats, power, explorer
    """,
)
def ml09_given(t: Tables) -> DataFrame:
    return segments.name_segments(segments.cluster_statistics(given_clusters(t))).select("cluster_id", "user_count", "name")


@query("ml10_given_clusters", _FEATURES_SQL + "SELECT cluster, round(avg(artist_count), 6) AS centre_artists, round(avg(total_listens), 6) AS centre_listens FROM given GROUP BY cluster")
def ml10_given(t: Tables) -> DataFrame:
    return rounded(segments.segment_centroids(given_clusters(t)), "centre_artists", "centre_listens")


@query("snk06_saved_artists", "SELECT DISTINCT artist_id FROM counts")
def snk06_artists(t: Tables) -> DataFrame:
    """Artists of the model that was saved and loaded again."""
    root = scratch_path(t.spark, "saved-model")
    jobs.model_for(t.spark, t.landed_counts, root)
    model, index, _ = sinks.load_model(t.spark, root, jobs.model_key(t.landed_counts))
    return recommend.artist_factors(model, index).select("artist_id")


@query("snk06_saved_model")
def snk06(t: Tables) -> DataFrame:
    """Train, save, load by the fingerprint of the data; factors of the loaded model."""
    root = scratch_path(t.spark, "saved-model")
    jobs.model_for(t.spark, t.landed_counts, root)
    model, index, _ = sinks.load_model(t.spark, root, jobs.model_key(t.landed_counts))
    factors = recommend.artist_factors(model, index)
    return factors.select("artist_id", r6(F.col("features")[0], "first_factor"))
