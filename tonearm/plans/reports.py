"""The report's datasets. Each job is a function of tables and returns DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip_name
from ..operators import communities, compare, distribution, diversity, graph, profile, segments, stats
from ..operators.resolve import add_artist_names
from ..operators.sets import repeatable_sample
from ..schemas import UNKNOWN
from ..session import staged
from ..sources import sinks

# Sizes of the report's lists.
TOP_ARTISTS, NAMED_ARTISTS, TOP_USERS = 50, 20, 50
COMPARED_SEEDS, NETWORK_SEEDS, NETWORK_SEEDS_IN_REPORT = 10, 50, 30
RATIO_USERS, HISTOGRAM_BINS = 20, 30


def dataset_summary(counts: DataFrame, artists: DataFrame, totals: DataFrame | None = None) -> dict[str, DataFrame]:
    """Statistics, top artists with names, top users and the user chart datasets. ``totals`` are the user totals, where they are written."""
    totals = stats.user_totals(counts) if totals is None else totals
    best = stats.top_rows(stats.artist_totals(counts), "total_listens", "artist_id", NAMED_ARTISTS)
    named = add_artist_names(best, artists)
    labels = add_artist_names(best, artists, default=UNKNOWN).withColumn("label", clip_name(F.col("name")))
    return {
        "dataset_statistics": stats.dataset_statistics(counts),
        "top_artists": named,
        "top_artists_chart": labels.select("artist_id", "label", "total_listens"),
        "top_users": stats.top_rows(totals, "total_listens", "user_id", TOP_USERS),
        "user_listen_histogram": stats.histogram(totals, "total_listens", HISTOGRAM_BINS),
        "listening_trend": stats.listening_trend(totals),
        "activity_shares": stats.activity_shares(totals),
        "artists_per_1000": stats.artists_per_thousand(totals, RATIO_USERS),
    }


def summary_document(counts: DataFrame, artists: DataFrame) -> DataFrame:
    """The summary as one nested row: statistics and the list of top artists."""
    parts = dataset_summary(counts, artists)
    st = parts["dataset_statistics"]
    listed = parts["top_artists"].agg(
        F.reverse(
            F.array_sort(F.collect_list(F.struct("total_listens", "artist_id", "unique_listeners", "name")))
        ).alias("top_artists")
    )
    return st.select(F.struct(*st.columns).alias("dataset_statistics"), listed.scalar().alias("top_artists"))


def executive_summary(counts: DataFrame, artists: DataFrame) -> DataFrame:
    """One row: sizes, rounded averages and the most played artist."""
    best = add_artist_names(stats.top_artists(counts, 1), artists, default=UNKNOWN).select(
        F.col("name").alias("top_artist"), F.col("total_listens").alias("top_artist_listens"), F.col("unique_listeners").alias("top_artist_listeners")
    )
    row = stats.dataset_statistics(counts).select(
        "total_users",
        "total_artists",
        "total_listens",
        F.round("avg_artists_per_user").cast("long").alias("avg_artists_per_user"),
        F.round("avg_listens_per_user").cast("long").alias("avg_listens_per_user"),
    )
    return stats.combine_rows(row, best)


def recommendation_analysis(recommendations: DataFrame, artists: DataFrame) -> DataFrame:
    """Per seed its recommendations by rank, without the seed itself."""
    others = add_artist_names(recommendations.filter("rank > 1").drop("artist_name"), artists, "artist_id", "artist_name")
    items = F.array_sort(F.collect_list(F.struct("rank", "artist_id", "artist_name", "similarity_score")))
    return others.groupBy(*compare.seed_keys(others)).agg(items.alias("recommendations"))


def artist_diversity(counts: DataFrame, metadata: DataFrame, n: int = NAMED_ARTISTS) -> dict[str, DataFrame]:
    """Countries, genres and decades of the most played artists."""
    best = stats.top_rows(stats.artist_totals(counts), "total_listens", "artist_id", n)
    enriched = diversity.enrich_artists(best, metadata)
    countries = diversity.country_distribution(enriched)
    genres = diversity.genre_distribution(enriched)
    return {
        "artist_metadata": enriched,
        "country_distribution": countries,
        "country_chart": diversity.country_chart(countries),
        "genre_distribution": genres,
        "top_genres": diversity.top_genres(genres),
        "decade_distribution": diversity.decade_distribution(enriched),
    }


def external_comparison(recommendations: DataFrame, external: DataFrame, seeds: int | None = COMPARED_SEEDS, seed: int = 42) -> DataFrame:
    """Overlap with the outside lists for a repeatable sample of seeds (all with None)."""
    model = compare.model_lists(recommendations)
    if seeds is not None:
        model = repeatable_sample(model, seeds, compare.seed_keys(model)[0], seed)
    return compare.compare_lists(model, external)


def similarity_network(recommendations: DataFrame, artists: DataFrame, seeds: int | None = NETWORK_SEEDS, seed: int = 42) -> dict[str, DataFrame]:
    """Edges, nodes with degree and community, and the labelled nodes. Edges, and what seeds are sampled from, are written once."""
    chosen = recommendations.select("source_artist_id", "rank", "artist_id", "similarity_score")
    if seeds is not None:
        recommendations = chosen = staged(chosen, "recommendations")
        ids = repeatable_sample(recommendations.select("source_artist_id").distinct(), seeds, "source_artist_id", seed)
        chosen = recommendations.join(ids, "source_artist_id", "left_semi")
    edges = staged(graph.undirected(graph.edge_list(chosen)), "edges")
    degree = graph.degrees(edges)
    groups = communities.detect_communities(edges)
    return {
        "edges": edges,
        "nodes": degree.join(groups, "node"),
        "labels": graph.labelled_nodes(degree, artists),
    }


def user_segments(counts: DataFrame) -> dict[str, DataFrame] | None:
    """Named cluster statistics and chart points; None with too few users."""
    clustered = segments.cluster_users(segments.user_features(counts))
    return None if clustered is None else segment_datasets(clustered)


def segment_datasets(clustered: DataFrame) -> dict[str, DataFrame]:
    """The segments' datasets out of features with a cluster column."""
    return {
        "cluster_stats": segments.name_segments(segments.cluster_statistics(clustered)),
        "points": segments.chart_points(clustered),
        "centroids": segments.segment_centroids(clustered),
    }


def listener_report(counts: DataFrame) -> dict[str, DataFrame]:
    """Listener distribution: totals, percentiles, buckets, cumulative curve."""
    dist = distribution.listener_distribution(counts)
    return {
        "summary": distribution.distribution_summary(counts),
        "buckets": distribution.listener_buckets(dist),
        "cumulative": distribution.cumulative_distribution(dist),
        "histogram": distribution.first_points(dist),
        "single_listener": distribution.single_listener_artists(dist),
    }


def mapping_quality(listens: DataFrame, mapping: DataFrame) -> DataFrame:
    return profile.mapping_coverage(listens, mapping)


def full_report(
    counts: DataFrame,
    artists: DataFrame,
    recommendations: DataFrame,
    metadata: DataFrame,
    external: DataFrame,
    out: str,
    quality: DataFrame | None = None,
) -> dict[str, str]:
    """All datasets as JSON below ``out``. The counts are held once for all of them; what else several read is written once."""
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    recommendations = staged(recommendations, "recommendations")
    written: dict[str, str] = {}

    def save(folder: str, frames: Mapping[str, DataFrame]) -> None:
        for name, df in frames.items():
            path = f"{out.rstrip('/')}/{folder}/{name}.json"
            sinks.write_json(df, path)
            written[f"{folder}/{name}"] = path

    try:
        save("dataset_summary", dataset_summary(counts, artists, staged(stats.user_totals(counts), "totals")))
        save("recommendations", {"recommendations_analysis": recommendation_analysis(recommendations, artists)})
        save("network", similarity_network(recommendations, artists, NETWORK_SEEDS_IN_REPORT))
        found = user_segments(counts)
        if found is not None:
            save("user_segments", found)
        comparison = staged(external_comparison(recommendations, external), "comparison")
        save("comparison", {"external_comparison": comparison, "mean_overlap": compare.mean_overlap(comparison)})
        save("artist_diversity", artist_diversity(counts, metadata))
        save("artist_distribution", listener_report(counts))
        save("executive", {"summary": executive_summary(counts, artists)})
        if quality is not None:
            save("data_quality", {"data_quality": quality})
    finally:
        counts.unpersist()
    return written
