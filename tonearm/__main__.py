"""Command line: raw dumps in, counts, recommendations and report datasets out."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .operators.recommend import find_artists
from .operators.search import search_artists
from .plans import jobs, reports
from .schemas import ARTIST_METADATA, DEFAULT_MATCH_LEVELS, EXTERNAL_SIMILAR
from .session import build_session
from .sources import sinks
from .sources.listens import parse_months


def _arguments() -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tonearm", description=__doc__)
    p.add_argument("--data-root", required=True, help="folder of the monthly listen files and CSV dumps")
    p.add_argument("--working-root", required=True, help="folder for results and report datasets")
    p.add_argument("--scratch-root", required=True, help="folder for landed tables and models")
    p.add_argument("--months", default="1-12", help="'1-3' or '1,3,5'")
    p.add_argument("--quality-levels", default=",".join(DEFAULT_MATCH_LEVELS))
    p.add_argument("--force-reprocess", action="store_true")
    p.add_argument("--force-retrain", action="store_true")
    p.add_argument("--analyze-artists", nargs="*", help="artist ids to recommend for")
    p.add_argument("--search-artists", nargs="*", help="artist names to look up; their best matches become the seeds")
    p.add_argument("--listen-suffix", default=".listens.zst")
    p.add_argument("--mapping", default="msid_mapping.csv.zst")
    p.add_argument("--redirects", default="canonical_recording_redirect.csv.zst")
    p.add_argument("--canonical", default="canonical_data.csv.zst")
    p.add_argument("--artists", default="artist.csv")
    p.add_argument("--artist-metadata", help="JSON table of artist metadata")
    p.add_argument("--external-similar", help="JSON table of another recommender's lists")
    return p.parse_args()


def main() -> None:
    a = _arguments()
    spark = build_session()
    at = lambda name: f"{a.data_root.rstrip('/')}/{name}"
    out = a.working_root.rstrip("/")
    counts, quality, _ = jobs.build_counts(
        spark,
        a.data_root,
        a.scratch_root,
        parse_months(a.months),
        {"msid_mapping": at(a.mapping), "canonical_redirects": at(a.redirects), "canonical_data": at(a.canonical)},
        a.quality_levels.split(","),
        a.listen_suffix,
        a.force_reprocess,
    )
    artists = jobs.land_dimension(spark, "artists", at(a.artists), a.scratch_root, a.force_reprocess)
    sinks.write_counts_csv(counts, f"{out}/user_artist_counts.csv")
    sinks.write_json(quality, f"{out}/report/data_quality.json", one_file=True)

    requested = list(a.analyze_artists or [])
    if a.search_artists:
        names = spark.createDataFrame([(n,) for n in a.search_artists], "query string")
        hits = search_artists(names, artists)
        hits.orderBy("query", "rank").show(truncate=False)
        found, missing = find_artists(hits.filter("rank = 1").select(F.col("artist_mbid").alias("artist_id")), counts)
        missing.show(truncate=False)
        requested += [r["artist_id"] for r in found.toLocalIterator()]

    model, index = jobs.model_for(spark, counts, a.scratch_root, a.force_retrain)
    recs = jobs.recommendations_for(spark, counts, model, index, artists, requested)
    sinks.write_json(recs, f"{out}/recommendations.json")
    # Read back, so that the files below and the report share one result.
    recs = spark.read.schema(recs.schema).json(f"{out}/recommendations.json")
    sinks.write_recommendations(recs, f"{out}/recommendations")

    metadata = spark.read.schema(ARTIST_METADATA).json(a.artist_metadata) if a.artist_metadata else spark.createDataFrame([], ARTIST_METADATA)
    external = spark.read.schema(EXTERNAL_SIMILAR).json(a.external_similar) if a.external_similar else spark.createDataFrame([], EXTERNAL_SIMILAR)
    reports.full_report(counts, artists, recs, metadata, external, f"{out}/report", quality)
    spark.stop()


if __name__ == "__main__":
    main()
