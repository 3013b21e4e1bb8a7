"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tonearm.catalog import QUERIES

HEADLINE = (
    "ag01_user_artist_counts",
    "ag01_all_levels_deduplicated",
    "ag03_dataset_statistics",
    "ag07_top_artists",
    "ag11_listener_buckets",
    "ag14_user_features",
    "ag16_mapping_coverage",
    "ag21_duplicate_listens",
    "ag30_activity_shares",
    "ag36_mean_overlap",
    "ag39_stage_flow",
    "src01_json_listens",
    "snk01_parquet_by_month",
    "jn01_listens_mapping",
    "jn06_matrix_entries",
    "jn11_key_coverage",
    "jn14_artist_search",
    "wn01_artist_index",
    "wn03_cumulative_distribution",
    "wn04_activity_bands",
    "set03_best_mapping",
    "ml02_bm25_weights",
    "ml03_factor_model",
    "ml04_similar_items",
    "ml08_user_clusters",
    "gr02_undirected_edges",
    "gr06_redirect_chains",
    "rp07_listener_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ag07_top_artists"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
