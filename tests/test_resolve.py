"""Resolution chain on hand-made tables."""

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from tonearm.operators import resolve

LISTENS = "user_id LONG, recording_msid STRING"
MAPPING = "recording_msid STRING, recording_mbid STRING, match_type STRING"
REDIRECTS = "recording_mbid STRING, canonical_recording_mbid STRING"
CANONICAL = "recording_mbid STRING, artist_mbids STRING"


@pytest.fixture()
def chain(spark):
    listens = spark.createDataFrame(
        [(1, "s1"), (1, "s1"), (1, "s2"), (2, "s2"), (2, "s3"), (2, "s4"), (3, "s5"), (3, "s9"), (None, "s1"), (3, None)], LISTENS
    )
    mapping = spark.createDataFrame(
        [
            ("s1", "m1", "exact_match"),
            ("s2", "m2", "high_quality"),
            ("s3", "m3", "med_quality"),
            ("s4", None, "no_match"),
            ("s5", "m5", "exact_match"),
            ("s5", "m6", "low_quality"),
            ("s9", "m9", "exact_match"),
        ],
        MAPPING,
    )
    redirects = spark.createDataFrame([("m1", "c1"), ("c1", "c2")], REDIRECTS)
    canonical = spark.createDataFrame([("c1", "a;b"), ("m2", ""), ("m3", "a"), ("m5", "a;;b"), ("m6", None)], CANONICAL)
    return listens, mapping, redirects, canonical


def test_plays_fallback_and_one_hop(chain):
    out = resolve.user_artist_counts(*chain)
    # m2 is blank and m9 absent: both stand in for themselves; the empty item of a;;b stays.
    assert rows(out) == sorted(
        [(1, "a", 2), (1, "b", 2), (1, "m2", 1), (2, "m2", 1), (3, "a", 1), (3, "", 1), (3, "b", 1), (3, "m9", 1)], key=repr
    )


def test_distinct_recordings_dropped_and_deduplicated(chain):
    out = resolve.user_artist_counts(
        *chain, levels=["exact_match", "high_quality", "medium_quality", "low_quality"], count_mode="distinct_recordings", unresolved="drop", dedupe_mapping=True
    )
    assert rows(out) == sorted([(1, "a", 1), (1, "b", 1), (2, "a", 1), (3, "a", 1), (3, "", 1), (3, "b", 1)], key=repr)


def test_duplicate_mapping_fans_out(chain):
    listens, mapping, redirects, canonical = chain
    both = resolve.user_artist_counts(listens, mapping, redirects, canonical, levels=["exact_match", "low_quality"])
    got = dict(((r["user_id"], r["artist_id"]), r["listen_count"]) for r in both.collect())
    assert got[(3, "m6")] == 1 and got[(3, "a")] == 1


def test_delimiter_is_a_pattern(spark, chain):
    listens, mapping, redirects, _ = chain
    canonical = spark.createDataFrame([("c1", "a,b;c")], CANONICAL)
    out = resolve.user_artist_counts(listens, mapping, redirects, canonical, delimiter="[;,]", unresolved="drop")
    assert {r["artist_id"] for r in out.collect()} == {"a", "b", "c"}


def test_levels_are_checked():
    assert resolve.match_levels(["medium_quality", "exact_match"]) == ["med_quality", "exact_match"]
    with pytest.raises(ValueError):
        resolve.match_levels(["good"])


def test_best_mapping_prefers_level_then_id(spark):
    m = spark.createDataFrame([("s", "m2", "exact_match"), ("s", "m1", "exact_match"), ("s", "m0", "low_quality")], MAPPING)
    assert rows(resolve.best_mapping(m)) == [("s", "m1", "exact_match")]


def test_restricted_mapping(chain):
    listens, mapping, _, _ = chain
    assert {r[0] for r in rows(resolve.restrict_mapping(mapping, listens.filter("user_id = 1")))} == {"s1", "s2"}


def test_names_default(spark):
    ids = spark.createDataFrame([("x",), ("y",)], "artist_id STRING")
    names = spark.createDataFrame([("x", "Ex")], "artist_mbid STRING, name STRING")
    assert rows(resolve.add_artist_names(ids, names)) == [("x", "Ex"), ("y", "Unknown Artist")]


def test_hot_message_id_is_split(spark):
    """One message id with most of the rows: the join splits its partition and loses nothing."""
    keep = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        n = 60_000
        hot = spark.range(n).select(F.col("id").alias("user_id"), F.when(F.col("id") % 3 != 0, F.lit("s0")).otherwise(F.concat(F.lit("s"), (F.col("id") % 200).cast("string"))).alias("recording_msid"))
        mapping = spark.range(200).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("recording_msid"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("recording_mbid"), F.lit("exact_match").alias("match_type"))
        none = spark.createDataFrame([], REDIRECTS)
        credits = spark.createDataFrame([], CANONICAL)
        out = resolve.user_artist_counts(hot, mapping, none, credits)
        total = out.agg(F.sum("listen_count").alias("n")).collect()[0]["n"]
        assert total == n
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
