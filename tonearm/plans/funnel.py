"""Stage profile: what every step from listens to counts keeps and loses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import item_count, split_items
from ..operators.profile import stage_flow
from ..operators.resolve import apply_redirects, best_mapping, filter_match_levels, restrict_to_keys
from ..operators.sets import distinct_items
from ..schemas import MATCH_LEVELS
from ..session import staged

ACCEPTED = MATCH_LEVELS[:4]

# Names of the profiled steps.
STEPS = (
    "Clean Listen Events",
    "MSID to MBID Mapping",
    "Canonical Redirection",
    "Finding Artists for Recordings",
    "Finding Artist Names",
    "Generating User-Artist Counts",
)


def _n(df: DataFrame, *columns: str) -> DataFrame:
    """One-row count of distinct rows of the columns (null counts as a value)."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n"))


def message_counts(listens: DataFrame) -> DataFrame:
    """(recording_msid, plays, users); rows without a message id are one row."""
    pairs = listens.groupBy("recording_msid", "user_id").agg(F.count(F.lit(1)).alias("plays"))
    return pairs.groupBy("recording_msid").agg(F.sum("plays").alias("plays"), F.count(F.lit(1)).alias("users"))


def profiled_mapping(listens: DataFrame, mapping: DataFrame, redirects: DataFrame, levels: Iterable[str] = ACCEPTED) -> DataFrame:
    """One mapping row per listened message id, with its canonical recording."""
    ids = listens.select("recording_msid").dropna().distinct()
    kept = best_mapping(filter_match_levels(restrict_to_keys(mapping, ids, "recording_msid"), levels))
    hops = redirects.groupBy("recording_mbid").agg(F.max("canonical_recording_mbid").alias("canonical_recording_mbid"))
    return apply_redirects(kept, hops)


def credited(canonical: DataFrame) -> DataFrame:
    """Canonical rows with at least one artist, as (recording_mbid, artist_ids)."""
    named = canonical.filter(item_count(F.col("artist_mbids")) > 0)
    return named.select("recording_mbid", split_items(F.col("artist_mbids")).alias("artist_ids"))


def stage_funnel(listens: DataFrame, mapping: DataFrame, redirects: DataFrame, canonical: DataFrame, artists: DataFrame) -> DataFrame:
    """Six steps, each with rows or distinct keys before and after.

    The listens are read once, for a written table of plays and users per message
    id; a clean listen is a distinct (user, message id) with a message id. The last
    step weighs each message id with its users instead of joining every listen.
    """
    messages = staged(message_counts(listens), "messages")
    clean = messages.filter(F.col("recording_msid").isNotNull())
    canonical_mapping = staged(profiled_mapping(messages, mapping, redirects), "canonical-mapping")
    targets = canonical_mapping.select(F.col("canonical_mbid").alias("recording_mbid")).distinct()
    found = canonical.join(targets, "recording_mbid", "left_semi")
    with_artists = credited(found)
    artist_ids = distinct_items(with_artists, "artist_ids", "artist_mbid")
    named = artist_ids.join(artists.select("artist_mbid"), "artist_mbid", "left_semi")

    sizes = with_artists.select(F.col("recording_mbid").alias("canonical_mbid"), F.size("artist_ids").alias("k"))
    pairs = (
        canonical_mapping.select("recording_msid", "canonical_mbid")
        .join(sizes, "canonical_mbid")
        .join(clean.select("recording_msid", "users"), "recording_msid")
        .agg(F.coalesce(F.sum(F.col("users") * F.col("k")), F.lit(0)).alias("n"))
    )
    counts = (
        (_total(messages, "plays"), _total(clean, "users")),
        (_rows(clean), _n(canonical_mapping, "recording_msid")),
        (_n(canonical_mapping, "recording_mbid"), _n(canonical_mapping, "canonical_mbid")),
        (_n(canonical_mapping, "canonical_mbid"), _n(found, "recording_mbid")),
        (_rows(artist_ids), _rows(named)),
        (_total(clean, "users"), pairs),
    )
    return stage_flow([(step, before, after) for step, (before, after) in zip(STEPS, counts)])
