"""Message id -> recording -> canonical recording -> artists, and the user-artist counts.

All three dimension joins run on dimension-sized tables first; the listens, the
only table that grows with traffic, are reduced to one row per (user, recording)
and then cross the network once for one join and once for the final sum.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import split_items
from ..schemas import DEFAULT_MATCH_LEVELS, MATCH_LEVEL_ALIASES, MATCH_LEVELS


def match_levels(levels: Iterable[str]) -> list[str]:
    """Checked level names; the spelling ``medium_quality`` is accepted."""
    out = [MATCH_LEVEL_ALIASES.get(level.strip(), level.strip()) for level in levels]
    unknown = sorted(set(out) - set(MATCH_LEVELS))
    if unknown:
        raise ValueError(f"unknown match levels {unknown}; known: {list(MATCH_LEVELS)}")
    return out


def match_rank(match_type: Column) -> Column:
    """0 for the best level; unknown levels last."""
    rank = F.lit(len(MATCH_LEVELS))
    for i, level in reversed(list(enumerate(MATCH_LEVELS))):
        rank = F.when(match_type == level, F.lit(i)).otherwise(rank)
    return rank


def keep_valid(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    return df.dropna(subset=list(keys))


def filter_match_levels(mapping: DataFrame, levels: Iterable[str] = DEFAULT_MATCH_LEVELS) -> DataFrame:
    return mapping.filter(F.col("match_type").isin(match_levels(levels)))


def drop_unmatched(mapping: DataFrame) -> DataFrame:
    return mapping.filter(F.col("match_type") != "no_match")


def restrict_to_keys(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``: a semi join, whatever the size of the key set."""
    wanted = keys.select(F.col(keys_key or key).alias(key))
    return df.join(wanted, key, "left_semi")


def restrict_mapping(mapping: DataFrame, listens: DataFrame, levels: Iterable[str] = DEFAULT_MATCH_LEVELS) -> DataFrame:
    """Mapping rows at an accepted level whose message id was listened to.

    The ids are made distinct before the join, so a hot id is one row there.
    """
    ids = listens.select("recording_msid").dropna().distinct()
    return restrict_to_keys(filter_match_levels(mapping, levels), ids, "recording_msid")


def best_mapping(mapping: DataFrame) -> DataFrame:
    """One row per message id: the best level, then the lowest recording id.

    ``min`` of a struct combines on the map side, so a message id with very
    many rows costs its task no more than any other.
    """
    best = mapping.groupBy("recording_msid").agg(
        F.min(
            F.struct(
                match_rank(F.col("match_type")).alias("rank"),
                F.col("recording_mbid").isNull().alias("no_mbid"),
                "recording_mbid",
                "match_type",
            )
        ).alias("b")
    )
    return best.select("recording_msid", "b.recording_mbid", "b.match_type")


def map_listens(listens: DataFrame, mapping: DataFrame) -> DataFrame:
    """Listens with a recording id (inner join; an id listed twice yields two rows)."""
    found = mapping.filter(F.col("recording_mbid").isNotNull()).select("recording_msid", "recording_mbid")
    return listens.join(found, "recording_msid", "inner")


def apply_redirects(df: DataFrame, redirects: DataFrame, column: str = "recording_mbid", to: str = "canonical_mbid") -> DataFrame:
    """Add ``to``: the redirect target of ``column``, or ``column`` itself. One hop."""
    hop = redirects.select(F.col("recording_mbid").alias(column), F.col("canonical_recording_mbid").alias("_target"))
    return df.join(hop, column, "left").withColumn(to, F.coalesce("_target", column)).drop("_target")


def attach_artists(
    df: DataFrame,
    canonical: DataFrame,
    column: str = "canonical_mbid",
    delimiter: str = ";",
    unresolved: str = "fallback",
) -> DataFrame:
    """Add ``artist_ids``, the list of artists of the canonical recording.

    ``fallback``: a recording without artists stands in as its own artist.
    ``drop``: such recordings leave the result.
    """
    if unresolved not in ("fallback", "drop"):
        raise ValueError("unresolved must be 'fallback' or 'drop'")
    credit = canonical.select(F.col("recording_mbid").alias(column), "artist_mbids")
    if unresolved == "drop":
        credit = credit.filter(F.col("artist_mbids").isNotNull() & (F.col("artist_mbids") != ""))
        out = df.join(credit, column, "inner")
        return out.withColumn("artist_ids", split_items(F.col("artist_mbids"), delimiter)).drop("artist_mbids")
    missing = F.col("artist_mbids").isNull() | (F.col("artist_mbids") == "")
    return (
        df.join(credit, column, "left")
        .withColumn(
            "artist_ids",
            F.when(missing, F.array(F.col(column))).otherwise(split_items(F.col("artist_mbids"), delimiter)),
        )
        .drop("artist_mbids")
    )


def explode_artists(df: DataFrame) -> DataFrame:
    """One row per artist of a non-empty list."""
    return (
        df.filter(F.size("artist_ids") > 0)
        .withColumn("artist_id", F.explode("artist_ids"))
        .drop("artist_ids")
        .filter(F.col("artist_id").isNotNull())
    )


def resolve_messages(
    mapping: DataFrame,
    redirects: DataFrame,
    canonical: DataFrame,
    levels: Iterable[str] = DEFAULT_MATCH_LEVELS,
    delimiter: str = ";",
    unresolved: str = "fallback",
    dedupe_mapping: bool = False,
) -> DataFrame:
    """(recording_msid, artist_id) rows: what one play of a message id counts for."""
    accepted = filter_match_levels(mapping, levels)
    if dedupe_mapping:
        accepted = best_mapping(accepted)
    known = accepted.filter(F.col("recording_mbid").isNotNull()).select("recording_msid", "recording_mbid")
    canonical_ids = apply_redirects(known, redirects).select("recording_msid", "canonical_mbid")
    with_artists = attach_artists(canonical_ids, canonical, delimiter=delimiter, unresolved=unresolved)
    return explode_artists(with_artists).select("recording_msid", "artist_id")


def plays_per_recording(listens: DataFrame, count_mode: str = "plays") -> DataFrame:
    """(user_id, recording_msid, plays). Combines on the map side before the shuffle."""
    if count_mode not in ("plays", "distinct_recordings"):
        raise ValueError("count_mode must be 'plays' or 'distinct_recordings'")
    valid = keep_valid(listens, "user_id", "recording_msid")
    plays = F.count(F.lit(1)) if count_mode == "plays" else F.max(F.lit(1)).cast("long")
    return valid.groupBy("user_id", "recording_msid").agg(plays.alias("plays"))


def user_artist_counts(
    listens: DataFrame,
    mapping: DataFrame,
    redirects: DataFrame,
    canonical: DataFrame,
    levels: Iterable[str] = DEFAULT_MATCH_LEVELS,
    count_mode: str = "plays",
    unresolved: str = "fallback",
    delimiter: str = ";",
    dedupe_mapping: bool = False,
) -> DataFrame:
    """(user_id, artist_id, listen_count), the table everything else is built on."""
    artists = resolve_messages(mapping, redirects, canonical, levels, delimiter, unresolved, dedupe_mapping)
    return (
        plays_per_recording(listens, count_mode)
        .join(artists, "recording_msid", "inner")
        .groupBy("user_id", "artist_id")
        .agg(F.sum("plays").alias("listen_count"))
    )


def add_artist_names(df: DataFrame, artists: DataFrame, id_col: str = "artist_id", name_col: str = "name", default: str = "Unknown Artist") -> DataFrame:
    """Left join of artist names; ``default`` where there is none."""
    names = artists.select(F.col("artist_mbid").alias(id_col), F.col("name").alias("_name"))
    return df.join(names, id_col, "left").withColumn(name_col, F.coalesce("_name", F.lit(default))).drop("_name")
