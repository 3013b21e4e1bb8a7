"""Declared schemas and fixed values. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Match levels, best first; defaults and labels that results
# must carry to be comparable.
MATCH_LEVELS = ("exact_match", "high_quality", "med_quality", "low_quality", "no_match")
MATCH_LEVEL_ALIASES = {"medium_quality": "med_quality"}
DEFAULT_MATCH_LEVELS = ("exact_match", "high_quality")
LISTENER_BUCKETS = ((1, 1), (2, 2), (3, 5), (6, 10), (11, 20), (21, 50), (51, 100), (101, None))
ACTIVITY_BANDS = ("Top 1% Users", "Next 9% Users", "Next 40% Users", "Bottom 50% Users")
DEFAULT_SEEDS = (
    "169c4c28-858e-497b-81a4-8bc15e0026ea",
    "a74b1b7f-71a5-4011-9441-d0b5e4122711",
    "46eb0fb7-9725-43af-97d7-6c717682a799",
)
SEGMENT_NAMES = ("Casual Listeners", "Power Users", "Explorers")
UNKNOWN_ARTIST = "Unknown Artist"
UNKNOWN = "Unknown"
# --------------------------------------------------------------------------

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


RAW_LISTEN = _struct(
    user_id=_L,
    recording_msid=_S,
    track_metadata=_struct(recording_msid=_S, additional_info=_struct(recording_msid=_S)),
    _corrupt_record=_S,
)
LISTENS = _struct(user_id=_L, recording_msid=_S)
MSID_MAPPING = _struct(recording_msid=_S, recording_mbid=_S, match_type=_S)
REDIRECTS = _struct(recording_mbid=_S, canonical_recording_mbid=_S, canonical_release_mbid=_S)
CANONICAL = _struct(
    id=_L,
    artist_credit_id=_L,
    artist_mbids=_S,
    artist_credit_name=_S,
    release_mbid=_S,
    release_name=_S,
    recording_mbid=_S,
    recording_name=_S,
    combined_lookup=_S,
    score=_L,
)
ARTISTS = _struct(artist_mbid=_S, name=_S)
COUNTS = _struct(user_id=_L, artist_id=_S, listen_count=_L)
RECOMMENDATIONS = _struct(rank=T.IntegerType(), artist_id=_S, artist_name=_S, similarity_score=_D)
ARTIST_METADATA = _struct(
    artist_mbid=_S,
    name=_S,
    country=_S,
    genres=T.ArrayType(_S),
    tags=T.ArrayType(_S),
    start_date=_S,
    end_date=_S,
    type=_S,
)
EXTERNAL_SIMILAR = _struct(artist_name=_S, similar=T.ArrayType(_S))

# Columns that the resolution job reads from each landed table.
STAGE_COLUMNS = {
    "msid_mapping": ("recording_msid", "recording_mbid", "match_type"),
    "canonical_redirects": ("recording_mbid", "canonical_recording_mbid"),
    "canonical_data": ("recording_mbid", "artist_mbids", "artist_credit_name"),
    "artists": ("artist_mbid", "name"),
}
STAGE_SCHEMAS = {
    "msid_mapping": MSID_MAPPING,
    "canonical_redirects": REDIRECTS,
    "canonical_data": CANONICAL,
    "artists": ARTISTS,
}
