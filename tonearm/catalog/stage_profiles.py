"""The datasets of the stage profile job, and redirect chains followed to their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.redirect_ends import redirect_ends
from ..operators.sets import union_all
from ..plans import stage_profile
from ..plans.adapters import Tables
from ..plans.stage_profile import StageProfile
from ..session import scratch_path
from .base import query, rounded
from .ingest import _CANONICAL_MAPPING, FUNNEL_SQL

_TABLES = {"listens": "listens", "mapping": "msid_mapping", "redirects": "redirects", "canonical": "canonical", "artists": "artists"}
_COLUMNS = {
    "listens": ("user_id", "recording_msid"),
    "mapping": ("recording_msid", "recording_mbid", "match_type"),
    "redirects": ("recording_mbid", "canonical_recording_mbid"),
    "canonical": ("recording_mbid", "artist_mbids"),
    "artists": ("artist_mbid", "name"),
}


def profiled(t: Tables) -> StageProfile:
    return StageProfile(t.listens, t.mapping, t.redirects, t.canonical, t.artists)


def _columns_sql() -> str:
    rows = [
        f"SELECT '{name}' AS \"table\", '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, round((count(*) - count({c}))::DOUBLE / count(*) * 100, 6) AS null_pct, count(DISTINCT {c}) AS distinct_values FROM {_TABLES[name]}"
        for name, columns in _COLUMNS.items()
        for c in columns
    ]
    return "\nUNION ALL ".join(rows)


@query("rp10_columns", _columns_sql())
def rp10_columns(t: Tables) -> DataFrame:
    return rounded(profiled(t).columns(), "null_pct")


def _duplicates_sql() -> str:
    rows = []
    for name, keys in stage_profile.KEYS.items():
        for key in keys:
            columns = ", ".join(key)
            rows.append(
                f"SELECT '{name}' AS \"table\", '{','.join(key)}' AS key, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows,"
                f" CAST(sum(n - 1) AS BIGINT) AS extra_rows, round(coalesce(sum(n) FILTER (n > 1), 0)::DOUBLE / sum(n) * 100, 6) AS duplicate_pct FROM (SELECT {columns}, count(*) AS n FROM {_TABLES[name]} GROUP BY {columns}) t"
            )
    return "\nUNION ALL ".join(rows)


@query("rp10_duplicates", _duplicates_sql())
def rp10_duplicates(t: Tables) -> DataFrame:
    return rounded(profiled(t).duplicates(), "duplicate_pct")


_ARTIST_COUNT = "CASE WHEN trim(artist_mbids) = '' THEN 0 ELSE len(string_split(artist_mbids, ';')) END"


@query(
    "rp10_spreads",
    f"""
    SELECT measure, round(avg(x), 6) AS mean, median(x) AS median, min(x) AS min, max(x) AS max FROM (
      SELECT 'listens per user' AS measure, count(*) AS x FROM listens GROUP BY user_id
      UNION ALL SELECT 'listens per recording', count(*) FROM listens GROUP BY recording_msid
      UNION ALL SELECT 'artists per recording', {_ARTIST_COUNT} FROM canonical) t
    GROUP BY measure
    """,
)
def rp10_spreads(t: Tables) -> DataFrame:
    return rounded(profiled(t).spreads(), "mean")


@query(
    "rp10_shares",
    f"""
    SELECT measure, value, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY measure) * 100, 6) AS percentage FROM (
      SELECT 'match type' AS measure, match_type AS value, count(*) AS n FROM msid_mapping GROUP BY ALL
      UNION ALL SELECT 'artists per recording', CAST({_ARTIST_COUNT} AS VARCHAR), count(*) FROM canonical GROUP BY ALL) t
    """,
)
def rp10_shares(t: Tables) -> DataFrame:
    return rounded(profiled(t).shares(), "percentage")


@query(
    "rp10_coverage",
    _CANONICAL_MAPPING.rstrip()
    + """,
    keys AS (
      SELECT 'msids in mapping' AS step, count(DISTINCT recording_msid) AS total_keys,
             count(DISTINCT recording_msid) FILTER (recording_msid IN (SELECT recording_msid FROM msid_mapping)) AS found_keys FROM listens
      UNION ALL SELECT 'mbids redirected', count(DISTINCT recording_mbid),
             count(DISTINCT recording_mbid) FILTER (recording_mbid IN (SELECT recording_mbid FROM redirects)) FROM msid_mapping
      UNION ALL SELECT 'canonical mbids with data', count(DISTINCT canonical_mbid),
             count(DISTINCT canonical_mbid) FILTER (canonical_mbid IN (SELECT recording_mbid FROM canonical)) FROM canonical_mapping)
    SELECT step, total_keys, found_keys, total_keys - found_keys AS missing_keys, round(found_keys::DOUBLE / total_keys * 100, 6) AS found_pct FROM keys
    """,
)
def rp10_coverage(t: Tables) -> DataFrame:
    return rounded(profiled(t).coverage(), "found_pct")


@query(
    "rp10_redirects",
    """
    SELECT count(*) AS rows, count(*) FILTER (recording_mbid = canonical_recording_mbid) AS self_redirects,
      round(count(*) FILTER (recording_mbid = canonical_recording_mbid)::DOUBLE / count(*) * 100, 6) AS self_redirect_pct,
      (SELECT count(DISTINCT canonical_recording_mbid) FROM redirects WHERE canonical_recording_mbid IN (SELECT recording_mbid FROM redirects)) AS redirected_targets,
      CAST(1 AS BIGINT) AS longest_chain, CAST(0 AS BIGINT) AS circular_sources, CAST(0 AS BIGINT) AS ambiguous_sources
    FROM redirects
    """,
)
def rp10_redirects(t: Tables) -> DataFrame:
    return rounded(profiled(t).redirects(), "self_redirect_pct")


@query(
    "rp10_canonicalisation",
    _CANONICAL_MAPPING
    + """
    SELECT before, after, before - after AS reduction, round((before - after)::DOUBLE / before * 100, 6) AS reduction_pct,
           moved AS redirected_rows, round(moved::DOUBLE / rows * 100, 6) AS redirected_pct
    FROM (SELECT count(DISTINCT recording_mbid) AS before, count(DISTINCT canonical_mbid) AS after,
                 count(*) FILTER (recording_mbid <> canonical_mbid) AS moved, count(*) AS rows FROM canonical_mapping) t
    """,
)
def rp10_canonicalisation(t: Tables) -> DataFrame:
    return rounded(profiled(t).canonicalisation(), "reduction_pct", "redirected_pct")


@query(
    "rp10_top_keys",
    """
    (SELECT 'user_id' AS key, CAST(user_id AS VARCHAR) AS value, count(*) AS listens FROM listens GROUP BY user_id ORDER BY listens DESC, value LIMIT 30)
    UNION ALL (SELECT 'recording_msid', recording_msid, count(*) AS listens FROM listens GROUP BY recording_msid ORDER BY listens DESC, recording_msid LIMIT 30)
    """,
)
def rp10_top_keys(t: Tables) -> DataFrame:
    return profiled(t).top_keys()


@query(
    "rp10_written_job",
    FUNNEL_SQL.rstrip()
    + """
    SELECT 'columns' AS dataset, CAST(11 AS BIGINT) AS rows UNION ALL SELECT 'duplicates', 10 UNION ALL SELECT 'spreads', 3
    UNION ALL SELECT 'shares', (SELECT count(DISTINCT match_type) FROM msid_mapping) + (SELECT count(DISTINCT artist_mbids = '') FROM canonical)
    UNION ALL SELECT 'coverage', 3 UNION ALL SELECT 'redirects', 1 UNION ALL SELECT 'canonicalisation', 1 UNION ALL SELECT 'flow', (SELECT count(*) FROM flow)
    UNION ALL SELECT 'top_keys', (SELECT least(30, count(DISTINCT user_id)) + least(30, count(DISTINCT recording_msid)) FROM listens)
    UNION ALL SELECT 'retention', 1 UNION ALL SELECT 'losses', (SELECT count(*) FROM flow WHERE 100 - retention_pct > 10)
    UNION ALL SELECT 'column_sketches', 11
    """,
)
def rp10_written_job(t: Tables) -> DataFrame:
    """The whole job with sketches for the columns, written and read back: rows per dataset."""
    tables = {"listens": t.listens, "mapping": t.mapping, "redirects": t.redirects, "canonical": t.canonical, "artists": t.artists}
    paths = stage_profile.write_stage_profile(tables, scratch_path(t.spark, "stage-profile"), exact=False)
    rows = [t.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows") for name, p in paths.items()]
    return union_all(*rows)


_LONG_CHAINS = """--with
links AS (
  SELECT concat('m', p_partkey) AS recording_mbid,
         concat('m', CASE WHEN p_partkey % 120 = 0 THEN p_partkey - 13 ELSE p_partkey + 1 END) AS canonical_recording_mbid
  FROM part WHERE p_partkey % 40 <> 0 OR p_partkey % 120 = 0),
"""


def long_chains(t: Tables) -> DataFrame:
    """Chains of up to 40 links, every third of them into a cycle of 14."""
    k = F.col("p_partkey")
    target = F.when(k % 120 == 0, k - 13).otherwise(k + 1)
    rows = t.read("part").select("p_partkey").filter((k % 40 != 0) | (k % 120 == 0))
    return rows.select(F.concat(F.lit("m"), k.cast("string")).alias("recording_mbid"), F.concat(F.lit("m"), target.cast("string")).alias("canonical_recording_mbid"))


@query(
    "gr06_redirect_ends",
    _LONG_CHAINS
    + """
    walk(start, path, current, closed) AS (
      SELECT recording_mbid, [recording_mbid, canonical_recording_mbid], canonical_recording_mbid, recording_mbid = canonical_recording_mbid FROM links
      UNION ALL
      SELECT w.start, list_append(w.path, r.canonical_recording_mbid), r.canonical_recording_mbid, list_contains(w.path, r.canonical_recording_mbid)
      FROM walk w JOIN links r ON r.recording_mbid = w.current WHERE NOT w.closed),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY len(path) DESC) AS rn FROM walk) t WHERE rn = 1)
    SELECT start AS recording_mbid, current AS final_mbid, CAST(len(path) - 1 AS BIGINT) AS hops, CASE WHEN closed THEN 'circular' ELSE 'terminal' END AS status,
           CASE WHEN closed THEN list_min(path[list_position(path, current):]) END AS cycle
    FROM last
    """,
    recursive=True,
)
def gr06_ends(t: Tables) -> DataFrame:
    """Chains of any length to their ends, cycles by their lowest id; no hop limit."""
    return redirect_ends(long_chains(t))
