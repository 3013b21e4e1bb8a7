"""Listening-history views over the given star-schema tables.

Orders and line items give listens, parts give the mapping, redirect, canonical
and artist tables. ``VIEWS_SQL`` states the same views in SQL for the checks.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.resolve import user_artist_counts
from ..session import staged


class Tables:
    """Lazily read tables of one data folder, and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def read(self, name: str) -> DataFrame:
        """The table; its file footer is looked at only once."""
        path = f"{self.sf_dir}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    @cached_property
    def listens(self) -> DataFrame:
        orders = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return (
            self.read("lineitem")
            .select("l_orderkey", "l_partkey")
            .join(orders, "l_orderkey")
            .select(F.col("o_custkey").alias("user_id"), F.concat(F.lit("s"), F.col("l_partkey").cast("string")).alias("recording_msid"))
        )

    @cached_property
    def monthly_listens(self) -> DataFrame:
        """Listens with the month of their order."""
        orders = self.read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.month("o_orderdate").alias("month")
        )
        return (
            self.read("lineitem")
            .select("l_orderkey", "l_partkey")
            .join(orders, "l_orderkey")
            .select(
                F.col("o_custkey").alias("user_id"),
                F.concat(F.lit("s"), F.col("l_partkey").cast("string")).alias("recording_msid"),
                "month",
            )
        )

    @cached_property
    def mapping(self) -> DataFrame:
        level = F.col("p_size") % 5
        return self.read("part").select(
            F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("recording_msid"),
            F.when(level != 0, F.concat(F.lit("m"), F.col("p_partkey").cast("string"))).alias("recording_mbid"),
            F.when(level == 0, "no_match")
            .when(level == 1, "exact_match")
            .when(level == 2, "high_quality")
            .when(level == 3, "med_quality")
            .otherwise("low_quality")
            .alias("match_type"),
        )

    @cached_property
    def redirects(self) -> DataFrame:
        part = self.read("part").select("p_partkey", "p_name", "p_brand")
        first = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("k"))
        return (
            part.join(first, ["p_name", "p_brand"])
            .filter(F.col("p_partkey") != F.col("k"))
            .select(
                F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("recording_mbid"),
                F.concat(F.lit("m"), F.col("k").cast("string")).alias("canonical_recording_mbid"),
            )
        )

    @cached_property
    def redirect_chains(self) -> DataFrame:
        """Redirects of many hops: each id points at half its number; 0 and 1 form a cycle."""
        k = F.col("p_partkey")
        target = F.when(k == 0, F.lit(1)).otherwise(F.floor(k / 2)).cast("long")
        return (
            self.read("part")
            .select("p_partkey")
            .filter((k % 7 != 3))
            .select(
                F.concat(F.lit("m"), k.cast("string")).alias("recording_mbid"),
                F.concat(F.lit("m"), target.cast("string")).alias("canonical_recording_mbid"),
            )
        )

    @cached_property
    def canonical(self) -> DataFrame:
        return (
            self.read("part")
            .filter(F.col("p_partkey") % 11 != 0)
            .select(
                F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("recording_mbid"),
                F.when(F.col("p_partkey") % 7 == 0, F.lit(""))
                .otherwise(F.concat("p_brand", F.lit(";"), "p_type"))
                .alias("artist_mbids"),
            )
        )

    @cached_property
    def artists(self) -> DataFrame:
        return self.read("part").select(F.col("p_brand").alias("artist_mbid"), F.upper("p_brand").alias("name")).distinct()

    @cached_property
    def artist_metadata(self) -> DataFrame:
        """Country, genres and start date per artist: brands and types of the parts."""
        part = self.read("part")
        brands = part.groupBy(F.col("p_brand").alias("artist_mbid")).agg(
            F.min("p_size").alias("k"), F.min("p_name").alias("words")
        )
        types = part.groupBy(F.col("p_type").alias("artist_mbid")).agg(
            F.max("p_size").alias("k"), F.max("p_name").alias("words")
        )
        nations = self.read("nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("n_name"))
        both = brands.unionByName(types).withColumn("nk", (F.length("artist_mbid") * 3 + F.col("k")) % 10)
        return both.join(nations, "nk", "left").select(
            "artist_mbid",
            F.upper("artist_mbid").alias("name"),
            F.when(F.col("nk") == 0, F.lit("Unknown")).when(F.col("nk") != 1, F.col("n_name")).alias("country"),
            F.split("words", " ").alias("genres"),
            F.when(F.length("artist_mbid") % 2 == 0, F.concat((F.lit(1950) + F.col("k")).cast("string"), F.lit("-06-21")))
            .when(F.col("k") % 3 == 0, F.lit("Unknown"))
            .otherwise((F.lit(1950) + F.col("k")).cast("string"))
            .alias("start_date"),
            F.slice(F.split("words", " "), 1, 2).alias("tags"),
            F.when(F.col("k") % 4 == 0, (F.lit(1990) + F.col("k")).cast("string")).alias("end_date"),
            F.when(F.col("k") % 2 == 0, F.lit("Group")).when(F.col("k") % 5 != 0, F.lit("Person")).alias("type"),
        )

    @cached_property
    def counts(self) -> DataFrame:
        return user_artist_counts(self.listens, self.mapping, self.redirects, self.canonical)

    @cached_property
    def landed_counts(self) -> DataFrame:
        """The counts as a stage table, as the jobs that read them several times find them."""
        return staged(self.counts, "counts")

    @cached_property
    def ranked_parts(self) -> DataFrame:
        """Per part: the customers' two top-10 lists need count and spend."""
        orders = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
        return (
            self.read("lineitem")
            .select("l_orderkey", "l_partkey", "l_extendedprice")
            .join(orders, "l_orderkey")
            .groupBy("user_id", F.col("l_partkey").alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("price"))
        )


VIEWS_SQL = """
listens AS (
  SELECT o_custkey AS user_id, concat('s', l_partkey) AS recording_msid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
msid_mapping AS (
  SELECT concat('s', p_partkey) AS recording_msid,
    CASE WHEN p_size % 5 = 0 THEN NULL ELSE concat('m', p_partkey) END AS recording_mbid,
    CASE p_size % 5 WHEN 0 THEN 'no_match' WHEN 1 THEN 'exact_match' WHEN 2 THEN 'high_quality'
                    WHEN 3 THEN 'med_quality' ELSE 'low_quality' END AS match_type
  FROM part),
redirects AS (
  SELECT concat('m', p_partkey) AS recording_mbid, concat('m', k) AS canonical_recording_mbid
  FROM (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS k FROM part) t
  WHERE p_partkey <> k),
canonical AS (
  SELECT concat('m', p_partkey) AS recording_mbid,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat(p_brand, ';', p_type) END AS artist_mbids
  FROM part WHERE p_partkey % 11 <> 0),
artists AS (SELECT DISTINCT p_brand AS artist_mbid, upper(p_brand) AS name FROM part),
accepted AS (SELECT * FROM msid_mapping WHERE match_type IN ('exact_match', 'high_quality')),
mapped AS (
  SELECT l.user_id, l.recording_msid, m.recording_mbid
  FROM listens l JOIN accepted m ON l.recording_msid = m.recording_msid
  WHERE m.recording_mbid IS NOT NULL),
canonical_listens AS (
  SELECT l.user_id, l.recording_msid, l.recording_mbid,
         coalesce(r.canonical_recording_mbid, l.recording_mbid) AS canonical_mbid
  FROM mapped l LEFT JOIN redirects r ON l.recording_mbid = r.recording_mbid),
recording_artists AS (
  SELECT c.user_id, c.canonical_mbid,
    CASE WHEN m.artist_mbids IS NULL OR m.artist_mbids = '' THEN [c.canonical_mbid]
         ELSE string_split(m.artist_mbids, ';') END AS artist_ids
  FROM canonical_listens c LEFT JOIN canonical m ON c.canonical_mbid = m.recording_mbid),
counts AS (
  SELECT user_id, artist_id, count(*) AS listen_count
  FROM (SELECT user_id, unnest(artist_ids) AS artist_id FROM recording_artists WHERE len(artist_ids) > 0) t
  WHERE artist_id IS NOT NULL
  GROUP BY user_id, artist_id),
artist_totals AS (
  SELECT artist_id, CAST(sum(listen_count) AS BIGINT) AS total_listens, count(DISTINCT user_id) AS unique_listeners
  FROM counts GROUP BY artist_id),
user_totals AS (
  SELECT user_id, CAST(sum(listen_count) AS BIGINT) AS total_listens, count(DISTINCT artist_id) AS unique_artists
  FROM counts GROUP BY user_id),
distribution AS (
  SELECT unique_listeners AS listener_count, count(*) AS artist_count FROM artist_totals GROUP BY unique_listeners),
artist_metadata AS (
  SELECT artist_mbid, upper(artist_mbid) AS name,
    CASE WHEN nk = 0 THEN 'Unknown' WHEN nk <> 1 THEN n_name END AS country,
    string_split(words, ' ') AS genres,
    CASE WHEN length(artist_mbid) % 2 = 0 THEN concat(1950 + k, '-06-21')
         WHEN k % 3 = 0 THEN 'Unknown' ELSE concat(1950 + k, '') END AS start_date,
    string_split(words, ' ')[1:2] AS tags, CASE WHEN k % 4 = 0 THEN concat(1990 + k, '') END AS end_date,
    CASE WHEN k % 2 = 0 THEN 'Group' WHEN k % 5 <> 0 THEN 'Person' END AS type
  FROM (SELECT *, (length(artist_mbid) * 3 + k) % 10 AS nk FROM (
          SELECT p_brand AS artist_mbid, min(p_size) AS k, min(p_name) AS words FROM part GROUP BY p_brand
          UNION ALL
          SELECT p_type, max(p_size), max(p_name) FROM part GROUP BY p_type) b) t
  LEFT JOIN nation ON n_nationkey = nk),
redirect_chains AS (
  SELECT concat('m', p_partkey) AS recording_mbid,
         concat('m', CASE WHEN p_partkey = 0 THEN 1 ELSE p_partkey // 2 END) AS canonical_recording_mbid
  FROM part WHERE p_partkey % 7 <> 3),
ranked_parts AS (
  SELECT o_custkey AS user_id, l_partkey AS part, count(*) AS n, max(l_extendedprice) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
"""


def over_views(body: str, recursive: bool = False) -> str:
    """SQL text of ``body`` with the views in scope. ``body`` may start with further views."""
    word = "WITH RECURSIVE" if recursive else "WITH"
    body = body.strip()
    sep = ",\n" if body.startswith("--with") else "\n"
    return f"{word} {VIEWS_SQL.strip()}{sep}{body.removeprefix('--with').strip()}"
