"""Sources, sinks, projections and filters.

Files are written by Spark from the given tables into the shared scratch folder
and read back through the package's readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile, recommend, resolve, stats
from ..operators.distribution import listener_buckets, listener_distribution
from ..operators.sets import head_per_group
from ..plans.adapters import Tables
from ..plans.funnel import profiled_mapping, stage_funnel
from ..schemas import ARTISTS, COUNTS, MATCH_LEVELS, MSID_MAPPING
from ..session import scratch_path
from ..sources import listens as listen_files
from ..sources import results, sinks, tables
from .base import query, r6, rounded


def raw_documents(listens: DataFrame) -> DataFrame:
    """Listen documents with the message id at one of its three places."""
    place = F.length("recording_msid") % 3
    msid = F.col("recording_msid")
    return listens.select(
        *[c for c in listens.columns if c != "recording_msid"],
        F.when(place == 0, msid).alias("recording_msid"),
        F.struct(
            F.when(place == 1, msid).alias("recording_msid"),
            F.struct(F.when(place == 2, msid).alias("recording_msid")).alias("additional_info"),
        ).alias("track_metadata"),
    )


@query("src01_json_listens", "SELECT user_id, recording_msid FROM listens")
def src01(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "listens")
    raw_documents(t.listens).write.json(path)
    return listen_files.extract_listens(listen_files.read_raw_listens(t.spark, path))


@query(
    "src03_csv_scan",
    "SELECT p_partkey AS id, concat(p_name, ', \"', p_brand, '\"') AS name FROM part",
    views=False,
)
def src03(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "names")
    named = t.read("part").select(F.col("p_partkey").cast("string").alias("artist_mbid"), F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("name"))
    named.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_csv(t.spark, path, ARTISTS).select(F.col("artist_mbid").cast("long").alias("id"), "name")


@query(
    "src03_quoted_line_breaks",
    "SELECT concat(p_partkey, '') AS artist_mbid, concat(p_name, chr(10), '\"', p_brand, '\",', chr(10), chr(10), p_type) AS name FROM part",
    views=False,
)
def src03_line_breaks(t: Tables) -> DataFrame:
    """Names with line breaks, quotes and commas inside quotes, written and read back whole."""
    path = scratch_path(t.spark, "line-breaks")
    name = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('",\n\n'), "p_type")
    t.read("part").select(F.col("p_partkey").cast("string").alias("artist_mbid"), name.alias("name")).write.option("header", True).option("escape", '"').csv(path)
    return tables.read_csv(t.spark, path, ARTISTS, multi_line=True).select("artist_mbid", "name")


@query(
    "src03_cast_failures",
    """
    SELECT 'user_id' AS column_name, count(*) AS rows, count(*) FILTER (o_custkey % 5 = 0) AS empty, count(*) FILTER (o_custkey % 5 <> 0 AND o_custkey % 7 = 0) AS failed FROM orders
    UNION ALL SELECT 'artist_id', count(*), 0, 0 FROM orders
    UNION ALL SELECT 'listen_count', count(*), 0, count(*) FILTER (o_orderkey % 3 = 0) FROM orders
    """,
    views=False,
)
def src03_failures(t: Tables) -> DataFrame:
    """Counts as CSV with missing and unreadable numbers: how many of each a reader turns into nulls."""
    path = scratch_path(t.spark, "bad-counts")
    k = F.col("o_custkey")
    user = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit("n/a")).otherwise(k.cast("string"))
    count = F.when(F.col("o_orderkey") % 3 == 0, F.lit("12 plays")).otherwise(F.lit("12"))
    t.read("orders").select(user.alias("user_id"), F.lit("a").alias("artist_id"), count.alias("listen_count")).write.option("header", True).csv(path)
    return tables.cast_failures(t.spark, path, COUNTS)


@query(
    "src04_csv_to_parquet",
    "SELECT recording_msid, match_type FROM msid_mapping",
)
def src04(t: Tables) -> DataFrame:
    source, target = scratch_path(t.spark, "mapping-csv"), scratch_path(t.spark, "mapping")
    t.mapping.write.option("header", True).csv(source)
    return tables.csv_to_parquet(t.spark, source, target, MSID_MAPPING, ["recording_msid", "match_type"])


@query("src05_parquet_scan", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 25", views=False)
def src05(t: Tables) -> DataFrame:
    return tables.read_table(t.spark, f"{t.sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_size").filter("p_size > 25")


def _landed(t: Tables, name: str) -> str:
    path = scratch_path(t.spark, name)
    listen_files.land_listens(t.monthly_listens, path)
    return path


_MONTHLY = """--with
monthly AS (
  SELECT o_custkey AS user_id, concat('s', l_partkey) AS recording_msid, CAST(month(o_orderdate) AS INTEGER) AS month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query("src06_monthly_listens", _MONTHLY + "SELECT month, user_id, count(*) AS plays FROM monthly GROUP BY month, user_id")
def src06(t: Tables) -> DataFrame:
    """Monthly JSON-lines files, read in one scan with the month out of the file's folder."""
    path = scratch_path(t.spark, "months")
    raw_documents(t.monthly_listens).write.partitionBy("month").json(path)
    raw = listen_files.read_raw_listens(t.spark, path)
    month = F.regexp_extract(F.col("_metadata.file_path"), r"month=(\d+)", 1).cast("int")
    return raw.select("user_id", month.alias("month")).groupBy("month", "user_id").agg(F.count(F.lit(1)).alias("plays"))


@query(
    "src07_month_selection",
    _MONTHLY + "SELECT month, recording_msid, count(*) AS plays FROM monthly WHERE month BETWEEN 2 AND 4 GROUP BY ALL",
)
def src07(t: Tables) -> DataFrame:
    months = listen_files.parse_months("2-4")
    landed = listen_files.read_landed_listens(t.spark, _landed(t, "landed"), months)
    return landed.groupBy("month", "recording_msid").agg(F.count(F.lit(1)).alias("plays"))


@query(
    "src08_format_by_suffix",
    "SELECT artist_mbid, name, count(*) AS n FROM (SELECT * FROM artists UNION ALL SELECT * FROM artists) t GROUP BY ALL",
)
def src08(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "artists")
    t.artists.write.option("header", True).csv(f"{base}.csv")
    t.artists.write.parquet(f"{base}.parquet")
    both = tables.read_table(t.spark, f"{base}.csv", ARTISTS).unionByName(tables.read_table(t.spark, f"{base}.parquet"))
    return both.groupBy("artist_mbid", "name").agg(F.count(F.lit(1)).alias("n"))


@query("src09_row_limited_scan", "SELECT least(1000, count(*)) AS n FROM listens")
def src09(t: Tables) -> DataFrame:
    return tables.head_rows(t.listens, 1000).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src10_landed_before_raw",
    "SELECT artist_mbid, name, 'raw' AS origin FROM artists UNION ALL SELECT artist_mbid, lower(name), 'landed' FROM artists",
)
def src10(t: Tables) -> DataFrame:
    """Read the raw CSV while nothing is landed, the landed table from then on."""
    root = scratch_path(t.spark, "stages")
    raw_path = f"{root}/artist.csv"
    t.artists.write.option("header", True).csv(raw_path)
    first = tables.read_stage(t.spark, "artists", f"{root}/landed", raw_path).withColumn("origin", F.lit("raw"))
    t.artists.withColumn("name", F.lower("name")).write.parquet(f"{root}/landed/artists.parquet")
    second = tables.read_stage(t.spark, "artists", f"{root}/landed", raw_path).withColumn("origin", F.lit("landed"))
    return first.unionByName(second)


_RECS = """--with
recs AS (
  SELECT concat('u', user_id) AS source_artist_id, concat('Customer ', user_id) AS source_artist, rank, artist_id,
         coalesce(a.name, 'Unknown Artist') AS artist_name,
         listen_count / (listen_count + 1.0::DOUBLE) AS similarity_score
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY listen_count DESC, artist_id) AS INTEGER) AS rank
        FROM counts) c
  LEFT JOIN artists a ON a.artist_mbid = c.artist_id WHERE rank <= 20)
"""


SIMILAR_SQL = """
WITH seeds AS (SELECT min(vec_id) AS seed_id FROM embeddings GROUP BY label),
scored AS (
  SELECT concat(s.vec_id, '') AS seed_id, concat(i.vec_id, '') AS item_id,
         list_cosine_similarity(s.embedding::DOUBLE[], i.embedding::DOUBLE[]) AS score
  FROM (SELECT * FROM embeddings WHERE vec_id IN (SELECT seed_id FROM seeds)) s, embeddings i),
similar_vectors AS (
  SELECT seed_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, item_id) AS rank FROM scored) t
  WHERE rank <= 20)
"""


def label_vectors(t: Tables) -> tuple[DataFrame, DataFrame]:
    """First vector of every label as seeds, all vectors as items."""
    vectors = t.read("embeddings").select("vec_id", "label", F.col("embedding").alias("features"))
    first = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    seeds = vectors.join(first, "vec_id", "left_semi").select(F.col("vec_id").cast("string").alias("seed_id"), "features")
    return seeds, vectors.select(F.col("vec_id").cast("string").alias("item_id"), "features")


def vector_recommendations(t: Tables) -> DataFrame:
    """A recommendation table out of the vectors: 20 nearest ones of each label's first."""
    similar = recommend.similar_items(*label_vectors(t))
    return similar.select(
        F.col("seed_id").alias("source_artist_id"),
        F.concat(F.lit("Vector "), "seed_id").alias("source_artist"),
        "rank",
        F.col("item_id").alias("artist_id"),
        F.concat(F.lit("Vector "), "item_id").alias("artist_name"),
        F.col("score").alias("similarity_score"),
    )


@query(
    "src11_recommendation_files",
    SIMILAR_SQL
    + """
    SELECT concat('Vector ', seed_id) AS source_artist, rank, item_id AS artist_id, concat('Vector ', item_id) AS artist_name,
           round(score, 6) AS similarity_score FROM similar_vectors
    """,
    views=False,
)
def src11(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "recommendations")
    sinks.write_recommendations(vector_recommendations(t), path)
    read = results.read_recommendations(t.spark, path)
    return read.select("source_artist", "rank", "artist_id", "artist_name", r6("similarity_score"))


def user_recommendations(t: Tables, n: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """A recommendation table out of the counts: each user's most played artists, ranked."""
    ranked = head_per_group(t.counts if counts is None else counts, "user_id", n, F.col("listen_count").desc(), F.col("artist_id").asc())
    named = resolve.add_artist_names(ranked, t.artists, "artist_id", "artist_name")
    return named.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_artist_id"),
        F.concat(F.lit("Customer "), F.col("user_id").cast("string")).alias("source_artist"),
        F.col("rank"),
        "artist_id",
        "artist_name",
        (F.col("listen_count") / (F.col("listen_count") + F.lit(1.0))).alias("similarity_score"),
    )


@query(
    "src12_mapping_log",
    """
    SELECT CAST(1001 * count(m.recording_mbid) AS BIGINT) AS mapped_count,
           CAST(1001 * (count(*) - count(m.recording_mbid)) AS BIGINT) AS unmapped_count
    FROM listens l LEFT JOIN accepted m ON l.recording_msid = m.recording_msid GROUP BY user_id
    """,
)
def src12(t: Tables) -> DataFrame:
    """Log lines, one per user, parsed back into numbers."""
    path = scratch_path(t.spark, "log")
    accepted = resolve.filter_match_levels(t.mapping).select("recording_msid", "recording_mbid")
    per_user = t.listens.join(accepted, "recording_msid", "left").groupBy("user_id").agg(
        (F.count("recording_mbid") * 1001).alias("m"), ((F.count(F.lit(1)) - F.count("recording_mbid")) * 1001).alias("u")
    )
    line = F.format_string(
        "INFO MSID to MBID mapping: %s mapped (%.1f%%), %s unmapped",
        F.format_number("m", 0),
        F.col("m") / (F.col("m") + F.col("u")) * 100,
        F.format_number("u", 0),
    )
    other = per_user.select(F.format_string("INFO processed user %d", "user_id").alias("value"))
    per_user.select(line.alias("value")).unionByName(other).write.text(path)
    return results.read_mapping_counts(t.spark, path)


_BUCKETS = """--with
b(i, label, low, high) AS (VALUES (1,'1-1',1,1),(2,'2-2',2,2),(3,'3-5',3,5),(4,'6-10',6,10),(5,'11-20',11,20),
                                  (6,'21-50',21,50),(7,'51-100',51,100),(8,'101+',101,NULL))
SELECT label, CAST(low AS BIGINT) AS low,
  CAST(coalesce(high, (SELECT max(listener_count) FROM distribution)) AS BIGINT) AS high,
  CAST(coalesce(sum(artist_count), 0) AS BIGINT) AS count,
  round(100.0::DOUBLE * coalesce(sum(artist_count), 0) / (SELECT sum(artist_count) FROM distribution), 6) AS percentage
FROM b LEFT JOIN distribution ON listener_count >= low AND listener_count <= coalesce(high, 9000000000)
GROUP BY label, low, high
"""


@query("src13_report_dataset", _BUCKETS)
def src13(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "buckets")
    df = listener_buckets(listener_distribution(t.counts))
    sinks.write_json(df, path, one_file=True)
    return rounded(results.read_dataset(t.spark, path, df.schema), "percentage")


# -- sinks -------------------------------------------------------------------


@query("snk01_parquet_by_month", _MONTHLY + "SELECT month, user_id, recording_msid FROM monthly")
def snk01(t: Tables) -> DataFrame:
    return listen_files.read_landed_listens(t.spark, _landed(t, "by-month")).select("month", "user_id", "recording_msid")


@query("snk02_sorted_csv", "SELECT user_id, artist_id, listen_count FROM counts")
def snk02(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "counts-csv")
    sinks.write_counts_csv(t.counts, path)
    return tables.read_csv(t.spark, path, COUNTS)


@query(
    "snk03_folder_per_seed",
    SIMILAR_SQL + "SELECT concat('Vector ', seed_id) AS source_artist, count(*) AS n, max(rank) AS last_rank FROM similar_vectors GROUP BY ALL",
    views=False,
)
def snk03(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "per-seed")
    sinks.write_recommendations(vector_recommendations(t), path)
    read = results.read_recommendations(t.spark, path)
    return read.groupBy("source_artist").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last_rank"))


@query(
    "snk04_json_dataset",
    "SELECT artist_id, total_listens, unique_listeners FROM artist_totals",
)
def snk04(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "totals-json")
    df = stats.artist_totals(t.counts)
    sinks.write_json(df, path)
    return results.read_dataset(t.spark, path, df.schema)


@query("snk05_stage_reuse", "SELECT artist_id, total_listens, unique_listeners FROM artist_totals")
def snk05(t: Tables) -> DataFrame:
    """The second call finds the stage complete and does not build (an empty table would show)."""
    path = sinks.stage_path(scratch_path(t.spark, "stage"), "totals", {"levels": list(MATCH_LEVELS[:2])})
    first = sinks.materialise(t.spark, lambda: stats.artist_totals(t.counts), path)
    return sinks.materialise(t.spark, lambda: first.filter("false"), path)


# -- projections -------------------------------------------------------------


@query("prj01_first_message_id", "SELECT user_id, recording_msid FROM listens")
def prj01(t: Tables) -> DataFrame:
    return raw_documents(t.listens).select("user_id", listen_files.message_id().alias("recording_msid"))


@query("prj02_pruned_columns", "SELECT recording_mbid, artist_mbids FROM canonical")
def prj02(t: Tables) -> DataFrame:
    return t.canonical.select("recording_mbid", "artist_mbids")


@query("prj03_rename", "SELECT user_id, count(*) AS listen_count FROM listens GROUP BY user_id")
def prj03(t: Tables) -> DataFrame:
    return t.listens.groupBy("user_id").count().withColumnRenamed("count", "listen_count")


# -- filters -----------------------------------------------------------------


@query("flt01_keys_present", "SELECT recording_msid, recording_mbid FROM msid_mapping WHERE recording_msid IS NOT NULL AND recording_mbid IS NOT NULL")
def flt01(t: Tables) -> DataFrame:
    return resolve.keep_valid(t.mapping, "recording_msid", "recording_mbid").select("recording_msid", "recording_mbid")


@query(
    "flt02_malformed_lines",
    """
    SELECT (SELECT count(*) FROM listens) + count(*) AS lines, count(*) AS malformed,
           CAST(0 AS BIGINT) AS missing_key, (SELECT count(*) FROM listens) AS usable
    FROM customer
    """,
)
def flt02(t: Tables) -> DataFrame:
    """Good documents mixed with one broken line per customer."""
    path = scratch_path(t.spark, "lines")
    good = raw_documents(t.listens).select(F.to_json(F.struct("*")).alias("value"))
    bad = t.read("customer").select(F.concat(F.lit('{"user_id": '), F.col("c_custkey").cast("string"), F.lit(', "recording_msid": "s')).alias("value"))
    good.unionByName(bad).write.text(path)
    return listen_files.line_quality(listen_files.read_raw_listens(t.spark, path))


@query("flt03_match_levels", "SELECT recording_msid, match_type FROM msid_mapping WHERE match_type IN ('exact_match', 'med_quality')")
def flt03(t: Tables) -> DataFrame:
    return resolve.filter_match_levels(t.mapping, ["exact_match", "medium_quality"]).select("recording_msid", "match_type")


@query("flt04_drop_unmatched", "SELECT recording_msid, match_type FROM msid_mapping WHERE match_type <> 'no_match'")
def flt04(t: Tables) -> DataFrame:
    return resolve.drop_unmatched(t.mapping).select("recording_msid", "match_type")


@query("flt05_id_set_membership", "SELECT recording_msid, recording_mbid FROM msid_mapping WHERE recording_mbid IN (SELECT canonical_recording_mbid FROM redirects)")
def flt05(t: Tables) -> DataFrame:
    keys = t.redirects.select("canonical_recording_mbid").distinct()
    return resolve.restrict_to_keys(t.mapping, keys, "recording_mbid", "canonical_recording_mbid").select("recording_msid", "recording_mbid")


@query("flt06_without_self", _RECS + "SELECT source_artist_id, rank, artist_id FROM recs WHERE rank > 1")
def flt06(t: Tables) -> DataFrame:
    return user_recommendations(t).filter("rank > 1").select("source_artist_id", "rank", "artist_id")


@query("flt07_listener_range", "SELECT listener_count, artist_count FROM distribution WHERE listener_count BETWEEN 21 AND 50 OR listener_count >= 101")
def flt07(t: Tables) -> DataFrame:
    return listener_distribution(t.counts).filter(F.col("listener_count").between(21, 50) | (F.col("listener_count") >= 101))


@query("flt08_non_empty_lists", "SELECT recording_mbid, CAST(len(string_split(artist_mbids, ';')) AS INTEGER) AS artists FROM canonical WHERE len(string_split(artist_mbids, ';')) > 0")
def flt08(t: Tables) -> DataFrame:
    lists = t.canonical.select("recording_mbid", F.split("artist_mbids", ";").alias("ids"))
    return lists.filter(F.size("ids") > 0).select("recording_mbid", F.size("ids").alias("artists"))


@query(
    "flt08_lists_of_blanks",
    "SELECT recording_mbid, len(list_filter(string_split(artist_mbids, ';'), lambda x: x <> '')) AS artists FROM canonical WHERE len(list_filter(string_split(artist_mbids, ';'), lambda x: x <> '')) > 0",
)
def flt08_blanks(t: Tables) -> DataFrame:
    """Lists that hold nothing but blanks are empty and go: a seventh of all."""
    lists = t.canonical.select("recording_mbid", F.filter(F.split("artist_mbids", ";"), lambda x: x != "").alias("ids"))
    return lists.filter(F.size("ids") > 0).select("recording_mbid", F.size("ids").cast("long").alias("artists"))


@query("flt09_self_redirects", "SELECT concat('m', p_partkey) AS recording_mbid FROM part WHERE p_partkey = p_partkey - p_partkey % 3", views=False)
def flt09(t: Tables) -> DataFrame:
    """Redirects to the next lower multiple of three; the multiples point at themselves."""
    k = F.col("p_partkey")
    hops = t.read("part").select(
        F.concat(F.lit("m"), k.cast("string")).alias("recording_mbid"),
        F.concat(F.lit("m"), (k - k % 3).cast("string")).alias("canonical_recording_mbid"),
    )
    return hops.filter(F.col("recording_mbid") == F.col("canonical_recording_mbid")).select("recording_mbid")


_CANONICAL_MAPPING = """--with
canonical_mapping AS (
  SELECT m.recording_msid, m.recording_mbid, coalesce(r.canonical_recording_mbid, m.recording_mbid) AS canonical_mbid
  FROM (SELECT * FROM msid_mapping WHERE match_type <> 'no_match'
        AND recording_msid IN (SELECT recording_msid FROM listens)) m
  LEFT JOIN redirects r ON r.recording_mbid = m.recording_mbid)
"""


@query("flt10_redirected_rows", _CANONICAL_MAPPING + "SELECT recording_msid, recording_mbid, canonical_mbid FROM canonical_mapping WHERE recording_mbid <> canonical_mbid")
def flt10(t: Tables) -> DataFrame:
    df = profiled_mapping(t.listens, t.mapping, t.redirects)
    return df.filter(F.col("recording_mbid") != F.col("canonical_mbid")).select("recording_msid", "recording_mbid", "canonical_mbid")


FUNNEL_SQL = _CANONICAL_MAPPING.rstrip().rstrip(")") + """),
clean AS (SELECT DISTINCT user_id, recording_msid FROM listens),
found AS (SELECT * FROM canonical WHERE recording_mbid IN (SELECT canonical_mbid FROM canonical_mapping)),
credits AS (SELECT recording_mbid, string_split(artist_mbids, ';') AS ids FROM found WHERE trim(artist_mbids) <> ''),
all_artists AS (SELECT DISTINCT unnest(ids) AS artist_mbid FROM credits),
stages(step_no, step, original_count, processed_count) AS (
  SELECT 1, 'Clean Listen Events', (SELECT count(*) FROM listens), (SELECT count(*) FROM clean)
  UNION ALL SELECT 2, 'MSID to MBID Mapping', (SELECT count(DISTINCT recording_msid) FROM clean), (SELECT count(DISTINCT recording_msid) FROM canonical_mapping)
  UNION ALL SELECT 3, 'Canonical Redirection', (SELECT count(DISTINCT recording_mbid) FROM canonical_mapping), (SELECT count(DISTINCT canonical_mbid) FROM canonical_mapping)
  UNION ALL SELECT 4, 'Finding Artists for Recordings', (SELECT count(DISTINCT canonical_mbid) FROM canonical_mapping), (SELECT count(DISTINCT recording_mbid) FROM found)
  UNION ALL SELECT 5, 'Finding Artist Names', (SELECT count(*) FROM all_artists), (SELECT count(*) FROM all_artists WHERE artist_mbid IN (SELECT artist_mbid FROM artists))
  UNION ALL SELECT 6, 'Generating User-Artist Counts', (SELECT count(*) FROM clean),
    (SELECT CAST(coalesce(sum(len(ids)), 0) AS BIGINT) FROM clean JOIN canonical_mapping USING (recording_msid) JOIN credits ON credits.recording_mbid = canonical_mbid)),
flow AS (
  SELECT *, CASE WHEN original_count = 0 THEN 0.0::DOUBLE ELSE processed_count::DOUBLE / original_count * 100 END AS retention_pct,
         original_count - processed_count AS loss_count
  FROM stages)
"""


def funnel(t: Tables) -> DataFrame:
    return stage_funnel(t.listens, t.mapping, t.redirects, t.canonical, t.artists)


@query("flt11_main_losses", FUNNEL_SQL + "SELECT step, loss_count, round(100 - retention_pct, 6) AS loss_pct FROM flow WHERE 100 - retention_pct > 10")
def flt11(t: Tables) -> DataFrame:
    return profile.main_losses(funnel(t)).select("step", "loss_count", r6("loss_pct"))
