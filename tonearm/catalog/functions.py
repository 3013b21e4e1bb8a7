"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..plans.adapters import Tables
from .base import query, r6
from .joins import TWO_LISTS_SQL, two_lists


@query("fn01_coalesce", "SELECT recording_msid, coalesce(recording_mbid, recording_msid) AS id FROM msid_mapping")
def fn01(t: Tables) -> DataFrame:
    return t.mapping.select("recording_msid", F.coalesce("recording_mbid", "recording_msid").alias("id"))


@query("fn02_case_blank", "SELECT recording_mbid, CASE WHEN artist_mbids IS NULL OR artist_mbids = '' THEN recording_mbid ELSE artist_mbids END AS artist FROM canonical")
def fn02(t: Tables) -> DataFrame:
    blank = F.col("artist_mbids").isNull() | (F.col("artist_mbids") == "")
    return t.canonical.select("recording_mbid", F.when(blank, F.col("recording_mbid")).otherwise(F.col("artist_mbids")).alias("artist"))


@query("fn03_split_list", "SELECT recording_mbid, string_split(artist_mbids, ';')[1] AS first_item, string_split(artist_mbids, ';')[2] AS second_item FROM canonical")
def fn03(t: Tables) -> DataFrame:
    items = fn.split_items(F.col("artist_mbids"))
    return t.canonical.select("recording_mbid", F.try_element_at(items, F.lit(1)).alias("first_item"), F.try_element_at(items, F.lit(2)).alias("second_item"))


@query("fn04_single_list", "SELECT p_partkey, CAST(len([p_name]) AS INTEGER) AS n, [p_name][1] AS item FROM part", views=False)
def fn04(t: Tables) -> DataFrame:
    one = F.array("p_name")
    return t.read("part").select("p_partkey", F.size(one).alias("n"), F.element_at(one, 1).alias("item"))


@query("fn05_list_size", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS words FROM documents", views=False)
def fn05(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", F.size(F.split("text", " ")).alias("words"))


@query("fn06_unnest", "SELECT recording_mbid, unnest(string_split(artist_mbids, ';')) AS artist_id FROM canonical")
def fn06(t: Tables) -> DataFrame:
    return t.canonical.select("recording_mbid", F.explode(fn.split_items(F.col("artist_mbids"))).alias("artist_id"))


@query("fn07_item_count", "SELECT recording_mbid, CAST(CASE WHEN artist_mbids IS NULL OR trim(artist_mbids) = '' THEN 0 ELSE len(string_split(artist_mbids, ';')) END AS INTEGER) AS n FROM canonical")
def fn07(t: Tables) -> DataFrame:
    return t.canonical.select("recording_mbid", fn.item_count(F.col("artist_mbids")).alias("n"))


@query("fn08_lookup_or_self", "SELECT m.recording_msid, coalesce(r.canonical_recording_mbid, m.recording_mbid) AS id FROM msid_mapping m LEFT JOIN redirects r ON r.recording_mbid = m.recording_mbid")
def fn08(t: Tables) -> DataFrame:
    from ..operators.resolve import apply_redirects

    return apply_redirects(t.mapping, t.redirects, to="id").select("recording_msid", "id")


@query("fn09_clipped_names", "SELECT c_custkey, substring(c_name, 1, 10) AS label FROM customer", views=False)
def fn09(t: Tables) -> DataFrame:
    return t.read("customer").select("c_custkey", fn.clip_name(F.col("c_name"), 10).alias("label"))


@query(
    "fn10_slug",
    """
    SELECT 'd' AS kind, doc_id AS id, regexp_replace(replace(replace(text, ' ', '_'), '&', 'and'), '[^\\p{L}\\p{N}_]', '', 'g') AS slug FROM documents
    UNION ALL
    SELECT 'p', p_partkey, regexp_replace(replace(replace(concat(p_name, '''s & ', p_brand), ' ', '_'), '&', 'and'), '[^\\p{L}\\p{N}_]', '', 'g') FROM part
    """,
    views=False,
)
def fn10(t: Tables) -> DataFrame:
    docs = t.read("documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), fn.slug(F.col("text")).alias("slug"))
    parts = t.read("part").select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id"), fn.slug(F.concat("p_name", F.lit("'s & "), "p_brand")).alias("slug"))
    return docs.unionByName(parts)


@query("fn11_name_of_file", "SELECT p_partkey, p_name AS name FROM part", views=False)
def fn11(t: Tables) -> DataFrame:
    """The slugged name in a file name, turned back."""
    file_name = F.concat(F.lit("similar_to_"), fn.slug(F.col("p_name")), F.lit(".csv"))
    return t.read("part").select("p_partkey", fn.seed_name(file_name).alias("name"))


@query("fn12_short_id", "SELECT c_custkey, concat(substring(c_name, 1, 8), '...') AS label FROM customer", views=False)
def fn12(t: Tables) -> DataFrame:
    return t.read("customer").select("c_custkey", fn.short_id(F.col("c_name")).alias("label"))


@query(
    "fn13_decade_of_date",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade, concat(year(o_orderdate) // 10 * 10, 's') AS label FROM orders",
    views=False,
)
def fn13(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.read("orders").select("o_orderkey", fn.start_year(text).alias("year"), fn.decade(text).alias("decade"), fn.decade_label(fn.decade(text)).alias("label"))


@query("fn14_percent", "SELECT o_orderkey, round(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_totalprice / (o_custkey % 3) * 100 END, 4) AS pct FROM orders", views=False)
def fn14(t: Tables) -> DataFrame:
    return t.read("orders").select("o_orderkey", F.round(fn.percent(F.col("o_totalprice"), F.col("o_custkey") % 3), 4).alias("pct"))


@query("fn15_bucket_label", "SELECT p_partkey, CASE WHEN p_size > 40 THEN concat(p_size, '+') ELSE concat(p_size, '-', p_size + 2) END AS label FROM part", views=False)
def fn15(t: Tables) -> DataFrame:
    high = F.when(F.col("p_size") <= 40, F.col("p_size") + 2)
    return t.read("part").select("p_partkey", fn.bucket_label(F.col("p_size"), high).alias("label"))


@query("fn16_count_label", "SELECT p_brand, concat(p_brand, ' (', count(*), ')') AS label FROM part GROUP BY p_brand", views=False)
def fn16(t: Tables) -> DataFrame:
    return t.read("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).select("p_brand", fn.count_label(F.col("p_brand"), F.col("n")).alias("label"))


@query("fn17_to_double", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE) AS price FROM lineitem", views=False)
def fn17(t: Tables) -> DataFrame:
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("price"))


@query("fn18_parsed_counts", "SELECT o_orderkey, CAST(o_orderkey * 1013 AS BIGINT) AS n FROM orders", views=False)
def fn18(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" "), F.format_number(F.col("o_orderkey") * 1013, 0), F.lit(" "))
    return t.read("orders").select("o_orderkey", fn.parse_count(text).alias("n"))


@query(
    "fn19_common_names",
    TWO_LISTS_SQL
    + "SELECT concat(user_id, '') AS artist_name, CASE WHEN shared > 0 THEN array_to_string(list_filter(a, lambda x: list_contains(b, x))[1:5], ', ') ELSE 'None' END AS common_names FROM compared",
)
def fn19(t: Tables) -> DataFrame:
    from ..operators.compare import compare_lists

    return compare_lists(*two_lists(t)).select("artist_name", "common_names")


@query("fn20_nested_json_field", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events", views=False)
def fn20(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("fn14_fill_share", "SELECT user_id, round(unique_artists::DOUBLE / (SELECT count(*) FROM artist_totals) * 100, 6) AS pct FROM user_totals")
def fn14_share(t: Tables) -> DataFrame:
    from ..operators.stats import artist_totals, user_totals

    n = artist_totals(t.counts).agg(F.count(F.lit(1))).scalar()
    return user_totals(t.counts).select("user_id", r6(fn.percent(F.col("unique_artists"), n), "pct"))
