"""Joins: resolution chain, lookups, coverage, name search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare, diversity, profile, recommend, resolve, search, stats
from ..plans.adapters import Tables
from ..plans.funnel import credited, profiled_mapping
from .base import query, r6, rounded
from .ingest import _CANONICAL_MAPPING, _RECS, user_recommendations


@query("jn01_listens_mapping", "SELECT user_id, recording_msid, recording_mbid FROM mapped")
def jn01(t: Tables) -> DataFrame:
    joined = resolve.map_listens(t.listens, resolve.filter_match_levels(t.mapping))
    return joined.select("user_id", "recording_msid", "recording_mbid")


@query(
    "jn02_listens_mapping_coverage",
    """
    SELECT l.recording_msid, count(*) AS plays, count(m.recording_mbid) AS mapped
    FROM listens l LEFT JOIN accepted m ON l.recording_msid = m.recording_msid GROUP BY l.recording_msid
    """,
)
def jn02(t: Tables) -> DataFrame:
    accepted = resolve.filter_match_levels(t.mapping).select("recording_msid", "recording_mbid")
    plays = t.listens.groupBy("recording_msid").agg(F.count(F.lit(1)).alias("plays"))
    return plays.join(accepted, "recording_msid", "left").select(
        "recording_msid", "plays", F.when(F.col("recording_mbid").isNull(), F.lit(0)).otherwise(F.col("plays")).cast("long").alias("mapped")
    )


@query("jn03_canonical_recordings", "SELECT user_id, recording_mbid, canonical_mbid FROM canonical_listens")
def jn03(t: Tables) -> DataFrame:
    mapped = resolve.map_listens(t.listens, resolve.filter_match_levels(t.mapping))
    return resolve.apply_redirects(mapped, t.redirects).select("user_id", "recording_mbid", "canonical_mbid")


@query("jn04_recording_artists", "SELECT user_id, canonical_mbid, array_to_string(artist_ids, '|') AS artist_ids FROM recording_artists")
def jn04(t: Tables) -> DataFrame:
    mapped = resolve.map_listens(t.listens, resolve.filter_match_levels(t.mapping)).select("user_id", "recording_mbid")
    canonical = resolve.apply_redirects(mapped, t.redirects)
    with_artists = resolve.attach_artists(canonical, t.canonical)
    return with_artists.select("user_id", "canonical_mbid", F.array_join("artist_ids", "|").alias("artist_ids"))


@query(
    "jn05_restricted_mapping",
    "SELECT recording_msid, recording_mbid, match_type FROM accepted WHERE recording_msid IN (SELECT recording_msid FROM listens)",
)
def jn05(t: Tables) -> DataFrame:
    return resolve.restrict_mapping(t.mapping, t.listens).select("recording_msid", "recording_mbid", "match_type")


_INDEX = """--with
ai AS (SELECT artist_id, row_number() OVER (ORDER BY artist_id) - 1 AS item_idx FROM (SELECT DISTINCT artist_id FROM counts) a),
ui AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM counts) u)
"""


@query("jn06_matrix_entries", _INDEX + "SELECT user_idx, item_idx, listen_count FROM counts JOIN ai USING (artist_id) JOIN ui USING (user_id)")
def jn06(t: Tables) -> DataFrame:
    counts = t.landed_counts
    return recommend.matrix_entries(
        counts, recommend.dense_index(counts, "artist_id", "item_idx"), recommend.dense_index(counts, "user_id", "user_idx")
    )


@query(
    "jn07_artist_names",
    "SELECT artist_id, total_listens, coalesce(name, 'Unknown Artist') AS name FROM artist_totals LEFT JOIN artists ON artist_mbid = artist_id",
)
def jn07(t: Tables) -> DataFrame:
    return resolve.add_artist_names(stats.artist_totals(t.counts), t.artists).select("artist_id", "total_listens", "name")


@query(
    "jn08_requested_artists",
    """
    SELECT DISTINCT p_type AS artist_id, p_type IN (SELECT artist_id FROM counts) AS present FROM part
    UNION SELECT DISTINCT p_name, p_name IN (SELECT artist_id FROM counts) FROM part
    """,
)
def jn08(t: Tables) -> DataFrame:
    part = t.read("part")
    wanted = part.select(F.col("p_type").alias("artist_id")).unionByName(part.select(F.col("p_name").alias("artist_id")))
    found, missing = recommend.find_artists(wanted, t.landed_counts)
    return found.withColumn("present", F.lit(True)).unionByName(missing.withColumn("present", F.lit(False)))


@query(
    "jn09_metadata_enrichment",
    """
    SELECT artist_id, total_listens, coalesce(name, 'Unknown Artist') AS name, country,
           coalesce(array_to_string(genres, '|'), '') AS genres, coalesce(start_date, 'Unknown') AS start_date
    FROM artist_totals LEFT JOIN artist_metadata ON artist_mbid = artist_id
    """,
)
def jn09(t: Tables) -> DataFrame:
    enriched = diversity.enrich_artists(stats.artist_totals(t.counts), t.artist_metadata)
    return enriched.select("artist_id", "total_listens", "name", "country", F.array_join("genres", "|").alias("genres"), "start_date")


@query(
    "jn09_all_fields",
    """
    SELECT artist_id, coalesce(array_to_string(tags, '|'), '') AS tags, coalesce(end_date, 'Unknown') AS end_date, coalesce(type, 'Unknown') AS type
    FROM artist_totals LEFT JOIN artist_metadata ON artist_mbid = artist_id
    """,
)
def jn09_all(t: Tables) -> DataFrame:
    enriched = diversity.enrich_artists(stats.artist_totals(t.counts), t.artist_metadata)
    return enriched.select("artist_id", F.array_join("tags", "|").alias("tags"), "end_date", "type")


TWO_LISTS_SQL = """--with
model AS (SELECT user_id, list(part ORDER BY rk) AS a FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, part) AS rk FROM ranked_parts) x WHERE rk <= 10 GROUP BY user_id),
outside AS (SELECT user_id, list(part ORDER BY rk) AS b FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY price DESC, part) AS rk FROM ranked_parts) x WHERE rk <= 10 GROUP BY user_id),
compared AS (
  SELECT user_id, a, b, len(list_intersect(a, b)) AS shared,
         len(list_intersect(a, b))::DOUBLE / least(len(a), len(b)) * 100 AS overlap_percentage
  FROM model JOIN outside USING (user_id))
"""


def two_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each customer's ten most bought and ten dearest parts, as model and outside list."""
    ranked = t.ranked_parts.withColumn("source_artist", F.col("user_id").cast("string"))
    part = ranked.withColumn("part", F.col("part"))
    model = compare.ranked_list(part.withColumn("o", -F.col("n")), "source_artist", "part", "o", 10, "model_recommendations")
    outside = compare.ranked_list(part.withColumn("o", -F.col("price")), "source_artist", "part", "o", 10, "similar")
    text = lambda c: F.transform(c, lambda x: x.cast("string")).alias(c)
    return (
        model.select("source_artist", text("model_recommendations")),
        outside.select(F.col("source_artist").alias("artist_name"), text("similar")),
    )


@query(
    "jn10_model_against_outside",
    TWO_LISTS_SQL + "SELECT concat(user_id, '') AS artist_name, CAST(shared AS INTEGER) AS shared, round(overlap_percentage, 6) AS overlap_percentage FROM compared",
)
def jn10(t: Tables) -> DataFrame:
    both = compare.compare_lists(*two_lists(t))
    return both.select("artist_name", F.size("overlap").alias("shared"), r6("overlap_percentage"))


_COVERAGE = """--with
keys(name, total_keys, found_keys) AS (
  SELECT 'msids in mapping', (SELECT count(DISTINCT recording_msid) FROM listens),
         (SELECT count(DISTINCT recording_msid) FROM listens WHERE recording_msid IN (SELECT recording_msid FROM accepted))
  UNION ALL SELECT 'mbids redirected', (SELECT count(DISTINCT recording_mbid) FROM msid_mapping),
         (SELECT count(DISTINCT recording_mbid) FROM msid_mapping WHERE recording_mbid IN (SELECT recording_mbid FROM redirects))
  UNION ALL SELECT 'mbids in canonical data', (SELECT count(DISTINCT canonical_recording_mbid) FROM redirects),
         (SELECT count(DISTINCT canonical_recording_mbid) FROM redirects WHERE canonical_recording_mbid IN (SELECT recording_mbid FROM canonical))
  UNION ALL SELECT 'artists named', (SELECT count(DISTINCT artist_id) FROM counts),
         (SELECT count(DISTINCT artist_id) FROM counts WHERE artist_id IN (SELECT artist_mbid FROM artists)))
SELECT name, total_keys, found_keys, total_keys - found_keys AS missing_keys,
       round(found_keys::DOUBLE / total_keys * 100, 6) AS found_pct
FROM keys
"""


@query("jn11_key_coverage", _COVERAGE)
def jn11(t: Tables) -> DataFrame:
    from ..operators.sets import union_all

    steps = [
        ("msids in mapping", profile.coverage(t.listens, resolve.filter_match_levels(t.mapping), "recording_msid")),
        ("mbids redirected", profile.coverage(t.mapping, t.redirects, "recording_mbid")),
        ("mbids in canonical data", profile.coverage(t.redirects, t.canonical, "canonical_recording_mbid", "recording_mbid")),
        ("artists named", profile.coverage(t.counts, t.artists, "artist_id", "artist_mbid")),
    ]
    rows = union_all(*[df.withColumn("name", F.lit(name)) for name, df in steps])
    return rounded(rows.select("name", "total_keys", "found_keys", "missing_keys", "found_pct"), "found_pct")


@query(
    "jn12_resolved_only",
    _CANONICAL_MAPPING
    + """
    SELECT user_id, artist_id, count(*) AS listen_count FROM (
      SELECT l.user_id, unnest(string_split(c.artist_mbids, ';')) AS artist_id
      FROM (SELECT DISTINCT user_id, recording_msid FROM listens) l
      JOIN canonical_mapping m ON m.recording_msid = l.recording_msid
      JOIN canonical c ON c.recording_mbid = m.canonical_mbid
      WHERE trim(c.artist_mbids) <> '') t
    GROUP BY user_id, artist_id
    """,
)
def jn12(t: Tables) -> DataFrame:
    """Distinct recordings per user and artist; recordings without artists are dropped."""
    mapping = profiled_mapping(t.listens, t.mapping, t.redirects).select("recording_msid", F.col("canonical_mbid").alias("recording_mbid"))
    artists = mapping.join(credited(t.canonical), "recording_mbid").select("recording_msid", F.explode("artist_ids").alias("artist_id"))
    return (
        resolve.plays_per_recording(t.listens, "distinct_recordings")
        .join(artists, "recording_msid")
        .groupBy("user_id", "artist_id")
        .agg(F.sum("plays").alias("listen_count"))
    )


@query(
    "jn13_similar_names",
    """--with
    v AS (SELECT DISTINCT p_name AS x FROM part)
    SELECT a.x AS value1, b.x AS value2,
           round(1 - levenshtein(a.x, b.x)::DOUBLE / greatest(length(a.x), length(b.x)), 6) AS similarity
    FROM v a JOIN v b ON a.x < b.x
    WHERE 1 - levenshtein(a.x, b.x)::DOUBLE / greatest(length(a.x), length(b.x)) >= 0.7
      AND 1 - levenshtein(a.x, b.x)::DOUBLE / greatest(length(a.x), length(b.x)) < 1
    """,
)
def jn13(t: Tables) -> DataFrame:
    """All distinct part names: pairs of edit similarity 0.7 and above."""
    return rounded(search.similar_pairs(t.read("part"), "p_name", 0.7, None, "levenshtein"), "similarity")


@query("jn13_similar_names_matching")
def jn13_matching(t: Tables) -> DataFrame:
    """By matching blocks, over all distinct titles."""
    titles = t.read("part").select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("title")).distinct()
    return rounded(search.similar_pairs(titles, "title", measure="matching"), "similarity")


@query(
    "jn14_artist_search",
    """--with
    q AS (SELECT DISTINCT p_name AS query FROM part),
    a AS (SELECT concat('m', p_partkey) AS artist_mbid, concat(upper(p_name), ' (', p_brand, ')') AS name FROM part),
    n AS (SELECT *, trim(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS an FROM a),
    m AS (SELECT *, trim(regexp_replace(lower(query), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS qn FROM q),
    s AS (SELECT query, artist_mbid, name,
                 round((1 - levenshtein(qn, an)::DOUBLE / greatest(length(qn), length(an))) * 100, 4) AS score
          FROM m JOIN n ON len(list_intersect(string_split(qn, ' '), string_split(an, ' '))) > 0)
    SELECT query, artist_mbid, name, score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, artist_mbid) AS rank FROM s) r
    WHERE rank <= 10
    """,
)
def jn14(t: Tables) -> DataFrame:
    """Every part name searched among all branded part names."""
    part = t.read("part")
    queries = part.select(F.col("p_name").alias("query"))
    artists = part.select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("artist_mbid"),
        F.concat(F.upper("p_name"), F.lit(" ("), "p_brand", F.lit(")")).alias("name"),
    )
    return search.artists_sharing_word(queries, artists)


_FOLD = "regexp_replace(trim(regexp_replace(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), '^the (.)', '\\1')"


@query(
    "jn14_misspelt_search",
    f"""--with
    q AS (SELECT DISTINCT replace(concat(substr(p_name, 1, 3), substr(p_name, 5)), 'o', 'ö') AS query FROM part),
    a AS (SELECT concat('m', p_partkey) AS artist_mbid, CASE WHEN p_partkey % 3 = 0 THEN concat('The ', upper(p_name)) ELSE p_name END AS name FROM part),
    n AS (SELECT *, {_FOLD.format("name")} AS an FROM a),
    m AS (SELECT *, {_FOLD.format("query")} AS qn FROM q),
    s AS (SELECT query, artist_mbid, name, round((1 - levenshtein(qn, an)::DOUBLE / greatest(length(qn), length(an))) * 100, 4) AS score FROM m, n)
    SELECT query, artist_mbid, name, score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, artist_mbid) AS rank FROM s WHERE score >= 70) r
    WHERE rank <= 10
    """,
)
def jn14_misspelt(t: Tables) -> DataFrame:
    """Every part name with a letter left out and accents put in, searched among all part names, a third with an article."""
    part = t.read("part")
    queries = part.select(F.replace(F.concat(F.substring("p_name", 1, 3), F.substring("p_name", 5, 1 << 20)), F.lit("o"), F.lit("ö")).alias("query"))
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("The "), F.upper("p_name"))).otherwise(F.col("p_name"))
    return search.search_artists(queries, part.select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("artist_mbid"), name.alias("name")))


@query(
    "jn14_name_index",
    f"""--with
    a AS (SELECT concat('m', p_partkey) AS artist_mbid, {_FOLD.format("p_name")} AS folded FROM part),
    g AS (SELECT artist_mbid, folded, substr(concat('##', folded, '$$'), i, 3) AS g FROM (SELECT *, unnest(range(1, length(folded) + 3)) AS i FROM a)),
    k AS (SELECT artist_mbid, folded, g, unnest(range(1, count(*) + 1)) AS no FROM g GROUP BY artist_mbid, folded, g)
    SELECT concat(g, no) AS gram, length(folded) AS size, count(*) AS names, min(artist_mbid) AS first_artist FROM k GROUP BY ALL
    """,
)
def jn14_index(t: Tables) -> DataFrame:
    """Names per key of the inverted index of all part names."""
    artists = t.read("part").select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("artist_mbid"), F.col("p_name").alias("name"))
    keys = search.name_index(artists).groupBy("gram", "size")
    return keys.agg(F.sum("names").alias("names"), F.min("first_artist").alias("first_artist")).withColumn("size", F.col("size").cast("long"))


@query("jn07_recommendation_names", _RECS + "SELECT source_artist_id, rank, artist_name FROM recs WHERE artist_name <> 'Unknown Artist'")
def jn07_recs(t: Tables) -> DataFrame:
    return user_recommendations(t).filter("artist_name <> 'Unknown Artist'").select("source_artist_id", "rank", "artist_name")
