"""Similarity graph: edges, degrees, labels, communities, redirect chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import communities, graph
from ..plans.adapters import Tables
from .base import query, rounded
from .ingest import _RECS, user_recommendations

EDGES_SQL = _RECS.rstrip() + """,
directed AS (SELECT source_artist_id AS src, artist_id AS dst, similarity_score AS weight FROM recs WHERE rank BETWEEN 2 AND 6),
edges AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(weight) AS weight FROM directed GROUP BY ALL),
ends AS (SELECT src AS node, dst AS other, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges),
degree AS (SELECT node, count(*) AS degree FROM ends GROUP BY node)
"""


def _edges(t: Tables) -> DataFrame:
    return graph.undirected(graph.edge_list(user_recommendations(t)))


@query("gr01_edge_list", EDGES_SQL + "SELECT src, dst, round(weight, 6) AS weight FROM directed")
def gr01(t: Tables) -> DataFrame:
    return rounded(graph.edge_list(user_recommendations(t)), "weight")


@query("gr02_undirected_edges", EDGES_SQL + "SELECT src, dst, round(weight, 6) AS weight FROM edges")
def gr02(t: Tables) -> DataFrame:
    return rounded(_edges(t), "weight")


@query("gr03_communities")
def gr03(t: Tables) -> DataFrame:
    return communities.detect_communities(_edges(t))


@query(
    "gr03_communities_cover_nodes",
    EDGES_SQL + "SELECT count(*) AS nodes, count(*) AS known, TRUE AS named_after_lowest, TRUE AS better_than_one FROM degree",
)
def gr03_cover(t: Tables) -> DataFrame:
    """Every node is in one community named after its lowest node, and the modularity is above 0."""
    from ..session import staged
    from ..operators.stats import combine_rows

    edges = staged(_edges(t), "edges")
    found = staged(communities.detect_communities(edges), "communities")
    nodes = graph.degrees(edges).join(found, "node")
    lowest = found.groupBy("community").agg((F.min("node") == F.col("community")).alias("ok"))
    return combine_rows(
        found.agg(F.count_distinct("node").alias("nodes")),
        nodes.agg(F.count(F.lit(1)).alias("known")),
        lowest.agg(F.bool_and("ok").alias("named_after_lowest")),
        communities.modularity(edges, found).select((F.col("modularity") > 0.01).alias("better_than_one")),
    )


@query(
    "gr03_star_communities",
    """
    SELECT s_name AS node, min(s_name) OVER (PARTITION BY s_nationkey) AS community FROM supplier
    WHERE s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY s_nationkey HAVING count(*) > 1)
    """,
    views=False,
)
def gr03_stars(t: Tables) -> DataFrame:
    """Suppliers linked to the first one of their nation: every nation is a community."""
    suppliers = t.read("supplier").select("s_nationkey", "s_name")
    first = suppliers.groupBy("s_nationkey").agg(F.min("s_name").alias("src"))
    edges = suppliers.join(first, "s_nationkey").filter("s_name <> src").select("src", F.col("s_name").alias("dst"), F.lit(1.0).alias("weight"))
    return communities.detect_communities(edges)


@query(
    "gr03_modularity",
    EDGES_SQL.rstrip()
    + """,
    named AS (SELECT node, substring(node, 1, 2) AS c FROM degree),
    labelled AS (SELECT a.c AS c, b.c AS oc, e.weight AS w FROM ends e JOIN named a ON a.node = e.node JOIN named b ON b.node = e.other),
    per AS (SELECT c, sum(w) AS tot, coalesce(sum(w) FILTER (c = oc), 0) AS inside FROM labelled GROUP BY c)
    SELECT round(sum(inside / m - (tot / m) * (tot / m)), 6) AS modularity FROM per, (SELECT sum(w) AS m FROM labelled) s
    """,
)
def gr03_modularity(t: Tables) -> DataFrame:
    """Modularity of the grouping by the first two letters of a node's name."""
    edges = _edges(t)
    named = graph.degrees(edges).select("node", F.substring("node", 1, 2).alias("community"))
    return rounded(communities.modularity(edges, named), "modularity")


@query("gr04_degrees", EDGES_SQL + "SELECT node, degree, degree * 20 + 50 AS node_size, least(degree / 5.0::DOUBLE, 1.0) AS colour FROM degree")
def gr04(t: Tables) -> DataFrame:
    return graph.degrees(_edges(t))


@query(
    "gr05_labelled_nodes",
    EDGES_SQL + "SELECT node, degree, coalesce(name, concat('Unknown (', node, ')')) AS name FROM degree LEFT JOIN artists ON artist_mbid = node WHERE degree > 2",
)
def gr05(t: Tables) -> DataFrame:
    return graph.labelled_nodes(graph.degrees(_edges(t)), t.artists)


@query(
    "gr06_redirect_chains",
    """--with
    walk(start, path, current, open, status) AS (
      SELECT recording_mbid, [recording_mbid, canonical_recording_mbid], canonical_recording_mbid,
             recording_mbid <> canonical_recording_mbid, CASE WHEN recording_mbid = canonical_recording_mbid THEN 'circular' END
      FROM redirect_chains
      UNION ALL
      SELECT w.start, list_append(w.path, r.canonical_recording_mbid), r.canonical_recording_mbid,
             NOT list_contains(w.path, r.canonical_recording_mbid) AND len(w.path) < 11,
             CASE WHEN list_contains(w.path, r.canonical_recording_mbid) THEN 'circular' WHEN len(w.path) >= 11 THEN 'cut' END
      FROM walk w JOIN redirect_chains r ON r.recording_mbid = w.current WHERE w.open),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY len(path) DESC) AS rn FROM walk) t WHERE rn = 1)
    SELECT start AS recording_mbid, CAST(len(path) - 1 AS INTEGER) AS hops, current AS final_mbid, coalesce(status, 'terminal') AS status,
      CASE WHEN status = 'circular' THEN concat(array_to_string(path[1:len(path) - 1], ' -> '), ' -> ', current, ' (circular reference) -> ', current)
           WHEN status = 'cut' THEN concat(array_to_string(path[1:len(path) - 1], ' -> '), ' -> ... -> ', current)
           ELSE array_to_string(path, ' -> ') END AS chain
    FROM last
    """,
    recursive=True,
)
def gr06(t: Tables) -> DataFrame:
    return graph.resolve_redirect_chains(t.redirect_chains)
