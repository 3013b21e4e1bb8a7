"""The artist similarity graph: edges, degrees, labels, redirect chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .resolve import add_artist_names


def edge_list(recommendations: DataFrame, n: int = 5) -> DataFrame:
    """(src, dst, weight): each seed's n best recommendations apart from itself."""
    return recommendations.filter((F.col("rank") > 1) & (F.col("rank") <= n + 1)).select(
        F.col("source_artist_id").alias("src"),
        F.col("artist_id").alias("dst"),
        F.col("similarity_score").cast("double").alias("weight"),
    )


def undirected(edges: DataFrame) -> DataFrame:
    """One edge per pair, the highest weight kept."""
    return (
        edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.max("weight").alias("weight"))
    )


def both_ends(edges: DataFrame) -> DataFrame:
    """Each edge once from either side; one scan of the edges."""
    ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))
    return edges.select(F.explode(ends).alias("e"), "weight").select("e.node", "e.other", "weight")


def degrees(edges: DataFrame) -> DataFrame:
    """Degree, node size and degree colour of every node."""
    deg = both_ends(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return deg.select(
        "node",
        "degree",
        (F.col("degree") * 20 + 50).alias("node_size"),
        F.least(F.col("degree") / 5, F.lit(1.0)).alias("colour"),
    )


def labelled_nodes(deg: DataFrame, artists: DataFrame, above: int = 2) -> DataFrame:
    """Nodes of degree above 2 with their names; the id where there is none."""
    nodes = deg.filter(F.col("degree") > above).select(F.col("node").alias("artist_id"), "degree")
    named = add_artist_names(nodes, artists, default="")
    unknown = F.concat(F.lit("Unknown ("), F.col("artist_id"), F.lit(")"))
    return named.select(
        F.col("artist_id").alias("node"), "degree", F.when(F.col("name") == "", unknown).otherwise(F.col("name")).alias("name")
    )


def redirect_walks(redirects: DataFrame, max_hops: int | None = 10) -> DataFrame:
    """Follow every redirect to its end, all at once.

    ``path`` holds the ids in order, start first. ``status`` is ``terminal``,
    ``circular`` (the last id occurred before) or ``cut`` (more than
    ``max_hops`` links; with None every path is followed to its end). A source
    listed twice follows its highest target.

    Paths are doubled: after k self-joins a path spans 2**k links, so 10 links
    need four joins. A path that has ended finds no partner and stays as it is;
    one in a cycle stops once an id repeats and is clipped there. Every round is
    written, so the plan stays short and a target of many sources can be split.
    """
    step = redirects.groupBy("recording_mbid").agg(F.max("canonical_recording_mbid").alias("next"))
    first = step.filter(F.col("next").isNotNull()).select(F.col("recording_mbid").alias("start"), F.array("recording_mbid", "next").alias("path"))
    paths = staged(first.withColumn("grew", F.lit(True)), "walks")
    span = 1
    while (max_hops is None or span <= max_hops) and not paths.filter("grew").isEmpty():
        tails = paths.select(F.col("start").alias("end"), F.slice(F.col("path"), 2, span).alias("tail"))
        walked = paths.withColumn("end", F.element_at("path", -1))
        joined = walked.join(tails, "end", "left")
        open_ = F.col("tail").isNotNull() & (F.size(F.array_distinct("path")) == F.size("path"))
        grown = F.when(open_, F.concat("path", "tail")).otherwise(F.col("path"))
        paths = staged(joined.select("start", grown.alias("path"), open_.alias("grew")), "walks")
        span *= 2
    seen = F.size(F.array_distinct("path"))
    most = F.size("path") if max_hops is None else F.lit(max_hops + 1)
    circular = (seen < F.size("path")) & (seen <= most)
    # A cycle shows its repeated id once, right after the distinct ones.
    clipped = F.when(circular, F.slice("path", 1, seen + 1)).otherwise(F.slice("path", F.lit(1), most + 1))
    return paths.select(
        F.col("start").alias("recording_mbid"),
        clipped.alias("path"),
        F.when(circular, "circular").when(F.size("path") > most, "cut").otherwise("terminal").alias("status"),
    )


def resolve_redirect_chains(redirects: DataFrame, max_hops: int | None = 10) -> DataFrame:
    """Per redirected id: links followed, last id, status and the printed chain."""
    walks = redirect_walks(redirects, max_hops)
    last = F.element_at("path", -1)
    shown = F.array_join("path", " -> ")
    repeat = F.concat(F.array_join(F.slice("path", 1, F.size("path") - 1), " -> "), F.lit(" -> "), last, F.lit(" (circular reference) -> "), last)
    cut = F.concat(F.array_join(F.slice("path", 1, F.size("path") - 1), " -> "), F.lit(" -> ... -> "), last)
    return walks.select(
        "recording_mbid",
        (F.size("path") - 1).alias("hops"),
        last.alias("final_mbid"),
        "status",
        F.when(F.col("status") == "circular", repeat).when(F.col("status") == "cut", cut).otherwise(shown).alias("chain"),
    )
