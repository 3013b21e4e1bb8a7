"""Connected components of an undirected graph, by hooking and shortcutting (FastSV, Zhang et al. 2020)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of (node, other), given in both directions; the label is the component's lowest node.

    Every round a node looks up its parent's parent and the lowest one among its neighbours, and both it and
    its parent take the lower one over. Distances halve, so rounds grow with the logarithm of the longest path.
    Minima combine before each shuffle; a hub's rows meet a written table and can be split. The driver sees one
    number a round.
    """
    links = staged(edges.select("node", "other").filter("node <> other").distinct(), "links")
    alone = edges.select("node").unionByName(edges.select(F.col("other").alias("node"))).distinct()
    state = staged(alone.select("node", F.col("node").alias("parent")), "parents")
    while True:
        above = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = staged(state.join(above, "parent").select("node", "parent", "grand"), "grandparents")
        beside = links.join(known.select(F.col("node").alias("other"), F.col("grand").alias("near")), "other").groupBy("node").agg(F.min("near").alias("near"))
        lower = known.join(beside, "node", "left").select("node", "parent", F.least("parent", "grand", F.coalesce("near", "parent")).alias("low"))
        own = F.struct("node", F.col("low").alias("parent"), F.col("parent").alias("was"))
        above = F.struct(F.col("parent").alias("node"), F.col("low").alias("parent"), F.lit(None).cast(lower.schema["parent"].dataType).alias("was"))
        taken = lower.select(F.explode(F.array(own, above)).alias("t")).select("t.*")
        after = staged(taken.groupBy("node").agg(F.min("parent").alias("parent"), F.max("was").alias("was")), "parents")
        moved = not after.filter("parent <> was").isEmpty()
        state = after.drop("was")
        if not moved:
            return state.select("node", F.col("parent").alias("label"))
