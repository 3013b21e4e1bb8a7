"""Connected components of a distributed edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonearm.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b); the label is the component's smallest node.

    Each round links every node's larger neighbours to its smallest one (large star), then its smaller ones
    (small star). Minima combine before the shuffle, and the edges meet them as a written table, so a hub's
    rows can be split. State is written each round; the driver sees two numbers per round.
    """
    now = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "minima")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = staged(large, "large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = staged(small.where("a != b").distinct(), "small")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
