"""Communities of a weighted undirected graph by modularity (Blondel et al. 2008).

Nodes move to the neighbouring community of highest modularity gain, in rounds;
when rounds stop helping, communities are cut into their connected parts, which
become the nodes of a smaller graph, and the rounds start again. So every community is connected. Each round is a handful of joins and grouped sums;
the driver sees one number per round, the modularity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .components import connected_components
from .graph import both_ends

_EPS = 1e-9


def _adjacency(edges: DataFrame) -> DataFrame:
    """(node, other, w), both directions summed; a self-loop counts twice."""
    return both_ends(edges).groupBy("node", "other").agg(F.sum("weight").alias("w"))


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: the modularity of (node, community) on the undirected edges."""
    return _modularity(_adjacency(edges), communities)


def _modularity(adjacency: DataFrame, communities: DataFrame) -> DataFrame:
    own = communities.select("node", F.col("community").alias("c"))
    far = communities.select(F.col("node").alias("other"), F.col("community").alias("oc"))
    labelled = adjacency.join(own, "node").join(far, "other")
    per_community = labelled.groupBy("c").agg(
        F.sum("w").alias("tot"), F.sum(F.when(F.col("c") == F.col("oc"), F.col("w")).otherwise(0.0)).alias("inside")
    )
    two_m = adjacency.agg(F.sum("w")).scalar()
    share = F.try_divide(F.col("inside"), two_m) - F.pow(F.try_divide(F.col("tot"), two_m), F.lit(2.0))
    return per_community.agg(F.sum(share).alias("modularity"))


def _totals(state: DataFrame) -> DataFrame:
    """(community, tot, size), written: what meets a giant community's rows is a small table of its own, so the join can split them."""
    return staged(state.groupBy("community").agg(F.sum("k").alias("tot"), F.count(F.lit(1)).alias("size")), "totals")


def _links(adjacency: DataFrame, state: DataFrame) -> DataFrame:
    """(node, target, links): each node's weight towards every community beside it."""
    beside = state.select(F.col("node").alias("other"), F.col("community").alias("target"))
    met = adjacency.filter(F.col("node") != F.col("other")).join(beside, "other")
    return met.groupBy("node", "target").agg(F.sum("w").alias("links"))


def _options(links: DataFrame, state: DataFrame, total: DataFrame) -> DataFrame:
    """(node, community, k, own_tot, own_size, target, links, tot, size): where each node could go.

    A community's rows are many only on the left of its two joins; there a giant one is split among tasks. A node
    without a link has one row without a target.
    """
    own = total.select("community", F.col("tot").alias("own_tot"), F.col("size").alias("own_size"))
    there = total.select(F.col("community").alias("target"), "tot", "size")
    return links.join(there, "target").join(state.join(own, "community"), "node", "right")


def _move(adjacency: DataFrame, state: DataFrame, total: DataFrame, two_m: float, turn: int) -> DataFrame:
    """One round over (node, community, k), k being the node's summed weight. ``own_links`` of the result is what a node
    had towards its community before the round; see ``_state_modularity``.

    Seven of eight nodes may move, another choice each turn, and a lone node
    joins another lone node only towards the lower name: neighbours that would
    otherwise swap places for ever come to rest.
    """
    options = _options(_links(adjacency, state), state, total)
    here = F.col("target") == F.col("community")
    allowed = ~here & ((F.col("size") > 1) | (F.col("own_size") > 1) | (F.col("target") < F.col("community")))
    gain = F.col("links") - F.col("k") * F.col("tot") / F.lit(two_m)
    best = options.groupBy("node", "community", "k", "own_tot").agg(
        F.coalesce(F.max(F.when(here, F.col("links"))), F.lit(0.0)).alias("own_links"),
        F.min(F.when(allowed, F.struct((-gain).alias("loss"), "target"))).alias("best"),
    )
    stay = F.col("own_links") - F.col("k") * (F.col("own_tot") - F.col("k")) / F.lit(two_m)
    may_move = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(8)) != 0
    moves = may_move & (-F.col("best.loss") - stay > _EPS)
    return best.select("node", F.when(moves, F.col("best.target")).otherwise(F.col("community")).alias("community"), "k", "own_links")


def _state_modularity(after: DataFrame, total: DataFrame, loops: float, two_m: float) -> float:
    """The modularity of a state out of its totals and of what the round after it found: the links met there are not joined again."""
    inside = after.agg(F.sum("own_links")).first()[0]
    return (inside + loops) / two_m - total.agg(F.sum(F.pow(F.col("tot") / F.lit(two_m), F.lit(2.0)))).first()[0]


def connected_parts(adjacency: DataFrame, communities: DataFrame) -> DataFrame:
    """(node, community): every community cut into its connected parts, named after their lowest nodes.

    Moves may take away the node that held a community together. Parts without a link between them gain nothing
    from each other, so the modularity never falls.
    """
    own = communities.select("node", F.col("community").alias("c"))
    far = communities.select(F.col("node").alias("other"), F.col("community").alias("oc"))
    inside = adjacency.select("node", "other").join(own, "node").join(far, "other").filter("c = oc").select("node", "other")
    lone = communities.select("node", F.col("node").alias("other"))
    return connected_components(inside.unionByName(lone)).select("node", F.col("label").alias("community"))


def _contract(adjacency: DataFrame, communities: DataFrame) -> DataFrame:
    own = communities.select("node", F.col("community").alias("c"))
    far = communities.select(F.col("node").alias("other"), F.col("community").alias("oc"))
    return (
        adjacency.join(own, "node")
        .join(far, "other")
        .groupBy(F.col("c").alias("node"), F.col("oc").alias("other"))
        .agg(F.sum("w").alias("w"))
    )


def detect_communities(edges: DataFrame, guard: int = 500) -> DataFrame:
    """(node, community). Communities are named after their lowest node.

    Rounds go on until three in a row do not raise the modularity, as every round
    rests some nodes; levels until one has no round that does. More than ``guard``
    rounds in all are an error, never a half result. State is written to the shared
    folder after every round, which keeps the plan short and survives lost executors.
    A round also measures the state that it starts from, so each level has one round
    that only measures.
    """
    adjacency = staged(_adjacency(edges), "graph")
    two_m = adjacency.agg(F.sum("w").alias("w")).first()["w"]
    membership = adjacency.select("node").distinct().select("node", F.col("node").alias("community"))
    best_q = -1.0
    turn = 0
    while two_m:
        loops = adjacency.filter("node = other").agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
        state = staged(adjacency.groupBy("node").agg(F.sum("w").alias("k")).select("node", F.col("node").alias("community"), "k"), "moves")
        best, idle, moved = None, 0, False
        while True:
            total = _totals(state)
            after = staged(_move(adjacency, state, total, two_m, turn), "moves")
            if moved:
                q = _state_modularity(after, total, loops, two_m)
                idle += 1
                if q > best_q + 1e-12:
                    best, best_q, idle = state, q, 0
                if idle == 3:
                    break
            if turn == guard:
                raise RuntimeError(f"communities still change after {guard} rounds")
            state, moved = after.drop("own_links"), True
            turn += 1
        if best is None:
            break
        best = staged(connected_parts(adjacency, best), "parts")
        best_q = max(best_q, _modularity(adjacency, best).first()["modularity"])
        names = best.select(F.col("node").alias("community"), F.col("community").alias("to"))
        membership = staged(membership.join(names, "community").select("node", F.col("to").alias("community")), "members")
        adjacency = staged(_contract(adjacency, best), "graph")
    lowest = membership.groupBy("community").agg(F.min("node").alias("lowest"))
    return membership.join(lowest, "community").select("node", F.col("lowest").alias("community"))
