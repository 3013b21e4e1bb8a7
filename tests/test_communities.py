"""Communities: connected, as good as a plain version, and a giant one does not land in one task."""

import random
from collections import defaultdict

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from tonearm.operators import communities
from tonearm.operators.components import connected_components


def parts_of(nodes, links):
    """Sets of nodes that hang together."""
    label = {n: n for n in nodes}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        label[high] = low
    return {n: find(n) for n in nodes}


def plain_modularity(edges, group):
    m = sum(w for _, _, w in edges)
    inside, total = defaultdict(float), defaultdict(float)
    for a, b, w in edges:
        total[group[a]] += w
        total[group[b]] += w
        inside[group[a]] += w if group[a] == group[b] else 0.0
    return sum(inside[c] / m - (total[c] / (2 * m)) ** 2 for c in total)


def plain_communities(edges):
    """Nodes move one at a time to the best neighbouring community, then communities become nodes."""
    member = {n: n for a, b, _ in edges for n in (a, b)}
    graph = defaultdict(float)
    for a, b, w in edges:
        graph[a, b] += w
        graph[b, a] += w
    two_m = sum(graph.values())
    while True:
        near, k = defaultdict(dict), defaultdict(float)
        for (a, b), w in graph.items():
            near[a][b] = w
            k[a] += w
        group, total, moved = {n: n for n in near}, dict(k), False
        again = True
        while again:
            again = False
            for n in sorted(near):
                links = defaultdict(float)
                for other, w in near[n].items():
                    if other != n:
                        links[group[other]] += w
                total[group[n]] -= k[n]
                best = max(sorted(links), key=lambda c: links[c] - k[n] * total[c] / two_m, default=group[n])
                if links[best] - k[n] * total[best] / two_m > links[group[n]] - k[n] * total[group[n]] / two_m + 1e-9:
                    group[n], again, moved = best, True, True
                total[group[n]] += k[n]
        if not moved:
            return member
        member = {n: group[c] for n, c in member.items()}
        smaller = defaultdict(float)
        for (a, b), w in graph.items():
            smaller[group[a], group[b]] += w
        graph = smaller


def planted(seed, groups, size, inside, across):
    rnd = random.Random(seed)
    nodes = [f"n{i:03}" for i in range(groups * size)]
    return [(a, b, 1.0) for i, a in enumerate(nodes) for j, b in enumerate(nodes[i + 1 :], i + 1) if rnd.random() < (inside if i // size == j // size else across)]


@pytest.mark.parametrize("case", range(2))
def test_communities_are_connected_and_as_good_as_a_plain_version(spark, case):
    edges = [planted(1, 4, 10, 0.6, 0.05), [(f"p{i}", f"p{i + 1}", 1.0 + i % 3) for i in range(30)] + [("p0", "p9", 0.5), ("x", "y", 2.0)]][case]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    found = dict(rows(communities.detect_communities(df)))
    inside = [(a, b) for a, b, _ in edges if found[a] == found[b]]
    assert parts_of(found, inside) == found, "every community is connected and named after its lowest node"
    assert plain_modularity(edges, found) >= 0.95 * plain_modularity(edges, plain_communities(edges))


def test_a_community_in_two_pieces_is_cut(spark):
    edges = [("a", "b", 1.0), ("b", "a", 1.0), ("c", "d", 1.0), ("d", "c", 1.0), ("e", "e", 2.0), ("b", "e", 1.0), ("e", "b", 1.0)]
    adjacency = spark.createDataFrame(edges, "node string, other string, w double")
    whole = spark.createDataFrame([(n, "x") for n in "abcd"] + [("e", "y")], "node string, community string")
    assert rows(communities.connected_parts(adjacency, whole)) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("e", "e")]


@pytest.mark.parametrize("seed, n, links", [(1, 200, 120), (2, 300, 300), (3, 60, 0)])
def test_components_against_union_find(spark, seed, n, links):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(links)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000)]
    df = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "node long, other long")
    want = parts_of({x for p in pairs for x in p}, pairs)
    assert rows(connected_components(df)) == sorted(want.items(), key=repr)


def test_a_giant_community_is_split_among_tasks(spark):
    """100,000 nodes of one community: the joins on the community show the split."""
    nodes = spark.range(110_000).select(F.concat(F.lit("n"), F.col("id")).alias("node"), F.when(F.col("id") < 100_000, "giant").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("community"), F.lit(2.0).alias("k"))
    ring = spark.range(110_000).select(F.concat(F.lit("n"), F.col("id")).alias("node"), F.concat(F.lit("n"), (F.col("id") + 1) % 110_000).alias("other"), F.lit(1.0).alias("w"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # as many map tasks as a real graph has: a partition is split by them
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        options = communities._options(communities._links(ring, nodes), nodes, communities._totals(nodes))
        assert len(options.collect()) == 110_000
        plan = options._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") >= 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_round_tells_the_modularity_of_the_state_before_it(spark):
    """Also with self-loops, which a contracted graph has, and a node that has nothing else."""
    adjacency = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 2.0), ("c", "b", 2.0), ("c", "c", 3.0), ("d", "d", 5.0)], "node string, other string, w double")
    state = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("c", "y", 5.0), ("d", "z", 5.0)], "node string, community string, k double")
    total = communities._totals(state)
    after = communities._move(adjacency, state, total, 14.0, 0)
    assert rows(after.select("node", "own_links")) == [("a", 1.0), ("b", 1.0), ("c", 0.0), ("d", 0.0)]
    want = communities._modularity(adjacency, state).first()[0]
    assert communities._state_modularity(after, total, 8.0, 14.0) == pytest.approx(want, abs=1e-12)
