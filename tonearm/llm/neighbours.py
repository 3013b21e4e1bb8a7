"""Nearest neighbours by inner product through a hierarchical k-means tree with best-bin-first search.

Vectors get one more component, so that all have one norm; then the largest inner product is the smallest
distance. A tree of k-means splits is fitted on a bounded sample (``SAMPLE`` vectors) and every vector is
assigned to a leaf. A query goes through the tree with a priority queue that always opens the closest branch,
which yields the leaves in order. How many leaves are visited is widened until the recall of a set of
calibration queries, measured against all vectors, reaches the target.

Equal vectors are searched once and keep their smallest ids, one more than the neighbours asked for. Leaves are
cut into chunks of bounded size on both sides, so no task holds a whole leaf, however full.

Vectors that are null, zero or of another length than most, or that hold null or non-finite components, take no
part, nor do rows without an id. Repeated rows count once. Ties go to the smaller id; with fewer candidates than
asked for, all are given. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tonearm.session import staged

from .common import columns_of

SAMPLE, BRANCH, LEAF, CHUNK = 16_384, 8, 64, 4096
CALIBRATION, RECALL, SEED = 96, 0.97, 42


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centres, nearest centre of each vector)."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.bincount(near, minlength=k)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres, nearest(x, centres)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)


class Tree:
    """``nodes`` holds (centres, children) of inner nodes; a child at or below -1 is the leaf -child - 1."""

    def __init__(self, x: np.ndarray, leaf: int, seed: int = SEED):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        root = self._grow(x, leaf, rng)
        if root < 0:
            self.nodes.append((x.mean(0, keepdims=True) if len(x) else np.zeros((1, x.shape[1])), [root]))
            root = 0
        self.root = root

    def _grow(self, x: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(x) > leaf:
            centres, near = k_means(x, min(BRANCH, len(x)), rng)
            parts = [x[near == i] for i in range(len(centres))]
            if max(map(len, parts)) < len(x):
                full = [i for i, p in enumerate(parts) if len(p)]
                children = [self._grow(parts[i], leaf, rng) for i in full]
                self.nodes.append((centres[full], children))
                return len(self.nodes) - 1
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector belongs to: the nearest centre at every level."""
        out = np.zeros(len(x), np.int32)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            centres, children = self.nodes[node]
            near = nearest(x[rows], centres)
            for i, child in enumerate(children):
                own = rows[near == i]
                if child < 0:
                    out[own] = -child - 1
                elif len(own):
                    todo.append((child, own))
        return out

    def best_bins(self, q: np.ndarray, most: int) -> list[int]:
        """The first leaves in the order of a best-first traversal."""
        queue, out = [(0.0, self.root)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-node - 1)
                continue
            centres, children = self.nodes[node]
            for d, child in zip(((centres - q) ** 2).sum(1).tolist(), children):
                heapq.heappush(queue, (d, child))
        return out


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """With the component that brings each vector to one norm."""
    return np.column_stack([x, np.sqrt(np.maximum(norm - (x**2).sum(1), 0))])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec): rows that take part."""
    rows = columns_of(vectors, id_col, vector_col).toDF("vec_id", "vec").dropna()
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0].n if sizes else 0)).select("vec_id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"))


def matrix(column) -> np.ndarray:
    values = list(column)
    return np.array([np.asarray(v, float) for v in values]) if values else np.zeros((0, 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of each row, ties to the smaller id."""
    if scores.shape[1] > 4 * k:
        bar = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        keep = np.flatnonzero((scores >= bar[:, None]).any(0))
        return keep[best(scores[:, keep], ids[keep], k)] if len(keep) < scores.shape[1] else np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
    return np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]


def exactly(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from left to right."""
    return np.cumsum(q * v, axis=-1)[..., -1]


def top_of(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query id, vector id, score) of each query's best vectors."""
    out = []
    for i in range(0, len(queries), 256):
        q = queries[i : i + 256]
        found = best(q @ vectors.T, ids, min(k, len(ids)))
        score = exactly(q[:, None, :], vectors[found])
        out.append((np.repeat(query_ids[i : i + 256], found.shape[1]), ids[found].ravel(), score.ravel()))
    return tuple(np.concatenate(c) for c in zip(*out))


def calibrated(tree: Tree, norm: float, assigned: DataFrame, k: int, recall: float) -> int:
    """Leaf visits that find the share ``recall`` of the true neighbours of the calibration queries among all vectors."""
    sample = assigned.orderBy(F.xxhash64("vid", F.lit(1)), "vid").limit(CALIBRATION).select("vid", "vec").collect()
    if not sample:
        return 1
    queries, query_ids = matrix(r.vec for r in sample), np.array([r.vid for r in sample])
    schema = assigned.sparkSession.createDataFrame([], "q long, vid long, score double, leaf int").schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, leaf = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
                q, v, s = top_of(queries, query_ids, matrix(batch.column(1).to_pylist()), ids, k + 1)
                at = {x: i for i, x in enumerate(ids.tolist())}
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s), pa.array(leaf[[at[x] for x in v.tolist()]].astype(np.int32))], names=schema.names)

    scanned = assigned.select("vid", "vec", "leaf").mapInArrow(scan, schema).where("q != vid")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    truth = scanned.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).collect()
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.best_bins(q, tree.leaves))} for i, q in zip(query_ids, np.column_stack([queries, np.zeros(len(queries))]))}
    visits = sorted(place[r.q][r.leaf] + 1 for r in truth)
    return visits[min(len(visits) - 1, int(np.ceil(recall * len(visits))) - 1)] if visits else 1


def search(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    distinct = staged(rows.groupBy("vec").agg(F.min("vec_id").alias("vid")), "distinct")
    tagged = staged(rows.join(distinct, "vec").select("vec_id", "vid").distinct(), "tagged")
    first = Window.partitionBy("vid").orderBy("vec_id")
    members = staged(tagged.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).groupBy("vid").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "members")

    sample = distinct.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    norm = float(distinct.agg(F.max(square)).first()[0])
    tree = Tree(lifted(matrix(sample["vec"]), norm), LEAF)
    shared = spark.sparkContext.broadcast(tree)
    fields = spark.createDataFrame([], "vid long, vec array<double>, leaf int").schema

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.leaf_of(lifted(matrix(batch.column(1).to_pylist()), norm))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], names=fields.names)

    assigned = staged(distinct.select("vid", "vec").mapInArrow(assign, fields), "assigned")
    visits = calibrated(tree, norm, assigned, k, recall)
    asked = tagged.where(F.col("vec_id") % every == 0).select("vid").distinct()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1).to_pylist())
                leaves = [shared.value.best_bins(q, visits) for q in np.column_stack([x, np.zeros(len(x))])]
                own = pa.array(np.repeat(np.arange(len(x)), [len(b) for b in leaves]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(np.concatenate(leaves).astype(np.int32))], names=fields.names)

    visiting = staged(assigned.join(asked, "vid").select("vid", "vec").mapInArrow(visit, fields), "visiting")
    # chunks of a leaf on either side: each chunk of queries meets each chunk of vectors
    sizes = assigned.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("v"))
    sizes = staged(sizes.join(visiting.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("q")), "leaf"), "sizes")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        met = df.join(F.broadcast(sizes), "leaf")  # a row per leaf of the sample's tree
        part = F.pmod(F.xxhash64("vid"), F.col(own)).cast("int")
        return met.select("leaf", part.alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), "vid", "vec")

    def meet(queries: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(chunk):
            return pd.DataFrame({"q": [], "vid": [], "score": []})
        q, v, s = top_of(matrix(queries["vec"]), queries["vid"].to_numpy(), matrix(chunk["vec"]), chunk["vid"].to_numpy(), k + 1)
        return pd.DataFrame({"q": q, "vid": v, "score": s})

    keys = ["leaf", "q", "v"]
    found = dealt(visiting, "q", "v").groupBy(*keys).cogroup(dealt(assigned, "v", "q").groupBy(*keys)).applyInPandas(meet, "q long, vid long, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    ranked = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).join(members, "vid")
    spread = ranked.select("q", "score", F.explode("ids").alias("vec_id"))
    again = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = spread.withColumn("r", F.row_number().over(again)).where(F.col("r") <= k + 1)
    lists = staged(top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("list")), "lists")
    queries = tagged.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("vid").alias("q"))
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = queries.join(lists, "q").select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
