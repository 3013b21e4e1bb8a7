"""SimHash near-duplicates: fingerprints of word shingles, linked exactly through sharded vantage-point trees.

A vantage-point tree over a bounded sample splits the fingerprints into shards by their Hamming distance to the
vantage points. A fingerprint lives in one shard, and also visits each shard that the triangle inequality cannot
rule out for its radius. In a shard, a local tree prunes by the same bounds. Shards give back a forest of links
instead of pairs, and components are joined across shards. So copies never expand into all pairs.

``without_near_copies`` keeps one row of each component.

Nulls and empty texts have fingerprint zero. Rows without an id link like others, but name no component, which
is null where no member has an id. Repeated rows give repeated rows. An empty table gives an empty one.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tonearm.session import staged

from .common import bit_table, likely_split, map_texts, texts_of
from .components import components

SEED = 42
SAMPLE = 4096
SHARD = 1 << 15
LEAF = 256


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, repeats included; of all words where there are fewer."""
    words = text.encode().lower().split()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> bytes:
    """64 bits, each set if over half of the hashes have it; big-endian."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def fingerprint(text: str, size: int = 3) -> bytes:
    """64 bits of the shingles, repeats included."""
    return majority(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as bytes."""
    return map_texts(texts_of(docs, id_col, text_col), "doc_id long, fp binary", lambda: lambda texts: [[fingerprint(t, size) for t in texts]])


def to_words(fps) -> np.ndarray:
    """Fingerprints as a matrix of 64-bit words."""
    fps = list(fps)
    return np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).reshape(len(fps), -1)


def distances(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).sum(-1, dtype=np.int32)


def plant(points: np.ndarray, depth: int, rng: random.Random, leaf: int = 0) -> tuple | None:
    """Tree of (vantage, median, inside, outside); None is a leaf. Ends at ``depth``, or below ``leaf`` points."""
    if not depth or len(points) <= max(leaf, 1):
        return None
    tries = [points[rng.randrange(len(points))] for _ in range(3)]
    vantage = max(tries, key=lambda p: float(distances(points, p).std()))
    d = distances(points, vantage)
    median = int(np.sort(d)[(len(d) - 1) // 2])
    if d.max() <= median:
        median -= 1
    if d.min() > median:
        return None
    return vantage, median, plant(points[d <= median], depth - 1, rng, leaf), plant(points[d > median], depth - 1, rng, leaf)


def leaves(tree: tuple | None, points: np.ndarray, rows: np.ndarray, radius: int, at: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, rows that may have a neighbour within the radius there)."""
    if not len(rows):
        return
    if tree is None:
        yield at, rows
        return
    vantage, median, inside, outside = tree
    d = distances(points[rows], vantage)
    yield from leaves(inside, points, rows[d - radius <= median], radius, 2 * at)
    yield from leaves(outside, points, rows[d + radius > median], radius, 2 * at + 1)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes."""
    label = np.arange(n)
    while True:
        new = label.copy()
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links_within(points: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Component label per point from links between home points and any points, through a local tree."""
    n = len(points)
    tree = plant(points[home], 64, random.Random(SEED), LEAF)
    at_home = dict(leaves(tree, points, home, 0))
    kept_a, kept_b, held = [np.arange(0)], [np.arange(0)], 0
    for leaf, rows in leaves(tree, points, np.arange(n), radius):
        own = at_home.get(leaf, ())
        for i in range(0, len(rows), 2048):
            for j in range(0, len(own), LEAF):
                q, h = rows[i : i + 2048], own[j : j + LEAF]
                x, y = np.nonzero(distances(points[q][:, None, :], points[h][None, :, :]) <= radius)
                kept_a.append(q[x])
                kept_b.append(h[y])
                held += len(x)
                if held > 1 << 20:  # keep a forest in place of all links
                    label = local_components(n, np.concatenate(kept_a), np.concatenate(kept_b))
                    kept_a, kept_b, held = [np.arange(n)], [label], n
                    if n > 1 << 20:
                        held = 0
    return local_components(n, np.concatenate(kept_a), np.concatenate(kept_b))


def shard_edges(fps: DataFrame, radius: int, shard_rows: int = SHARD) -> DataFrame:
    """(a, b): a forest per shard that connects all distinct fingerprints of (fp) within the radius."""
    spark = fps.sparkSession
    depth = max(0, math.ceil(math.log2(max(1, fps.count()) / shard_rows)))
    sample = to_words(r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()) if depth else None
    tree = plant(sample, depth, random.Random(SEED)) if depth else None
    schema = spark.createDataFrame([], "shard int, fp binary, home boolean").schema

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            points = to_words(column.to_pylist())
            rows = np.arange(len(points))
            home = np.zeros(len(points), np.int32)
            for leaf, own in leaves(tree, points, rows, 0):
                home[own] = leaf
            for leaf, own in leaves(tree, points, rows, radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), leaf, np.int32)), column.take(pa.array(own)), pa.array(home[own] == leaf)], names=["shard", "fp", "home"])

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        label = links_within(to_words(shard["fp"]), np.flatnonzero(shard["home"].to_numpy()), radius)
        linked = np.flatnonzero(label != np.arange(len(label)))
        values = shard["fp"].to_numpy()
        return pd.DataFrame({"a": values[linked], "b": values[label[linked]]})

    return fps.mapInArrow(deal, schema).groupBy("shard").applyInPandas(link, "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked by 64-bit fingerprints within the radius, exactly."""
    named = near_duplicate_groups(docs, size, radius, id_col, text_col)
    return named.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def near_duplicate_groups(docs: DataFrame, size: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, component_id, label): with the component's smallest fingerprint, which rows without ids have as well."""
    rows = staged(fingerprints(docs, size, id_col, text_col), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(staged(shard_edges(distinct.select("fp"), radius), "links"))
    labelled = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    labelled = staged(labelled, "labelled")
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = staged(labelled.join(staged(named, "named"), "label").select("fp", "component_id", "label"), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "label")


def without_near_copies(docs: DataFrame, size: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per component, the one with the smallest id (null ids after all others), with all its columns.

    Of a component's rows that share that id, or that all lack one, the one with the smallest text stays, then by the
    other columns in turn. Rows of one id that lie in different components are told apart. Columns are found by exact
    spelling. Rows whose id surely has neither a dropped row nor several rows pass on as they are, without a shuffle.
    """
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own = F.col(f"c{names.index(id_col)}")
    grouped = near_duplicate_groups(docs, size, radius, id_col, text_col)
    kept = grouped.where(F.col("component_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = staged(kept.select(F.col("doc_id").alias("id"), "fp", "label").distinct(), "kept")
    several = plain.groupBy(own.alias("several")).agg(F.count("*").alias("rows")).where("rows > 1 or several is null")
    odd = staged(kept.select("id").distinct().join(several, F.col("id").eqNullSafe(F.col("several")), "left_semi"), "odd")
    dropped = grouped.where(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    table = bit_table(dropped.select(F.col("doc_id").alias("id")).unionByName(odd), "id")
    some, rest = likely_split(plain.withColumn("id", own.cast("long")), staged(table, "doubtful"), "id")
    keys = kept.where("id is not null").select("id").distinct().join(odd, "id", "left_anti")
    out = rest.drop("id").unionByName(some.join(keys, "id", "left_semi").select(*plain.columns))
    if not odd.isEmpty():
        few = plain.join(odd, own.eqNullSafe(F.col("id")), "left_semi")
        out = out.unionByName(one_per_component(few, kept, size, names.index(id_col), names.index(text_col)))
    return out.toDF(*names)


def one_per_component(few: DataFrame, kept: DataFrame, size: int, id_at: int, text_at: int) -> DataFrame:
    """Of rows whose id is shared or missing, the kept ones: one per component, the smallest text first."""
    schema = few.select("*", F.lit(b"").cast("binary").alias("own_fp")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t or "", size) for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.binary())], names=[f.name for f in schema])

    met = few.mapInArrow(add, schema).join(kept, F.col(f"c{id_at}").eqNullSafe(F.col("id")) & (F.col("own_fp") == F.col("fp")))
    order = [few.columns[text_at], *(c for i, c in enumerate(few.columns) if i != text_at)]
    return met.groupBy("label").agg(F.min(F.struct(*order)).alias("row")).select(*(F.col("row")[c].alias(c) for c in few.columns))
