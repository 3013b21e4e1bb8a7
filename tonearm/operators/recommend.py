"""Weighted user-artist matrix, factor model and similar artists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DEFAULT_SEEDS
from ..session import staged
from . import few_items
from .indexing import dense_index
from .resolve import add_artist_names
from .sets import head_per_group
from .stats import artist_totals, top_rows

# Model and weighting defaults.
FACTORS, REGULARISATION, ALPHA, ITERATIONS = 64, 0.05, 2.0, 15
BM25_K1, BM25_B = 100.0, 0.8
SIMILAR_ITEMS = 20
POPULAR_SEEDS = 10

# Item blocks of a fit at least: each one more sends all users' factors once more.
ITEM_BLOCKS = 2

# Seeds up to this number travel to the tasks as one matrix (1024 x 64 doubles
# are 0.5 MB); more seeds are multiplied block by block over a shuffle, with at
# most about 1024 x 20,000 scores (160 MB) in a task at a time.
SEEDS_PER_BLOCK = 1024
ITEMS_PER_BLOCK = 20_000


# -- matrix ----------------------------------------------------------------


def matrix_entries(counts: DataFrame, artist_index: DataFrame, user_index: DataFrame) -> DataFrame:
    """(user_idx, item_idx, listen_count): the counts with dense ids in place of ids.

    ``artist_index`` is (artist_id, item_idx), ``user_index`` (user_id, user_idx).
    Which side is broadcast follows from the measured sizes.
    """
    return (
        counts.join(artist_index, "artist_id").join(user_index, "user_id").select("user_idx", "item_idx", "listen_count")
    )


def build_matrix(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, artist index, user index) of a counts table."""
    artists = dense_index(counts, "artist_id", "item_idx")
    users = dense_index(counts, "user_id", "user_idx")
    return matrix_entries(counts, artists, users), artists, users


def bm25_weights(counts: DataFrame, k1: float = BM25_K1, b: float = BM25_B, user: str = "user_id", item: str = "artist_id", value: str = "listen_count") -> DataFrame:
    """(user, item, weight): BM25 with users as rows and items as terms.

    weight = c (K1 + 1) / (K1 (1 - B + B len / avg_len) + c) * (ln N - ln(1 + df)),
    with len the user's total, N the users and df the item's users. An item that
    (nearly) every user plays gets a weight of 0 or below, as the formula says.

    The totals are written first: the joins then shuffle both of their sides, and
    AQE can split the rows of an item that a third of all users play.
    """
    lengths = staged(counts.groupBy(user).agg(F.sum(value).cast("double").alias("_len")), "lengths")
    frequency = staged(counts.groupBy(item).agg(F.count(F.lit(1)).alias("_df")), "frequency")
    n_users = lengths.agg(F.count(F.lit(1)).cast("double")).scalar()
    avg_len = lengths.agg(F.avg("_len")).scalar()
    c = F.col(value).cast("double")
    norm = F.lit(1.0 - b) + F.lit(b) * F.col("_len") / avg_len
    idf = F.log(n_users) - F.log1p(F.col("_df").cast("double"))
    weight = c * (k1 + 1.0) / (F.lit(k1) * norm + c) * idf
    return counts.join(lengths, user).join(frequency, item).select(user, item, weight.alias("weight"))


# -- model -----------------------------------------------------------------


def item_blocks(users: int, items: int, width: int, least: int = ITEM_BLOCKS) -> int:
    """Item blocks of a fit with ``width`` user blocks: fewer, the more users there are per item.

    Each round sends a user's factors once to each item block with one of the user's items, so few items
    for many users would send all users ``width`` times. With this number a round sends about
    ``least * users + width * items`` vectors at most that way, and ``width * items`` back. Where items are as
    many as users, whose systems take the time, there are ``width`` blocks.
    """
    return min(width, max(least, -(-width * items // max(users, 1))))


def train_model(
    weighted: DataFrame,
    factors: int = FACTORS,
    regularisation: float = REGULARISATION,
    alpha: float = ALPHA,
    iterations: int = ITERATIONS,
    seed: int = 42,
    blocks: int | None = None,
    least_item_blocks: int = ITEM_BLOCKS,
) -> ALSModel:
    """Implicit-feedback ALS over (user_idx, item_idx, weight).

    A user or item without a positive weight has the zero vector as its
    solution and adds nothing to others, so it stays out of the fit; its system
    would have no regularisation. Lineage is cut every few iterations in the
    shared folder. ``blocks`` is the number of user blocks, and of item blocks
    at most; set it to the cores of the cluster. ``item_blocks`` says how many
    item blocks there are: a user's factors go to every one with an item of the user.
    Where the systems of all items fit a task, ``few_items`` makes the same fit without sending users' factors.
    """
    ratings = staged(weighted.select(F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("weight").cast("double")), "ratings")
    width = blocks or ratings.sparkSession.sparkContext.defaultParallelism
    liked = F.col("weight") > 0
    odd = F.col("weight").isNull() | F.isnan("weight") | F.isnan(F.col("weight").cast("float") * 0.0)
    users, items, odd_weights, n_ratings = ratings.agg(
        F.approx_count_distinct(F.when(liked, F.col("user_idx"))), F.approx_count_distinct(F.when(liked, F.col("item_idx"))), F.count_if(odd), F.count(F.lit(1))
    ).first()
    als = ALS(
        rank=factors,
        regParam=regularisation,
        alpha=alpha,
        maxIter=iterations,
        implicitPrefs=True,
        nonnegative=False,
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="weight",
        coldStartStrategy="drop",
        checkpointInterval=5,
        numUserBlocks=width,
        numItemBlocks=item_blocks(users, items, width, least_item_blocks),
        seed=seed,
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    if iterations and not odd_weights and few_items.fits(items, factors):
        return few_items.fit(als, ratings, n_ratings)
    positive = ratings.filter(liked)
    ratings = ratings.join(positive.select("user_idx").distinct(), "user_idx", "left_semi").join(positive.select("item_idx").distinct(), "item_idx", "left_semi")
    return als.fit(ratings.select("user_idx", "item_idx", F.col("weight").cast("float")))


def training_loss(model: ALSModel, weighted: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Mean squared preference error over the observed entries, weighted by confidence."""
    users = model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").alias("v"))
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    confidence = F.lit(1.0) + F.lit(alpha) * F.abs("weight")
    wanted = F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    scored = weighted.join(users, "user_idx", "left").join(items, "item_idx", "left").select(
        confidence.alias("c"), (wanted - F.coalesce(dot, F.lit(0.0))).alias("e")
    )
    return scored.agg(
        F.count(F.lit(1)).alias("entries"), F.try_divide(F.sum(F.col("c") * F.col("e") * F.col("e")), F.sum("c")).alias("loss")
    )


def artist_factors(model: ALSModel, artist_index: DataFrame) -> DataFrame:
    """(artist_id, features) of every artist; zeros for one without a positive weight."""
    factors = model.itemFactors.select(F.col("id").cast("long").alias("item_idx"), "features")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), model.rank)
    return artist_index.join(factors, "item_idx", "left").select("artist_id", F.coalesce("features", zeros).alias("features"))


# -- similar items ---------------------------------------------------------

_SCORED = "seed_id string, item_id string, score double"


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_list()).astype(np.float64)
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best(scores: np.ndarray, ids: np.ndarray, n: int, own: str) -> tuple[np.ndarray, np.ndarray]:
    """The n best (score, id) of one seed: itself first, then by score, equal scores by id."""
    ranked = np.where(ids == own, np.inf, scores)
    if len(scores) > n:
        floor = np.partition(ranked, len(ranked) - n)[len(ranked) - n]
        keep = ranked >= floor
        scores, ids, ranked = scores[keep], ids[keep], ranked[keep]
    order = np.lexsort((ids, -ranked))[:n]
    return scores[order], ids[order]


def _score_block(seed_ids: np.ndarray, seeds: np.ndarray, items: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n best items of every seed (unit vectors) within one block of items."""
    ids = items["item_id"].to_numpy()
    best = [_best(row, ids, n, own) for own, row in zip(seed_ids, seeds @ _unit(items["features"]).T)]
    return pd.DataFrame(
        {
            "seed_id": np.repeat(seed_ids, [len(s) for s, _ in best]),
            "item_id": np.concatenate([i for _, i in best]),
            "score": np.concatenate([s for s, _ in best]),
        }
    )


def similar_items(seeds: DataFrame, items: DataFrame, n: int = SIMILAR_ITEMS, seeds_per_block: int = SEEDS_PER_BLOCK, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """(seed_id, item_id, score, rank): the n items nearest to each seed by cosine.

    ``seeds`` is (seed_id, features), ``items`` (item_id, features), ids as text.
    The seed itself counts as an item. Only the n best per seed and task leave
    a task; no pair table is formed. The number of seeds is counted first: few
    seeds travel to the item partitions, many are split into blocks and each
    (seed block, item block) pair becomes one bounded group of the shuffle.
    """
    spark = seeds.sparkSession
    n_seeds = seeds.count()
    if n_seeds <= seeds_per_block:
        table = seeds.select("seed_id", "features").toPandas()
        matrix = spark.sparkContext.broadcast(
            (table["seed_id"].to_numpy(), _unit(table["features"])) if n_seeds else None
        )

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = None
            for batch in batches:
                if len(batch) and matrix.value is not None:
                    part = _score_block(*matrix.value, batch, n)
                    best = part if best is None else _merge(pd.concat([best, part]), n)
            if best is not None:
                yield best

        scored = items.select("item_id", "features").mapInPandas(scan, _SCORED)
    else:
        n_items = items.count()
        seed_blocks = -(-n_seeds // seeds_per_block)
        item_blocks = max(1, -(-n_items // items_per_block))
        left = seeds.select(
            F.col("seed_id").alias("sid"),
            F.col("features").alias("svec"),
            F.pmod(F.xxhash64("seed_id"), F.lit(seed_blocks)).cast("int").alias("sb"),
            F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("ib"),
        )
        right = items.select(
            F.col("item_id").alias("iid"),
            F.col("features").alias("ivec"),
            F.explode(F.sequence(F.lit(0), F.lit(seed_blocks - 1))).alias("sb"),
            F.pmod(F.xxhash64("item_id"), F.lit(item_blocks)).cast("int").alias("ib"),
        )

        def multiply(s: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
            if not len(s) or not len(i):
                return pd.DataFrame({"seed_id": [], "item_id": [], "score": []})
            i = i.rename(columns={"iid": "item_id", "ivec": "features"})
            return _score_block(s["sid"].to_numpy(), _unit(s["svec"]), i, n)

        scored = left.groupBy("sb", "ib").cogroup(right.groupBy("sb", "ib")).applyInPandas(multiply, _SCORED)
    return head_per_group(scored, "seed_id", n, (F.col("item_id") == F.col("seed_id")).desc(), F.col("score").desc(), F.col("item_id").asc())


def _merge(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    rows = rows.assign(other=rows["seed_id"] != rows["item_id"])
    ordered = rows.sort_values(["seed_id", "other", "score", "item_id"], ascending=[True, True, False, True], kind="stable").drop(columns="other")
    return ordered.groupby("seed_id", sort=False).head(n)


# -- seeds and recommendations ----------------------------------------------


def find_artists(ids: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing) of the requested artist ids."""
    known = counts.select("artist_id").distinct()
    wanted = ids.select("artist_id").distinct()
    return wanted.join(known, "artist_id", "left_semi"), wanted.join(known, "artist_id", "left_anti")


def popular_artists(counts: DataFrame, n: int = POPULAR_SEEDS) -> DataFrame:
    return top_rows(artist_totals(counts).select("artist_id", "total_listens"), "total_listens", "artist_id", n)


def select_seeds(counts: DataFrame, requested: DataFrame | None = None, defaults: Sequence[str] = DEFAULT_SEEDS, n: int = POPULAR_SEEDS) -> DataFrame:
    """Requested artists that occur in the counts; where none does, or none was
    asked for, the n most played ones and those defaults that occur."""
    spark: SparkSession = counts.sparkSession
    if requested is not None:
        found, _ = find_artists(requested, counts)
        if found.take(1):
            return found
    popular = popular_artists(counts, n).select("artist_id")
    if not defaults:
        return popular
    extra = spark.createDataFrame([(d,) for d in defaults], "artist_id string")
    present, _ = find_artists(extra, counts)
    return popular.unionByName(present).distinct()


def _has_direction() -> Column:
    return F.exists("features", lambda x: x != 0)


def seeds_without_factors(seeds: DataFrame, factors: DataFrame) -> DataFrame:
    """Seeds that get no recommendations: no vector, or a zero one."""
    known = factors.where(_has_direction()).select("artist_id")
    return seeds.select("artist_id").distinct().join(known, "artist_id", "left_anti")


def recommend(seeds: DataFrame, factors: DataFrame, artists: DataFrame, n: int = SIMILAR_ITEMS) -> DataFrame:
    """Ranked similar artists of all seeds in one job, the seed itself first. Seeds without a direction have no rows:
    ``seeds_without_factors`` names them."""
    items = factors.select(F.col("artist_id").alias("item_id"), "features")
    wanted = seeds.select(F.col("artist_id").alias("item_id")).distinct()
    vectors = items.join(wanted, "item_id", "left_semi").where(_has_direction()).select(F.col("item_id").alias("seed_id"), "features")
    scored = similar_items(vectors, items, n).select(
        F.col("seed_id").alias("source_artist_id"),
        F.col("rank"),
        F.col("item_id").alias("artist_id"),
        F.col("score").alias("similarity_score"),
    )
    named = add_artist_names(scored, artists, "artist_id", "artist_name")
    named = add_artist_names(named, artists, "source_artist_id", "source_artist")
    return named.select("source_artist_id", "source_artist", "rank", "artist_id", "artist_name", "similarity_score")
