"""Implicit ALS for few items: the factors of users never leave the task that holds the users' ratings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import arrow_batches_of, discard, scratch_path, staged

# A task holds the systems of all items at once: 64 MB are 2,048 items of 64 factors.
SYSTEMS_BYTES = 64 << 20

# Ratings that a task sorts and packs, those that are worked on together, and those that are gathered at once.
TASK_RATINGS = 4_000_000
BLOCK_RATINGS = 1 << 17
GATHERED_RATINGS = 1 << 12

_PACKED = "users binary, starts binary, items binary, weights binary, first binary"
_SUMS = "part int, item int, sums binary"


def fits(items: int, rank: int) -> bool:
    """Whether the systems of so many items fit a task."""
    return 0 < items * rank * rank * 8 <= SYSTEMS_BYTES


def _pack(items: np.ndarray, rank: int):
    """Rows sorted by user (a row without weight holds the user's first factors) to blocks of whole users.

    The users of a block are ordered by their number of ratings, so that those of one number are worked on together.
    """

    def block(user: np.ndarray, item: np.ndarray, weight: np.ndarray, first: np.ndarray) -> dict[str, bytes]:
        start = np.isnan(weight)
        users = user[start]
        at, to = np.searchsorted(items, item), np.searchsorted(users, user)
        rated = ~start & (items[np.minimum(at, len(items) - 1)] == item)
        rated &= users[np.minimum(to, max(len(users) - 1, 0))] == user if len(users) else False
        at, to, weight = at[rated], to[rated], weight[rated]
        n = np.bincount(to, minlength=len(users))
        order = np.argsort(n, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        by_user = np.argsort(place[to], kind="stable")
        return {
            "users": users[order].astype(np.int32).tobytes(),
            "starts": np.concatenate([[0], np.cumsum(n[order])]).astype(np.int64).tobytes(),
            "items": at[by_user].astype(np.int32).tobytes(),
            "weights": weight[by_user].astype(np.float32).tobytes(),
            "first": first[order].tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def emitted(part: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block(*(np.concatenate(c) for c in zip(*part)))], schema=pa.schema([(c.split()[0], pa.binary()) for c in _PACKED.split(", ")]))

        for batch in batches:
            if not batch.num_rows:
                continue
            user, item = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            weight = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            first = np.asarray(batch.column(3).flatten(), dtype=np.float32).reshape(-1, rank)
            if rows >= BLOCK_RATINGS and user[-1] != held[-1][0][-1]:
                # The block ends before the batch's last user; what is left of the batch begins the next one.
                cut = int(np.searchsorted(user, user[-1]))
                known = int(np.isnan(weight[:cut]).sum())
                yield emitted([*held, (user[:cut], item[:cut], weight[:cut], first[:known])])
                held, rows = [], 0
                user, item, weight, first = user[cut:], item[cut:], weight[cut:], first[known:]
            held.append((user, item, weight, first))
            rows += len(user)
        if held:
            yield emitted(held)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch], rank: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(users, starts, items, weights, first factors, if they were read) of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            first = row.get("first")
            if not row["users"]:
                continue
            yield (
                np.frombuffer(row["users"], np.int32),
                np.frombuffer(row["starts"], np.int64),
                np.frombuffer(row["items"], np.int32),
                np.frombuffer(row["weights"], np.float32).astype(np.float64),
                None if first is None else np.frombuffer(first, np.float32).reshape(-1, rank),
            )


def _solver(factors: np.ndarray, regularisation: float, alpha: float):
    """A function that solves the users of a block against the items' factors.

    A user's system is G + F' C F + r I, with G = Y'Y of all items, F the factors of the user's items, C their confidences less
    one and r the regularisation times the user's positive ratings. With fewer ratings than factors the system of the ratings,
    I + C^.5 F (G + r I)^-1 F' C^.5, is smaller (Woodbury); in the eigenvectors of G the inverse within it is a diagonal.
    """
    y = factors.astype(np.float64)
    gram = y.T @ y
    rank = len(gram)
    values, vectors = np.linalg.eigh(gram)
    values, turned = np.maximum(values, 0.0), y @ vectors

    def solve(starts: np.ndarray, items: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts) - 1, rank), np.float32)
        n = np.diff(starts)
        edges = np.flatnonzero(np.diff(n)) + 1
        for low, high in zip([0, *edges], [*edges, len(n)]):
            each = int(n[low])
            step = max(1, GATHERED_RATINGS // each)
            for lo in range(low, high, step):
                hi = min(lo + step, high)
                at = items[starts[lo] : starts[hi]].reshape(-1, each)
                w = weights[starts[lo] : starts[hi]].reshape(-1, each)
                c, liked = alpha * np.abs(w), w > 0
                target = np.where(liked, 1.0 + c, 0.0)
                ridge = regularisation * liked.sum(axis=1)
                if each < rank and ridge.all():
                    f = turned[at]
                    b = np.matmul(target[:, None, :], f)[:, 0]
                    d = 1.0 / (values + ridge[:, None])
                    f *= np.sqrt(c)[:, :, None]
                    g = f * d[:, None, :]
                    small = np.matmul(g, f.transpose(0, 2, 1))
                    small.reshape(len(small), -1)[:, :: each + 1] += 1.0
                    s = np.linalg.solve(small, np.matmul(g, b[:, :, None]))
                    out[lo:hi] = (d * b - np.matmul(s.transpose(0, 2, 1), g)[:, 0]) @ vectors.T
                else:
                    f = y[at]
                    b = np.matmul(target[:, None, :], f)
                    whole = np.matmul(f.transpose(0, 2, 1), f * c[:, :, None]) + gram
                    whole.reshape(len(whole), -1)[:, :: rank + 1] += ridge[:, None]
                    out[lo:hi] = np.linalg.solve(whole, b.transpose(0, 2, 1))[:, :, 0]
        return out

    return solve


def _item_sums(n_items: int, rank: int, parts: int, alpha: float, factors: np.ndarray | None, regularisation: float):
    """The task's share of every item's system, from its users' first factors or those that answer the items' ``factors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = None if factors is None else _solver(factors, regularisation, alpha)
        systems, targets, liked = np.zeros((n_items, rank, rank)), np.zeros((n_items, rank)), np.zeros(n_items)
        gram, seen = np.zeros((rank, rank)), False
        for _, starts, items, weights, first in _unpacked(batches, rank):
            seen = True
            x = (first if solve is None else solve(starts, items, weights)).astype(np.float64)
            gram += x.T @ x
            user = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            order = np.argsort(items, kind="stable")
            edges = np.concatenate([[0], np.cumsum(np.bincount(items, minlength=n_items))])
            c, plus = alpha * np.abs(weights), weights > 0
            target, root = np.where(plus, 1.0 + c, 0.0), np.sqrt(c)
            liked += np.bincount(items[plus], minlength=n_items)
            for i in np.flatnonzero(np.diff(edges)):
                at = order[edges[i] : edges[i + 1]]
                f = x[user[at]]
                targets[i] += target[at] @ f
                f *= root[at][:, None]
                systems[i] += f.T @ f
        if not seen:
            return
        upper = np.triu_indices(rank)
        schema = pa.schema([("part", pa.int32()), ("item", pa.int32()), ("sums", pa.binary())])
        # What all users have in common goes to every part, as an item of the number -1.
        yield pa.RecordBatch.from_pylist([{"part": p, "item": -1, "sums": gram[upper].tobytes()} for p in range(parts)], schema=schema)
        for low in range(0, n_items, 256):
            some = range(low, min(low + 256, n_items))
            sums = (np.concatenate([systems[i][upper], targets[i], liked[i : i + 1]]).tobytes() for i in some)
            yield pa.RecordBatch.from_pylist([{"part": i % parts, "item": i, "sums": s} for i, s in zip(some, sums)], schema=schema)

    return run


def _item_factors(rank: int, regularisation: float):
    """The shares of a part's items added up, and the items' factors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key, sums = (row["part"], row["item"]), np.frombuffer(row["sums"], np.float64)
                total[key] = total[key] + sums if key in total else sums
        upper = np.triu_indices(rank)
        for (part, item), sums in total.items():
            if item < 0:
                continue
            whole = np.zeros((rank, rank))
            whole[upper] = sums[: len(upper[0])] + total[part, -1]
            whole += np.triu(whole, 1).T
            whole[np.diag_indices(rank)] += regularisation * sums[-1]
            x = np.linalg.solve(whole, sums[len(upper[0]) : -1]).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"item": pa.array([item], pa.int32()), "features": pa.array([x.tobytes()], pa.binary())})

    return run


def _user_factors(rank: int, alpha: float, factors: np.ndarray, regularisation: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = _solver(factors, regularisation, alpha)
        for users, starts, items, weights, _ in _unpacked(batches, rank):
            x = solve(starts, items, weights)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * rank), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(users), lists], names=["id", "features"])

    return run


def fit(als: ALS, ratings: DataFrame, n_ratings: int) -> ALSModel:
    """The model that ``als.fit`` gives for implicit ``ratings`` of (user_idx int, item_idx int, weight double), by other means.

    Ratings of a null index, and those of users or items without a positive weight, stay out of the fit. The first factors of
    the users are those of ``als``. The ratings are packed once, in blocks of whole users. A round sends the items' factors
    to the tasks; each solves its users and returns its share of the items' systems, whose size depends on the items alone.
    So no user's factors are shuffled, and all cores share the work on an item, however many users it has.
    """
    spark = ratings.sparkSession
    rank, alpha, regularisation = als.getRank(), als.getAlpha(), als.getRegParam()
    positive = ratings.filter(F.col("weight") > 0)
    items = np.array(sorted(r[0] for r in positive.select("item_idx").dropna().distinct().collect()), dtype=np.int64)
    n_items, width = len(items), als.getNumUserBlocks()
    parts = min(width, n_items)

    # The first factors depend on the users alone, so one rating of each is enough to have them made.
    users = positive.select("user_idx").dropna().distinct().select("user_idx", F.lit(0).alias("item_idx"), F.lit(1.0).cast("float").alias("weight"))
    started = als.copy({als.maxIter: 0, als.numItemBlocks: 1, als.finalStorageLevel: "NONE"}).fit(users).userFactors
    rows = ratings.select("user_idx", "item_idx", "weight", F.lit(None).cast("array<float>").alias("first")).filter("user_idx is not null and item_idx is not null")
    rows = rows.unionByName(started.select(F.col("id").alias("user_idx"), F.lit(0).alias("item_idx"), F.lit(None).cast("double").alias("weight"), F.col("features").alias("first")))
    # Equal shares of a whole number per core, so that no round waits for a last task.
    shares = width * -(-n_ratings // (width * TASK_RATINGS))
    sorted_rows = rows.repartition(shares, "user_idx").sortWithinPartitions("user_idx")
    packed = staged(sorted_rows.mapInArrow(_pack(items, rank), _PACKED), "packed")

    factors = None
    with arrow_batches_of(spark, 1):
        for _ in range(als.getMaxIter()):
            read = packed if factors is None else packed.drop("first")
            sums = read.mapInArrow(_item_sums(n_items, rank, parts, alpha, factors, regularisation), _SUMS)
            solved = sums.repartition(parts, "part").mapInArrow(_item_factors(rank, regularisation), "item int, features binary")
            found = dict(solved.collect())
            factors = np.stack([np.frombuffer(found[i], np.float32) for i in range(n_items)])
        answers = packed.drop("first").mapInArrow(_user_factors(rank, alpha, factors, regularisation), "id int, features array<float>")
        # A saved model is its settings and two tables, so the settings of a model of one rating are saved and both tables replaced.
        path = scratch_path(spark, "als")
        one = spark.createDataFrame([(0, 0, 1.0)], "user_idx int, item_idx int, weight float")
        als.copy({als.maxIter: 0, als.numUserBlocks: 1, als.numItemBlocks: 1}).fit(one).save(path)
        answers.write.mode("overwrite").parquet(f"{path}/userFactors")
    made = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(items, factors)], "id int, features array<float>")
    made.coalesce(1).write.mode("overwrite").parquet(f"{path}/itemFactors")
    discard(packed)
    return ALSModel.load(path)
