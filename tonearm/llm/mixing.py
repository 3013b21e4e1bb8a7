"""Mixing sources by temperature: weights from exponentiated token shares, realised as permutations of blocks.

A source's weight is its token share to the power of an exponent, normalised. The exponent is bisected: to the
largest that reaches a target entropy, or to the smallest that keeps every source's repetitions within a limit.
Each step halves many times at once, by trying a grid of exponents in one pass over the table of sources, so
the driver sees a row per exponent and never a list of sources.

A source's budget is realised in passes. Documents fall into blocks by hash; every pass orders the blocks, and
the documents of a block, anew. Whole passes take all; the last one takes blocks in its order, then documents
of the block in which the budget ends. That cut is two numbers per source, so documents meet a table of
sources only.

Tokens are runs of non-space characters. A null text has none, a null source is a source of its own. Without
a budget, it is the smallest that gives every source a whole pass, so that no document goes. Repeated rows
are dealt alike; rows without an id too. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonearm.session import staged

from .common import columns_of

BLOCKS, GRID, ROUNDS, SEED = 4096, 32, 5, 42
LIMIT = 1.5
#: A source that no text has as its name.
NO_SOURCE = "\u0000"


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, tokens, block) per row."""
    rows = columns_of(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
    source = F.coalesce(F.col("source"), F.lit(NO_SOURCE))
    return rows.select("doc_id", source.alias("source"), F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long").alias("tokens"), block_of(F.col("doc_id")).alias("block"))


def block_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), doc_id), F.lit(BLOCKS)).cast("int")


def mixture(totals: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget: float | None = None) -> tuple[float, float, float]:
    """(exponent, sum of powers, budget) over (source, tokens).

    ``limit`` bounds repetitions; ``entropy`` is a share (0 to 1) of the entropy of equal weights instead.
    """
    shares = staged(with_total(totals), "shares")
    sources, top, every = shares.agg(F.count("*"), F.max("p"), F.max("all")).first()
    if not sources:
        return 1.0, 1.0, 0.0
    low, high = 0.0, 1.0
    p = F.col("p")

    def tried(points: list[float]) -> list[tuple[float, bool]]:
        grid = shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("e"))
        power = F.pow(p, F.col("e"))
        rows = grid.groupBy("e").agg(F.sum(power).alias("z"), F.sum(power * F.log("p") * F.col("e")).alias("s"), F.max(power / p).alias("r")).collect()
        out = []
        for r in rows:
            spread = math.log(r.z) - r.s / r.z
            # repetitions = budget * weight / tokens; without a budget the largest source is read once
            repeats = (budget / every) * r.r / r.z if budget is not None else r.r / top ** (r.e - 1)
            fits = repeats <= limit * (1 + 1e-12) if entropy is None else spread < entropy * math.log(sources) - 1e-12
            out.append((r.e, fits))
        return sorted(out)

    for _ in range(ROUNDS):
        points = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        results = tried(points)
        yes = [e for e, fits in results if fits]
        if not yes:
            low = high
            break
        high = min(yes)
        low = max([e for e, fits in results if not fits and e < high], default=high)
        if low == high:
            break
    exponent = high
    z = shares.agg(F.sum(F.pow(p, F.lit(exponent)))).first()[0]
    least = every * z * top ** (1 - exponent)
    return exponent, z, least if budget is None else float(budget)


def with_total(totals: DataFrame) -> DataFrame:
    every = totals.agg(F.sum("tokens")).first()[0] or 0
    return totals.where("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(float(every or 1))).alias("p"), F.lit(float(every)).alias("all"))


def order_of(kind: str, number: Column, *keys: Column) -> Column:
    return F.xxhash64(F.lit(SEED), F.lit(kind), number.cast("long"), *keys)


def plan(rows: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """(source, weight, whole, last_block, last_doc): whole passes, and where the pass after them ends.

    ``last_block`` is the order of the block in which the budget ends and ``last_doc`` the order of the last
    document taken there. A source has at most 4096 blocks; only that block's documents are ordered.
    """
    blocks = staged(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    totals = staged(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "totals")
    exponent, z, budget_ = mixture(totals, limit, entropy, budget)
    weight = F.pow(F.col("p"), F.lit(exponent)) / F.lit(z)
    sources = with_total(totals).select("source", "tokens", weight.alias("weight"), (F.lit(budget_) * weight / F.col("tokens")).alias("repeats"))
    whole = F.floor(F.col("repeats") + 1e-9)
    sources = staged(sources.select("source", "weight", whole.alias("whole"), F.floor((F.col("repeats") - whole) * F.col("tokens")).alias("rest")), "sources")
    turn = order_of("block", F.col("whole"), F.col("source"), F.col("block"))
    ordered = blocks.join(sources, "source").withColumn("turn", turn)
    before = Window.partitionBy("source").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    ordered = ordered.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    ends = staged(ordered.where("before <= rest and before + tokens > rest").groupBy("source").agg(F.min(F.struct("turn", "block", "before")).alias("e")).select("source", "e.*"), "ends")
    near = rows.join(ends, ["source", "block"]).join(sources, "source")
    near = near.withColumn("place", order_of("doc", F.col("whole"), F.col("doc_id")))
    upto = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = near.withColumn("upto", F.sum("tokens").over(upto) + F.col("before")).where("upto <= rest")
    last = taken.groupBy("source").agg(F.max("place").alias("last_doc"))
    return sources.select("source", "weight", "whole").join(ends.select("source", F.col("turn").alias("last_block")), "source", "left").join(last, "source", "left")


def scheduled(rows: DataFrame, plan_: DataFrame) -> DataFrame:
    """The rows of (doc_id, source, block, ...) once per pass that takes them, with ``pass`` and the place in it."""
    met = rows.join(plan_, "source", "left")
    whole = F.coalesce("whole", F.lit(1))
    turn, place = order_of("block", whole, F.col("source"), F.col("block")), order_of("doc", whole, F.col("doc_id"))
    extra = F.coalesce((turn < F.col("last_block")) | ((turn == F.col("last_block")) & (place <= F.col("last_doc"))), F.lit(False))
    times = (whole + extra.cast("long")).cast("int")
    met = met.withColumn("pass", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    return met.withColumns({"block_turn": order_of("block", F.col("pass"), F.col("source"), F.col("block")), "doc_turn": order_of("doc", F.col("pass"), F.col("doc_id"))})


def mix_schedule(docs: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, weight, pass, block_turn, doc_turn): each time that a document is read.

    Reading in the order of pass, block_turn and doc_turn gives the mixture's block permutation.
    """
    rows = staged(token_rows(docs), "tokens")
    out = scheduled(rows, staged(plan(rows, limit, entropy, budget), "plan"))
    return out.select("doc_id", F.nullif("source", F.lit(NO_SOURCE)).alias("source"), F.col("tokens").alias("n_tokens"), F.coalesce("weight", F.lit(0.0)).alias("weight"), "pass", "block_turn", "doc_turn")


def mixed(docs: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """The documents themselves, each as often as the mixture reads it, with all their columns, found by exact spelling."""
    rows = staged(token_rows(docs), "tokens")
    plan_ = staged(plan(rows, limit, entropy, budget), "plan")
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    doc_id, source = (F.col(f"c{names.index(c)}") for c in ("doc_id", "source"))
    data = plain.select(F.struct("*").alias("row"), doc_id.alias("doc_id"), F.coalesce(source, F.lit(NO_SOURCE)).alias("source"), block_of(doc_id).alias("block"))
    return scheduled(data, plan_).select("row.*").toDF(*names)
