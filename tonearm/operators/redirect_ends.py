"""Where redirects end, by pointer jumping: ids, ends and hops only, no paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def single_steps(redirects: DataFrame) -> DataFrame:
    """(id, next): one target per source, the highest."""
    steps = redirects.groupBy(F.col("recording_mbid").alias("id")).agg(F.max("canonical_recording_mbid").alias("next"))
    return steps.filter("id is not null and next is not null")


def ambiguous_sources(redirects: DataFrame) -> DataFrame:
    """(recording_mbid, targets): sources with several targets, of which only the highest is followed."""
    targets = redirects.dropna().groupBy("recording_mbid").agg(F.count_distinct("canonical_recording_mbid").alias("targets"))
    return targets.filter("targets > 1")


def jumped(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, end, hops) of every id whose walk ends, (id, next) of those whose walk never does).

    Every open id looks up its end and takes over that id's end and hops, so the distance doubles per round. An id
    whose end leads nowhere is closed, written, and joins no more. As long as an open walk ends anywhere, ids at
    every smaller distance exist, so a round without a closed id shows that the rest run in circles.
    """
    sources = steps.select(F.col("id").alias("end"), F.lit(True).alias("goes_on"))
    first = steps.select("id", F.col("next").alias("end"), F.lit(1).cast("long").alias("hops")).join(sources, "end", "left")
    state = staged(first.select("id", "end", "hops", F.col("goes_on").isNotNull().alias("open")), "jumps")
    closed, now = state.filter("not open").drop("open"), state.filter("open").drop("open")
    left = now.count()
    while left:
        known = now.withColumn("open", F.lit(True)).unionByName(closed.withColumn("open", F.lit(False)))
        known = known.select(F.col("id").alias("end"), F.col("end").alias("far"), F.col("hops").alias("more"), "open")
        met = now.join(known, "end").select("id", F.col("far").alias("end"), (F.col("hops") + F.col("more")).alias("hops"), "open")
        state = staged(met, "jumps")
        closed, now = closed.unionByName(state.filter("not open").drop("open")), state.filter("open").drop("open")
        before, left = left, now.count()
        if left == before:
            break
    return closed, steps.join(now.select("id"), "id", "left_semi")


def cycles(steps: DataFrame) -> DataFrame:
    """(id, label, length) of the ids on cycles, of steps that all lead to one; the label is the cycle's lowest id.

    A jump of twice the length is taken until the set of ids that it reaches no longer shrinks: these lie on cycles.
    Their labels are the lowest ids of doubling stretches, until a round changes none.
    """
    jump = staged(steps, "cycle-jumps")
    reached = jump.select("next").distinct().count()
    while True:
        twice = jump.select(F.col("id").alias("next"), F.col("next").alias("far"))
        jump = staged(jump.join(twice, "next").select("id", F.col("far").alias("next")), "cycle-jumps")
        before, reached = reached, jump.select("next").distinct().count()
        if reached == before:
            break
    on = steps.join(jump.select(F.col("next").alias("id")).distinct(), "id", "left_semi")
    state = staged(on.select("id", "next", F.least("id", "next").alias("label")), "cycle-labels")
    while True:
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("far"), F.col("label").alias("seen"))
        met = state.join(ahead, "next").select("id", F.col("far").alias("next"), F.least("label", "seen").alias("label"), (F.col("seen") < F.col("label")).alias("moved"))
        after = staged(met, "cycle-labels")
        state = after.drop("moved")
        if after.filter("moved").isEmpty():
            break
    sizes = state.groupBy("label").agg(F.count(F.lit(1)).alias("length"))
    return state.join(sizes, "label").select("id", "label", "length")


def redirect_ends(redirects: DataFrame) -> DataFrame:
    """(recording_mbid, final_mbid, hops, status, cycle) of every redirected id, however long its chain.

    ``terminal``: ``final_mbid`` is redirected no further. ``circular``: it is the first id that the walk meets
    twice, after ``hops`` links, and ``cycle`` is the lowest id of that cycle. State is written every round;
    the driver sees one number a round. ``redirect_walks`` gives the ids on the way.
    """
    ended, endless = jumped(staged(single_steps(redirects), "steps"))
    out = ended.select("id", "end", "hops", F.lit("terminal").alias("status"), F.lit(None).cast("string").alias("cycle"))
    endless = staged(endless, "endless")
    if not endless.isEmpty():
        rings = staged(cycles(endless), "rings")
        on = rings.select("id", F.col("id").alias("end"), F.col("length").alias("hops"), F.lit("circular").alias("status"), F.col("label").cast("string").alias("cycle"))
        tails, _ = jumped(staged(endless.join(rings.select("id"), "id", "left_anti"), "tails"))
        entry = rings.select(F.col("id").alias("end"), "label", "length")
        led = tails.join(entry, "end").select("id", "end", (F.col("hops") + F.col("length")).alias("hops"), F.lit("circular").alias("status"), F.col("label").cast("string").alias("cycle"))
        out = out.unionByName(on).unionByName(led)
    return out.select(F.col("id").alias("recording_mbid"), F.col("end").alias("final_mbid"), "hops", "status", "cycle")
