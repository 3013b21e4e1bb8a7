"""The stage profile: what every table holds and what every step keeps, as datasets of one job.

Exact numbers come from key counts: a table is read once per key, grouped on the map side, and all that
concerns the key (distinct values, repeated rows, rows per key, coverage) is computed from the written counts. With
``exact=False`` the columns of a table are described by one scan with mergeable sketches instead: HyperLogLog for
distinct values, KLL for medians. Their bytes are a dataset of their own, so a new month is merged
without reading the old ones. Plain aggregates are used and not observed metrics, whose sums count
a task twice that runs again after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import item_count, percent
from ..operators import profile
from ..operators.redirect_ends import ambiguous_sources, redirect_ends
from ..operators.sets import union_all
from ..session import staged
from .funnel import profiled_mapping, stage_funnel

#: Keys of the tables, in the order in which they are profiled.
KEYS = {
    "listens": [("user_id", "recording_msid"), ("user_id",), ("recording_msid",)],
    "mapping": [("recording_msid",), ("recording_mbid",)],
    "redirects": [("recording_mbid",), ("canonical_recording_mbid",)],
    "canonical": [("recording_mbid",)],
    "artists": [("artist_mbid",), ("name",)],
}
TOP = 30
HLL_BITS = 14


def _items(df: DataFrame, make) -> Column:
    return F.array(*(make(f) for f in df.schema.fields))


def column_sketches(df: DataFrame, table: str) -> DataFrame:
    """(table, column_name, rows, nulls, distinct_sketch, quantile_sketch): one scan for all columns."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"n_{f.name}"), F.hll_sketch_agg(c.cast("string"), F.lit(HLL_BITS)).alias(f"d_{f.name}")]
        if isinstance(f.dataType, NumericType):
            aggs.append(F.kll_sketch_agg_double(c.cast("double")).alias(f"q_{f.name}"))
    row = df.agg(*aggs)

    def item(f) -> Column:
        quantiles = F.col(f"`q_{f.name}`") if isinstance(f.dataType, NumericType) else F.lit(None).cast("binary")
        nulls = F.col("rows") - F.col(f"`n_{f.name}`")
        return F.struct(F.lit(f.name).alias("column_name"), nulls.alias("nulls"), F.col(f"`d_{f.name}`").alias("distinct_sketch"), quantiles.alias("quantile_sketch"))

    return row.select(F.lit(table).alias("table"), "rows", F.explode(_items(df, item)).alias("c")).select("table", "rows", "c.*")


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """Sketches of several parts of the same tables as those of the whole; no part is read again."""
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("table", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch")
    )


def sketched_columns(sketches: DataFrame) -> DataFrame:
    """(table, column_name, rows, nulls, null_pct, distinct_values, median) out of the sketches: about 1 % off."""
    filled = F.col("quantile_sketch").isNotNull() & (F.kll_sketch_get_n_double("quantile_sketch") > 0)
    return sketches.select(
        "table", "column_name", "rows", "nulls", percent(F.col("nulls"), F.col("rows")).alias("null_pct"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), F.when(filled, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5))).alias("median"),
    )


def exact_columns(df: DataFrame, table: str) -> DataFrame:
    """(table, column_name, rows, nulls, null_pct, distinct_values): each column grouped once, on the map side first."""

    def one(name: str) -> DataFrame:
        groups = df.groupBy(F.col(f"`{name}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        row = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("distinct_values"))
        return row.select(F.lit(table).alias("table"), F.lit(name).alias("column_name"), "rows", "nulls", percent(F.col("nulls"), F.col("rows")).alias("null_pct"), "distinct_values")

    return union_all(*(one(c) for c in df.columns))


def key_counts(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, n): rows per key, written once and read by everything that concerns the key."""
    return staged(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "key-counts")


class StageProfile:
    """The datasets of one profile over the five tables; each is a DataFrame built when asked for."""

    def __init__(self, listens: DataFrame, mapping: DataFrame, redirects: DataFrame, canonical: DataFrame, artists: DataFrame):
        self.tables = {"listens": listens, "mapping": mapping, "redirects": redirects, "canonical": canonical, "artists": artists}
        self._counts: dict[tuple, DataFrame] = {}

    def counts(self, table: str, *keys: str) -> DataFrame:
        """Key counts, once each; those of one key of a pair are summed from the pair's, not from the table."""
        if (table, keys) not in self._counts:
            wider = next((k for k in KEYS.get(table, []) if len(k) > len(keys) and set(keys) < set(k)), None)
            if wider:
                made = staged(self.counts(table, *wider).groupBy(*keys).agg(F.sum("n").alias("n")), "key-counts")
            else:
                made = key_counts(self.tables[table], keys)
            self._counts[table, keys] = made
        return self._counts[table, keys]

    def columns(self) -> DataFrame:
        return union_all(*(exact_columns(df, name) for name, df in self.tables.items()))

    def column_sketches(self) -> DataFrame:
        return union_all(*(column_sketches(df, name) for name, df in self.tables.items()))

    def duplicates(self) -> DataFrame:
        """Per key: distinct keys, rows that share theirs (all members), their share, and the extra ones."""

        def one(table: str, keys: tuple[str, ...]) -> DataFrame:
            n = F.col("n")
            row = self.counts(table, *keys).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_rows"),
            )
            return row.select(F.lit(table).alias("table"), F.lit(",".join(keys)).alias("key"), "*", percent(F.col("duplicate_rows"), F.col("rows")).alias("duplicate_pct"))

        return union_all(*(one(t, k) for t, keys in KEYS.items() for k in keys))

    def spreads(self) -> DataFrame:
        """Mean, median, least and most of listens per user and recording, and of artists per recording."""
        per = {
            "listens per user": self.counts("listens", "user_id").filter("user_id is not null").select(F.col("n").alias("x")),
            "listens per recording": self.counts("listens", "recording_msid").filter("recording_msid is not null").select(F.col("n").alias("x")),
            "artists per recording": profile.artists_per_recording(self.tables["canonical"]).select(F.col("artist_count").cast("long").alias("x")),
        }
        return union_all(*(profile.spread(df, "x").withColumn("measure", F.lit(name)) for name, df in per.items())).select("measure", "mean", "median", "min", "max")

    def shares(self) -> DataFrame:
        """Rows per match type and per number of artists, with their share."""
        levels = profile.value_shares(self.tables["mapping"].select(F.col("match_type").alias("value")), "value")
        sizes = profile.value_shares(self.tables["canonical"].select(item_count(F.col("artist_mbids")).cast("string").alias("value")), "value")
        return union_all(levels.withColumn("measure", F.lit("match type")), sizes.withColumn("measure", F.lit("artists per recording")))

    def coverage(self) -> DataFrame:
        """How many keys of a step's input the next table holds."""
        t = self.tables
        canonical_ids = self.canonical_mapping().select("canonical_mbid")
        steps = {
            "msids in mapping": (self.counts("listens", "recording_msid"), t["mapping"], "recording_msid", None),
            "mbids redirected": (self.counts("mapping", "recording_mbid"), t["redirects"], "recording_mbid", None),
            "canonical mbids with data": (canonical_ids, t["canonical"], "canonical_mbid", "recording_mbid"),
        }
        return union_all(*(profile.coverage(a, b, key, other).withColumn("step", F.lit(name)) for name, (a, b, key, other) in steps.items()))

    def canonical_mapping(self) -> DataFrame:
        if "canonical_mapping" not in self._counts:
            messages = self.counts("listens", "recording_msid")
            self._counts["canonical_mapping"] = staged(profiled_mapping(messages, self.tables["mapping"], self.tables["redirects"]), "canonical-mapping")
        return self._counts["canonical_mapping"]

    def redirects(self) -> DataFrame:
        """Self-redirects, redirected targets, sources of several targets, and the longest way to an end, circular ones apart."""
        r = self.tables["redirects"]
        ends = redirect_ends(r)
        row = ends.agg(
            F.coalesce(F.max(F.when(F.col("status") == "terminal", F.col("hops"))), F.lit(0)).alias("longest_chain"), F.count_if(F.col("status") == "circular").alias("circular_sources")
        )
        several = ambiguous_sources(r).agg(F.count(F.lit(1)).alias("ambiguous_sources"))
        frames = [profile.redirect_profile(r), row, several]
        wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return wide.agg(*(F.max(c).alias(c) for c in wide.columns))

    def canonicalisation(self) -> DataFrame:
        return profile.canonicalisation_effect(self.canonical_mapping())

    def flow(self) -> DataFrame:
        return stage_funnel(*self.tables.values())

    def top_keys(self) -> DataFrame:
        """The 30 users and recordings of most listens."""

        def one(key: str) -> DataFrame:
            rows = self.counts("listens", key).filter(F.col(key).isNotNull()).select(F.lit(key).alias("key"), F.col(key).cast("string").alias("value"), F.col("n").alias("listens"))
            return rows.orderBy(F.desc("listens"), "value").limit(TOP)

        return union_all(one("user_id"), one("recording_msid"))


DATASETS = ("columns", "duplicates", "spreads", "shares", "coverage", "redirects", "canonicalisation", "flow", "top_keys")


def write_stage_profile(tables: Mapping[str, DataFrame], root: str, exact: bool = True) -> dict[str, str]:
    """Write every dataset of the profile below ``root``; returns their paths.

    Without ``exact`` the columns come from sketches, which are written too, as ``column_sketches``.
    """
    made = StageProfile(**tables)
    spark = made.tables["listens"].sparkSession
    paths = {name: f"{root.rstrip('/')}/{name}.parquet" for name in (*DATASETS, "retention", "losses", *(() if exact else ("column_sketches",)))}
    if not exact:
        made.column_sketches().write.mode("overwrite").parquet(paths["column_sketches"])
    for name in DATASETS:
        if name == "columns" and not exact:
            frame = sketched_columns(spark.read.parquet(paths["column_sketches"]))
        else:
            frame = getattr(made, name)()
        frame.write.mode("overwrite").parquet(paths[name])
    flow = spark.read.parquet(paths["flow"])
    profile.overall_retention(flow).write.mode("overwrite").parquet(paths["retention"])
    profile.main_losses(flow).write.mode("overwrite").parquet(paths["losses"])
    return paths
