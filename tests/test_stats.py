"""Statistics, distribution, profiles, sets and functions on hand-made tables."""

import random

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from tonearm import functions as fn
from tonearm.operators import compare, distribution, diversity, indexing, profile, sets, stats
from tonearm.schemas import COUNTS


@pytest.fixture(scope="module")
def counts(spark):
    """Listener counts 1, 2, 3, 5, 6, 10, 11, 20, 21, 50, 51, 100, 101 (one artist each)."""
    spec = [1, 2, 3, 5, 6, 10, 11, 20, 21, 50, 51, 100, 101]
    data = [(u, f"a{n}", 1 + (u * n) % 7) for n in spec for u in range(n)]
    return spark.createDataFrame(data, COUNTS), data, spec


def test_statistics(counts):
    df, data, spec = counts
    users = {u for u, _, _ in data}
    listens = sum(c for _, _, c in data)
    row = stats.dataset_statistics(df).first()
    assert (row["total_users"], row["total_artists"], row["total_entries"], row["total_listens"]) == (len(users), len(spec), len(data), listens)
    assert row["avg_listens_per_user"] == pytest.approx(listens / len(users))
    assert row["avg_artists_per_user"] == pytest.approx(len(data) / len(users))
    assert row["avg_users_per_artist"] == pytest.approx(len(data) / len(spec))


def test_buckets_and_cumulative(counts, spark):
    df, _, spec = counts
    dist = distribution.listener_distribution(df)
    b = {r["label"]: r for r in distribution.listener_buckets(dist).collect()}
    assert {k: v["count"] for k, v in b.items()} == {"1-1": 1, "2-2": 1, "3-5": 2, "6-10": 2, "11-20": 2, "21-50": 2, "51-100": 2, "101+": 1}
    assert b["101+"]["high"] == 101 and sum(v["count"] for v in b.values()) == len(spec)
    curve = distribution.cumulative_distribution(dist, 5).orderBy("listener_count").collect()
    assert [r["cumulative_artists"] for r in curve] == [1, 2, 3, 4, 5]
    assert curve[-1]["cumulative_pct"] == pytest.approx(5 / 13 * 100)
    empty = distribution.listener_buckets(dist.filter("listener_count > 100"))
    assert empty.count() == 8 and empty.filter("label = '2-2'").first()["count"] == 0


def test_percentiles_and_summary(counts):
    df, _, spec = counts
    row = distribution.distribution_summary(df).first()
    assert (row["median"], row["max"], row["total_artists"], row["total_users"]) == (11, 101, 13, 101)
    assert distribution.listener_percentiles(df).first()["p90"] == 100
    assert distribution.listener_spread(df).first()["mean"] == pytest.approx(sum(spec) / 13)


def test_top_k_ties_by_id(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 5), (2, "d", 1)], COUNTS)
    assert [r["artist_id"] for r in stats.top_artists(df, 2).collect()] == ["a", "b"]


@pytest.mark.parametrize("n", [1, 5, 150])
def test_bands_against_brute_force(spark, n):
    rnd = random.Random(n)
    totals = [(u, rnd.choice([1, 2, 3, 50, 900])) for u in range(n)]
    df = spark.createDataFrame(totals, "user_id LONG, total_listens LONG")
    order = sorted(totals, key=lambda x: (-x[1], x[0]))
    one, ten, half = max(1, int(n * 0.01)), int(n * 0.1), int(n * 0.5)
    band = lambda i: 0 if i < one else 1 if i < ten else 2 if i < half else 3
    got = {r["user_id"]: (r["position"], r["band"]) for r in stats.activity_bands(df).collect()}
    names = stats.ACTIVITY_BANDS
    assert got == {u: (i, names[band(i)]) for i, (u, _) in enumerate(order)}
    total = sum(x for _, x in totals)
    listens = [x for _, x in order]
    parts = [listens[:one], listens[one:ten], listens[ten:half], listens[half:]]
    shares = {r["band"]: r["share_pct"] for r in stats.activity_shares(df).collect()}
    for name, part in zip(names[:3], parts[:3]):
        assert shares[name] == pytest.approx(sum(part) / total * 100)


def test_histogram(spark):
    df = spark.range(101).select(F.col("id").alias("x"))
    h = stats.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["n"] for r in h] == [10] * 9 + [11] and h[0]["low"] == 0 and h[-1]["high"] == 100
    flat = stats.histogram(df.select(F.lit(5).alias("x")), "x", 4).collect()
    assert sum(r["n"] for r in flat) == 101 and len(flat) == 4


def test_dense_index_over_many_partitions(spark):
    ids = [f"k{i:05d}" for i in range(5000)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids + ids[:100]], "id STRING").repartition(13)
    got = {r["id"]: r["idx"] for r in indexing.dense_index(df, "id").collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(ids)))}


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (3, None), (4, "b")], "u LONG, m STRING")
    assert rows(profile.duplicate_profile(df, "u", "m")) == [(6, 3, 2, 50.0)]
    assert rows(profile.duplicate_profile(df, "m")) == [(6, 5, 3, pytest.approx(5 / 6 * 100))]
    assert rows(profile.null_profile(df)) == [("m", 2, pytest.approx(100 / 3)), ("u", 0, 0.0)]
    assert rows(profile.unique_counts(df, "u", "m")) == [(4, 2)]
    assert rows(profile.spread(profile.rows_per_key(df, "u"), "listen_count")) == [(1.5, 1.0, 1, 3)]
    assert profile.duplicate_members(df, "m", 5).count() == 3
    other = spark.createDataFrame([("a",), ("z",)], "m STRING")
    assert rows(profile.coverage(df, other, "m")) == [(2, 1, 1, 50.0)]
    assert profile.table_profile(df, "t").first()["rows"] == 6


def test_mapping_coverage_with_fan_out(spark):
    listens = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "u LONG, recording_msid STRING")
    mapping = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("b", None)], "recording_msid STRING, recording_mbid STRING")
    row = profile.mapping_coverage(listens, mapping).first()
    assert (row["mapped_count"], row["unmapped_count"], row["total"]) == (4, 3, 7)
    nothing = spark.createDataFrame([(0, 0)], "mapped_count LONG, unmapped_count LONG")
    assert profile.quality_metrics(nothing).count() == 0


def test_flow(spark):
    one = lambda n: spark.createDataFrame([(n,)], "n LONG")
    flow = profile.stage_flow([("x", one(10), one(8)), ("y", one(0), one(0)), ("z", one(8), one(2))])
    got = {r["step"]: (r["retention_pct"], r["loss_count"], r["loss_pct"]) for r in flow.collect()}
    assert got == {"x": (80.0, 2, 20.0), "y": (0.0, 0, 100.0), "z": (25.0, 6, 75.0)}
    assert rows(profile.overall_retention(flow)) == [(10, 2, 20.0, 80.0)]
    assert {r["step"] for r in profile.main_losses(flow, 20).collect()} == {"y", "z"}


def test_redirect_profile(spark):
    r = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "d"), ("e", "b")], "recording_mbid STRING, canonical_recording_mbid STRING")
    row = profile.redirect_profile(r).first()
    assert (row["rows"], row["self_redirects"], row["redirected_targets"]) == (4, 1, 2)


def test_sets(spark):
    a = spark.createDataFrame([("x", 2), ("x", 1), ("y", 5), (None, 1)], "k STRING, v INT")
    b = spark.createDataFrame([("x",)], "k STRING")
    assert rows(sets.first_per_key(a.dropna(), "k", F.col("v"))) == [("x", 1), ("y", 5)]
    assert rows(sets.keys_in_both(a, b, "k")) == [("x",)] and rows(sets.keys_missing(a, b, "k")) == [("y",)]
    lists = spark.createDataFrame([(["a", "b"],), (["b"],), ([],)], "l ARRAY<STRING>")
    assert rows(sets.distinct_items(lists, "l")) == [("a",), ("b",)]
    many = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    s1 = rows(sets.repeatable_sample(many, 50, "id"))
    assert len(s1) == 50 and s1 == rows(sets.repeatable_sample(many.repartition(7), 50, "id"))
    assert s1 != rows(sets.repeatable_sample(many, 50, "id", seed=7))


def test_head_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    head = sets.head_per_group(df, "g", 3, F.col("id").asc())
    assert rows(head.select("g", "id")) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_functions(spark):
    def one(column, value, schema="x STRING"):
        return spark.createDataFrame([(value,)], schema).select(column).first()[0]

    x = F.col("x")
    assert one(fn.slug(x), "Simon & Garfunkel's Größe!") == "Simon_and_Garfunkels_Größe"
    assert one(fn.seed_name(x), "similar_to_Daft_Punk.csv") == "Daft Punk"
    assert [one(fn.item_count(x), v) for v in ("a;b", "a;;b", "", "  ", None)] == [2, 3, 0, 0, 0]
    assert [one(fn.start_year(x), v) for v in ("1960", "1985-06-21", "Unknown", "", None)] == [1960, 1985, None, None, None]
    assert one(fn.decade_label(fn.decade(x)), "1985-06-21") == "1980s"
    assert one(fn.parse_count(x), " 18,899,717 ") == 18899717 and one(fn.parse_count(x), "x") is None
    assert one(fn.short_id(x), "0123456789") == "01234567..." and one(fn.clip_name(x, 3), "abcdef") == "abc"
    assert one(fn.normalise_name(x), " The   AC/DC! ") == "the ac dc"
    pair = "x ARRAY<STRING>"
    assert one(fn.names_or_none(x), [], pair) == "None" and one(fn.names_or_none(x, 2), ["a", "b", "c"], pair) == "a, b"
    both = spark.createDataFrame([(["a", "b"], ["b", "c", "d"]), (["a"], []), (["a"], None)], "a ARRAY<STRING>, b ARRAY<STRING>")
    assert [r[0] for r in both.select(fn.overlap_percent(F.col("a"), F.col("b"))).collect()] == [50.0, 0.0, 0.0]
    nums = spark.createDataFrame([(1, 0), (1, 4)], "p LONG, w LONG")
    assert [r[0] for r in nums.select(fn.percent(F.col("p"), F.col("w"))).collect()] == [0.0, 25.0]


def test_diversity(spark):
    meta = spark.createDataFrame(
        [
            ("1", "A", "US", ["rock", ""], "1960"),
            ("2", "B", None, ["rock", "pop"], "1985-06-21"),
            ("3", "C", "Unknown", [], "Unknown"),
            ("4", "D", "GB", ["jazz"], None),
        ],
        "artist_mbid STRING, name STRING, country STRING, genres ARRAY<STRING>, start_date STRING",
    )
    best = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("5",)], "artist_id STRING")
    e = diversity.enrich_artists(best, meta)
    assert e.filter("artist_id = '5'").first()["name"] == "Unknown Artist"
    assert rows(diversity.country_distribution(e)) == [("GB", 1), ("US", 1)]
    assert rows(diversity.genre_distribution(e)) == [("jazz", 1), ("pop", 1), ("rock", 2)]
    assert rows(diversity.decade_distribution(e)) == [(1960, 1, "1960s"), (1980, 1, "1980s")]
    nine = spark.createDataFrame([(f"c{i}", 10 - i) for i in range(9)], "country STRING, n LONG")
    chart = {r["country"]: r["label"] for r in diversity.country_chart(nine).collect()}
    assert len(chart) == 8 and chart["Other"] == "Other (5)"
    assert diversity.country_chart(nine.limit(8)).filter("country = 'Other'").count() == 0


def test_comparison(spark):
    recs = spark.createDataFrame(
        [("A", r, f"i{r}", f"N{r}" if r != 4 else None, 1.0) for r in range(1, 15)] + [("B", 2, "j", "X", 1.0)],
        "source_artist STRING, rank INT, artist_id STRING, artist_name STRING, similarity_score DOUBLE",
    )
    outside = spark.createDataFrame([("A", ["N2", "N3", "Q", "N13"])], "artist_name STRING, similar ARRAY<STRING>")
    got = {r["artist_name"]: r for r in compare.compare_lists(compare.model_lists(recs), outside).collect()}
    a = got["A"]
    assert a["model_recommendations"][:3] == ["N2", "N3", "Unknown Artist (i4)"] and len(a["model_recommendations"]) == 10
    assert a["overlap"] == ["N2", "N3"] and a["overlap_percentage"] == 50.0 and a["common_names"] == "N2, N3"
    assert got["B"]["overlap_percentage"] == 0.0 and got["B"]["common_names"] == "None"
