"""The stage profile job, its sketches, and redirect ends against walks one by one."""

import random

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from tonearm.operators import redirect_ends as ends
from tonearm.plans import stage_profile


def walked(links, start):
    path = [start]
    while path[-1] in links and len(set(path)) == len(path):
        path.append(links[path[-1]])
    if len(set(path)) == len(path):
        return start, path[-1], len(path) - 1, "terminal", None
    return start, path[-1], len(path) - 1, "circular", min(path[path.index(path[-1]) :])


def random_links(seed, n, loose):
    rnd = random.Random(seed)
    return {f"r{i:03}": f"r{rnd.randrange(n):03}" for i in range(n) if rnd.random() > loose}


LONG = {f"r{i}": f"r{i + 1}" for i in range(70)}
RING = {f"c{i}": f"c{(i + 1) % 37}" for i in range(37)} | {f"t{i}": f"t{i + 1}" for i in range(19)} | {"t19": "c5"}
CASES = [LONG | RING, {"s": "s"}, {"a": "b", "b": "a", "c": "a", "d": "c", "x": "y"}, random_links(1, 200, 0.1), random_links(2, 300, 0.0), random_links(3, 300, 0.4), LONG]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_redirect_ends_against_walks(spark, case):
    links = CASES[case]
    df = spark.createDataFrame(list(links.items()), "recording_mbid string, canonical_recording_mbid string")
    assert rows(ends.redirect_ends(df)) == sorted((walked(links, s) for s in links), key=repr)


def test_redirects_without_rows_and_with_several_targets(spark):
    schema = "recording_mbid string, canonical_recording_mbid string"
    assert ends.redirect_ends(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "c"), ("b", None), (None, "x"), ("c", "d")], schema)
    assert rows(ends.redirect_ends(df)) == [("a", "d", 2, "terminal", None), ("c", "d", 1, "terminal", None)]
    assert rows(ends.ambiguous_sources(df)) == [("a", 2)]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(7)
    listens = [(None if rnd.random() < 0.02 else rnd.randrange(50), None if rnd.random() < 0.05 else f"s{rnd.randrange(400)}") for _ in range(5000)]
    make = spark.createDataFrame
    return {
        "listens": make(listens, "user_id long, recording_msid string"),
        "mapping": make([(f"s{i}", f"m{i % 300}" if i % 5 else None, "exact_match" if i % 5 else "no_match") for i in range(390)], "recording_msid string, recording_mbid string, match_type string"),
        "redirects": make([(f"m{i}", f"m{i + 1}") for i in range(0, 40)] + [("m60", "m61"), ("m61", "m60")], "recording_mbid string, canonical_recording_mbid string"),
        "canonical": make([(f"m{i}", "" if i % 7 == 0 else f"a{i % 20};b{i % 3}") for i in range(250)], "recording_mbid string, artist_mbids string"),
        "artists": make([(f"a{i}", f"Name {i % 15}") for i in range(20)], "artist_mbid string, name string"),
    }


def test_profile_job_writes_every_dataset(spark, tables, tmp_path):
    exact = stage_profile.write_stage_profile(tables, str(tmp_path / "exact"))
    loose = stage_profile.write_stage_profile(tables, str(tmp_path / "loose"), exact=False)
    assert set(exact) == {*stage_profile.DATASETS, "retention", "losses"} and set(loose) == {*exact, "column_sketches"}
    data = [tuple(r) for r in tables["listens"].collect()]
    columns = {(r["table"], r["column_name"]): r for r in spark.read.parquet(exact["columns"]).collect()}
    users = columns["listens", "user_id"]
    assert (users["rows"], users["nulls"], users["distinct_values"]) == (5000, sum(u is None for u, _ in data), len({u for u, _ in data} - {None}))
    for r in spark.read.parquet(loose["columns"]).collect():
        true = columns[r["table"], r["column_name"]]
        assert (r["rows"], r["nulls"]) == (true["rows"], true["nulls"]) and r["distinct_values"] == pytest.approx(true["distinct_values"], rel=0.03)
    known = sorted(u for u, _ in data if u is not None)
    assert loose and abs(next(r["median"] for r in spark.read.parquet(loose["columns"]).collect() if r["column_name"] == "user_id") - known[len(known) // 2]) <= 2
    pairs = {r["key"]: r for r in spark.read.parquet(exact["duplicates"]).collect()}
    seen = {p: data.count(p) for p in set(data)}
    assert pairs["user_id,recording_msid"]["duplicate_rows"] == sum(n for n in seen.values() if n > 1)
    assert pairs["name"]["duplicate_rows"] == 10 and pairs["name"]["extra_rows"] == 5
    (redirects,) = spark.read.parquet(exact["redirects"]).collect()
    assert (redirects["longest_chain"], redirects["circular_sources"], redirects["ambiguous_sources"]) == (40, 2, 0)
    for name in ("spreads", "shares", "coverage", "canonicalisation", "flow", "top_keys", "retention", "losses"):
        assert rows(spark.read.parquet(exact[name])) == rows(spark.read.parquet(loose[name])) != []


def test_sketches_of_months_merge_to_those_of_the_whole(spark, tables):
    df = tables["listens"].withColumn("month", F.pmod(F.xxhash64("user_id", "recording_msid"), F.lit(3)))
    parts = [stage_profile.column_sketches(df.filter(F.col("month") == m).drop("month"), "listens") for m in range(3)]
    merged = {r["column_name"]: r for r in stage_profile.sketched_columns(stage_profile.merged_sketches(*parts)).collect()}
    whole = {r["column_name"]: r for r in stage_profile.sketched_columns(stage_profile.column_sketches(df.drop("month"), "listens")).collect()}
    for name, r in whole.items():
        assert (merged[name]["rows"], merged[name]["nulls"]) == (r["rows"], r["nulls"]) and merged[name]["distinct_values"] == pytest.approx(r["distinct_values"], rel=0.02)
    assert merged["recording_msid"]["median"] is None and abs(merged["user_id"]["median"] - whole["user_id"]["median"]) <= 2


def test_empty_tables_have_a_profile(spark, tables):
    made = stage_profile.StageProfile(**{n: df.limit(0) for n, df in tables.items()})
    assert all(r["rows"] == 0 and r["nulls"] == 0 and r["distinct_values"] == 0 for r in made.columns().collect())
    assert all(r["distinct_values"] == 0 and r["median"] is None for r in stage_profile.sketched_columns(made.column_sketches()).collect())
    assert all(r["duplicate_rows"] == 0 for r in made.duplicates().collect())
    assert [(r["longest_chain"], r["circular_sources"]) for r in made.redirects().collect()] == [(0, 0)]
    assert made.shares().count() == 0 and made.top_keys().count() == 0
