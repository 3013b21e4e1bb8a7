"""Recommender, segments, graph, search: properties and brute force."""

import math
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from tonearm import functions as fn
from tonearm.operators import communities, few_items, graph, recommend, search, segments
from tonearm.plans import jobs
from tonearm.schemas import COUNTS
from tonearm.session import arrow_batches_of
from tonearm.sources import sinks


@pytest.fixture(scope="module")
def blocks(spark):
    """Two groups of users that share no artist."""
    rnd = random.Random(3)
    data = [(u, f"{'ab'[u % 2]}{i}", rnd.randint(1, 40)) for u in range(40) for i in range(8) if rnd.random() < 0.8]
    return spark.createDataFrame(data, COUNTS)


def test_bm25(spark, blocks):
    data = [tuple(r) for r in blocks.collect()]
    users = {u for u, _, _ in data}
    length = {u: sum(c for v, _, c in data if v == u) for u in users}
    df = {a: sum(1 for _, b, _ in data if b == a) for _, a, _ in data}
    avg = sum(length.values()) / len(users)
    got = {(r[0], r[1]): r[2] for r in rows(recommend.bm25_weights(blocks))}
    for u, a, c in data:
        want = c * 101 / (100 * (0.2 + 0.8 * length[u] / avg) + c) * (math.log(len(users)) - math.log1p(df[a]))
        assert got[(u, a)] == pytest.approx(want)


def test_item_of_every_user_has_a_negative_weight(spark):
    df = spark.createDataFrame([(u, "x", 3) for u in range(5)] + [(0, "y", 1)], COUNTS)
    w = {(r[0], r[1]): r[2] for r in rows(recommend.bm25_weights(df))}
    assert w[(0, "x")] < 0 < w[(0, "y")]


def test_users_without_a_positive_weight(spark):
    """Every user plays x, some only x: those users and x end up at zero, the fit does not fail."""
    data = [(u, "x", 5) for u in range(12)] + [(u, f"y{u % 3}", 4) for u in range(8)] + [(u, f"y{(u + 1) % 3}", 2) for u in range(4)]
    counts = spark.createDataFrame(data, COUNTS)
    artists, users = recommend.dense_index(counts, "artist_id", "item_idx"), recommend.dense_index(counts, "user_id", "user_idx")
    entries = recommend.bm25_weights(counts).join(artists, "artist_id").join(users, "user_id")
    model = recommend.train_model(entries, factors=16, iterations=3)
    got = {r["artist_id"]: r["features"] for r in recommend.artist_factors(model, artists).collect()}
    assert set(got) == {"x", "y0", "y1", "y2"} and all(len(v) == 16 for v in got.values())
    assert got["x"] == [0.0] * 16 and any(got["y0"])
    assert recommend.training_loss(model, entries).first()["entries"] == len(data)


def test_many_users_for_few_items_take_few_item_blocks(spark, monkeypatch):
    """A user's factors go to every item block; fewer item blocks change the layout, not the factors."""
    assert recommend.item_blocks(5_400_000, 371, 12) == 2 and recommend.item_blocks(1000, 500, 12) == 6
    assert recommend.item_blocks(100, 9000, 12) == 12 and recommend.item_blocks(900, 3, 1) == 1 and recommend.item_blocks(0, 0, 4) == 2
    rnd = random.Random(5)
    entries = spark.createDataFrame([(u, i, rnd.random() + 0.1) for u in range(400) for i in range(12) if rnd.random() < 0.6], "user_idx long, item_idx long, weight double")
    made, als = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **given: made.append(given) or als(**given))
    few = recommend.train_model(entries, factors=4, iterations=3, blocks=6)
    wide = recommend.train_model(entries, factors=4, iterations=3, blocks=6, least_item_blocks=6)
    assert [(m["numUserBlocks"], m["numItemBlocks"]) for m in made] == [(6, 2), (6, 6)]
    for a, b in ((few.itemFactors, wide.itemFactors), (few.userFactors, wide.userFactors)):
        a, b = ({r["id"]: list(r["features"]) for r in f.collect()} for f in (a, b))
        assert set(a) == set(b) and all(a[k] == pytest.approx(b[k], abs=1e-4) for k in a)


@pytest.mark.parametrize("regularisation,block,batch", [(0.05, 1 << 17, 10_000), (0.0, 50, 20)])
def test_few_items_are_fitted_without_sending_factors(spark, monkeypatch, regularisation, block, batch):
    """MLlib gives the first factors only, and the factors are those of its own rounds; ratings may repeat, be null or not positive."""
    rnd = random.Random(8)
    data = [(u, i, rnd.random() * 5 - 0.5) for u in range(300) for i in range(30) if rnd.random() < (0.8 if u % 9 == 0 else 0.15)]
    data += [*data[:40], (900, 77, -1.0), (7, 78, -2.0), (901, 3, 0.0), (None, 3, 2.0), (5, None, 2.0), (902, 4, 1e-3)]
    entries = spark.createDataFrame(data, "user_idx long, item_idx long, weight double")
    assert few_items.fits(2048, 64) and not few_items.fits(2049, 64) and not few_items.fits(0, 64)
    monkeypatch.setattr(few_items, "BLOCK_RATINGS", block)
    rounds, fit = [], recommend.ALS._fit
    monkeypatch.setattr(recommend.ALS, "_fit", lambda self, df: rounds.append(self.getMaxIter()) or fit(self, df))
    with arrow_batches_of(spark, batch):
        new = recommend.train_model(entries, factors=8, iterations=3, blocks=5, regularisation=regularisation)
    assert rounds == [0, 0], "the rounds are not MLlib's"
    monkeypatch.setattr(few_items, "SYSTEMS_BYTES", 0)
    old = recommend.train_model(entries, factors=8, iterations=3, blocks=5, regularisation=regularisation)
    assert rounds == [0, 0, 3] and new.rank == old.rank == 8
    for a, b in ((new.itemFactors, old.itemFactors), (new.userFactors, old.userFactors)):
        a, b = ({r["id"]: list(r["features"]) for r in f.collect()} for f in (a, b))
        assert set(a) == set(b) and all(a[k] == pytest.approx(b[k], abs=1e-5) for k in a)
    assert {901, 900}.isdisjoint(r["id"] for r in new.userFactors.collect())


def test_ratings_that_are_no_numbers_are_an_error(spark):
    entries = spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0), (1, 0, float("nan"))], "user_idx long, item_idx long, weight double")
    with pytest.raises(Exception, match="NaN|Infinity|ratings"):
        recommend.train_model(entries, factors=2, iterations=1, blocks=2)


def test_model_recovers_blocks_and_is_saved(spark, blocks, tmp_path):
    root = str(tmp_path)
    model, index = jobs.model_for(spark, blocks, root, factors=8, iterations=8)
    names = spark.createDataFrame([(f"a{i}", f"Name {i}") for i in range(8)], "artist_mbid STRING, name STRING")
    recs = jobs.recommendations_for(spark, blocks, model, index, names, ["a0", "b1", "unknown"], n=8)
    got = {}
    for r in recs.orderBy("source_artist_id", "rank").collect():
        got.setdefault(r["source_artist_id"], []).append(r)
    assert set(got) == {"a0", "b1"}
    for seed, found in got.items():
        assert found[0]["artist_id"] == seed and found[0]["similarity_score"] == pytest.approx(1.0)
        scores = [r["similarity_score"] for r in found]
        assert scores == sorted(scores, reverse=True) and all(-1.000001 <= s <= 1.000001 for s in scores)
        assert {r["artist_id"][0] for r in found} == {seed[0]}
        assert [r["rank"] for r in found] == list(range(1, 9))
    assert got["a0"][0]["artist_name"] == "Name 0" and got["b1"][0]["artist_name"] == "Unknown Artist"
    again = sinks.load_model(spark, root, jobs.model_key(blocks, factors=8, iterations=8))
    assert again is not None and rows(again[1]) == rows(index)
    assert sinks.load_model(spark, root, "other") is None
    other, _ = jobs.model_for(spark, blocks, root, factors=3, iterations=1)
    assert other.rank == 3, "other parameters are another model"
    entries = recommend.bm25_weights(blocks).join(again[1], "artist_id").join(again[2], "user_id")
    assert recommend.training_loss(model, entries).first()["loss"] < 0.5


@pytest.mark.parametrize("seeds_per_block,items_per_block", [(1000, 1000), (2, 7)])
def test_similar_items_brute_force(spark, seeds_per_block, items_per_block):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(60, 5))
    m[10] = m[3]  # equal scores are ordered by id
    m[11] = 0.0  # no direction: similarity 0
    vec = spark.createDataFrame([(f"v{i:02d}", [float(x) for x in row]) for i, row in enumerate(m)], "id STRING, features ARRAY<DOUBLE>")
    seeds = vec.filter("id in ('v00', 'v03', 'v07', 'v20', 'v41')").select(F.col("id").alias("seed_id"), "features")
    items = vec.select(F.col("id").alias("item_id"), "features").repartition(4)
    got = recommend.similar_items(seeds, items, 6, seeds_per_block, items_per_block).collect()
    unit = m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    for s in (0, 3, 7, 20, 41):
        want = sorted(((-round(float(unit[s] @ unit[i]), 12), f"v{i:02d}") for i in range(60)))[:6]
        mine = sorted((r["rank"], r["item_id"], r["score"]) for r in got if r["seed_id"] == f"v{s:02d}")
        assert [x[1] for x in mine] == [w[1] for w in want]
        assert [x[2] for x in mine] == pytest.approx([-w[0] for w in want])


def test_seed_selection(spark, blocks):
    wanted = spark.createDataFrame([("a1",), ("nope",), ("a1",)], "artist_id STRING")
    assert rows(recommend.select_seeds(blocks, wanted)) == [("a1",)]
    nothing = spark.createDataFrame([("nope",)], "artist_id STRING")
    popular = recommend.select_seeds(blocks, nothing, ["b0", "zz"], n=3)
    top = {r["artist_id"] for r in recommend.popular_artists(blocks, 3).collect()}
    assert {r[0] for r in rows(popular)} == top | {"b0"}
    found, missing = recommend.find_artists(wanted, blocks)
    assert rows(found) == [("a1",)] and rows(missing) == [("nope",)]


def test_segments(spark):
    rnd = random.Random(5)
    data = []
    for u in range(60):
        kind = u % 3  # few artists, few artists with many plays, many artists
        for i in range([7, 8, 60][kind]):
            data.append((u, f"a{i}", [rnd.randint(1, 4), rnd.randint(180, 220), rnd.randint(1, 4)][kind]))
    data += [(100, f"a{i}", 1) for i in range(5)]  # five artists are not enough
    counts = spark.createDataFrame(data, COUNTS)
    features = segments.user_features(counts)
    assert features.count() == 60
    clustered = segments.cluster_users(features, restarts=4)
    stats = segments.name_segments(segments.cluster_statistics(clustered))
    got = {r["name"]: r for r in stats.collect()}
    assert {n: r["user_count"] for n, r in got.items()} == {"Casual Listeners": 20, "Power Users": 20, "Explorers": 20}
    assert got["Power Users"]["avg_listens_per_artist"] > 150 and got["Explorers"]["avg_artists"] == 60
    assert got["Casual Listeners"]["example_users"] == [0, 3, 6, 9, 12]
    assert segments.chart_points(clustered).count() == 60 and segments.segment_centroids(clustered).count() == 3
    assert segments.cluster_users(features.limit(9)) is None


def _walk(redirects, start, cap=10):
    """Follow redirects one by one."""
    path, current = [start], redirects[start]
    while True:
        if current in path:
            return path + [current], "circular"
        path.append(current)
        if len(path) > cap + 1:
            return path, "cut"
        if current not in redirects:
            return path, "terminal"
        current = redirects[current]


def test_redirect_chains_against_a_walk(spark):
    r = {"one": "end", "two": "one", "self": "self", "x": "y", "y": "x", "tail": "x"}
    r |= {f"c{i}": f"c{i + 1}" for i in range(14)}  # 14 links
    r |= {f"k{i}": f"k{(i + 1) % 11}" for i in range(11)}  # a ring of 11
    r |= {f"l{i}": f"l{(i + 1) % 12}" for i in range(12)}  # a ring of 12
    df = spark.createDataFrame(list(r.items()), "recording_mbid STRING, canonical_recording_mbid STRING")
    got = {x["recording_mbid"]: (x["path"], x["status"]) for x in graph.redirect_walks(df).collect()}
    assert got == {s: _walk(r, s) for s in r}
    text = {x["recording_mbid"]: x["chain"] for x in graph.resolve_redirect_chains(df).collect()}
    assert text["two"] == "two -> one -> end" and text["self"] == "self -> self (circular reference) -> self"
    assert text["c0"].endswith("c10 -> ... -> c11")


def test_edges_and_degrees(spark):
    recs = spark.createDataFrame(
        [("s", r, f"t{r}", 1.0 / r) for r in range(1, 9)] + [("t2", 1, "t2", 1.0), ("t2", 2, "s", 0.9)],
        "source_artist_id STRING, rank INT, artist_id STRING, similarity_score DOUBLE",
    )
    e = graph.undirected(graph.edge_list(recs))
    assert rows(e)[0] == ("s", "t2", 0.9) and e.count() == 5
    deg = {r["node"]: r for r in graph.degrees(e).collect()}
    assert deg["s"]["degree"] == 5 and deg["s"]["node_size"] == 150 and deg["s"]["colour"] == 1.0 and deg["t3"]["colour"] == 0.2
    names = spark.createDataFrame([("x", "X")], "artist_mbid STRING, name STRING")
    assert rows(graph.labelled_nodes(graph.degrees(e), names)) == [("s", 5, "Unknown (s)")]


def test_restarts_together_cost_no_more_than_apart(spark):
    """Ten runs advanced in one scan a round, against ten fits of the library's k-means from as many seeds."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(4)
    data = np.concatenate([rng.normal(c, s, size=(n, 5)) for c, s, n in ((0, 1, 120), (6, 2, 80), (-5, 1, 60), (12, 0.5, 9))])
    names = [f"x{i}" for i in range(5)]
    points = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(data)], ["user_id", *names]).repartition(4)
    centres, cost = segments.fit_centres(points, 3, range(42, 52), 300)
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(points).cache()
    apart = min(KMeans(k=3, seed=s, featuresCol="v", maxIter=300, tol=1e-4).fit(vectors).summary.trainingCost for s in range(42, 52))
    assert cost <= apart * 1.0001
    far = ((data[:, None, :] - np.array(centres)[None]) ** 2).sum(2)
    assert cost == pytest.approx(far.min(1).sum(), rel=1e-6)
    assert [r["cluster"] for r in segments.assign(points, centres).orderBy("user_id").collect()] == far.argmin(1).tolist()
    same = spark.createDataFrame([(i, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(12)], ["user_id", *names])
    assert segments.fit_centres(same, 3, range(2), 300)[1] == 0.0


def test_communities_of_two_cliques(spark):
    left, right = "abcd", "wxyz"
    edges = [(p[i], p[j], 1.0) for p in (left, right) for i in range(4) for j in range(i + 1, 4)] + [("d", "w", 0.5)]
    df = spark.createDataFrame(edges, "src STRING, dst STRING, weight DOUBLE")
    groups = {r["node"]: r["community"] for r in communities.detect_communities(df).collect()}
    assert groups == {**{n: "a" for n in left}, **{n: "w" for n in right}}
    part = spark.createDataFrame(list(groups.items()), "node STRING, community STRING")
    m = 12.5
    want = 2 * (12 / (2 * m) - (12.5 / (2 * m)) ** 2)
    assert communities.modularity(df, part).first()["modularity"] == pytest.approx(want)
    assert communities.detect_communities(df.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("measure, threshold", [("matching", 0.7), ("matching", 0.85), ("levenshtein", 0.6), ("levenshtein", 0.75), ("levenshtein", 0.85)])
def test_similar_pairs_against_all_pairs(spark, measure, threshold):
    rnd = random.Random(11)
    base = ["the silver band", "silver bands", "queen", "queens", "radio head", "radiohead", "ab", "abc", "a", "b", "mötley crüe", "motley crue"]
    words = base + ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(2, 9))).strip() for _ in range(150)]
    values = sorted({w for w in words if w})
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "name STRING")
    got = {(r[0], r[1]): r[2] for r in rows(search.similar_pairs(df, "name", threshold, None, measure))}
    want = {}
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            s = SequenceMatcher(None, a, b).ratio() if measure == "matching" else 1 - edits(a, b) / max(len(a), len(b))
            if threshold <= s < 1:
                want[(a, b)] = s
    assert got == pytest.approx(want)


def test_similar_pairs_sample(spark):
    df = spark.createDataFrame([(f"name {i}",) for i in range(300)], "name STRING")
    small = search.similar_pairs(df, "name", sample_size=20)
    names = {r[0] for r in rows(small, "value1")} | {r[0] for r in rows(small, "value2")}
    assert len(names) <= 20
    with pytest.raises(ValueError):
        search.similar_pairs(df, "name", 0.5)


def test_split_pieces_lose_no_pair(spark):
    rnd = random.Random(12)
    names = sorted({f"the same start {rnd.choice('abc')}{rnd.choice('abc')}{rnd.randint(0, 40)}" for _ in range(150)})
    df = spark.createDataFrame([(n,) for n in names], "name STRING")
    whole = rows(search.candidate_pairs(df, "name", 0.85))
    assert whole == rows(search.candidate_pairs(df, "name", 0.85, split_at=7))
    assert {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if 1 - edits(a, b) / max(len(a), len(b)) >= 0.85} <= set(whole)


def test_candidates_are_few(spark):
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("bcdfghklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4)))
    names = list({f"{word()} {word()}" for _ in range(4000)})
    df = spark.createDataFrame([(n,) for n in names], "name STRING")
    every = len(names) * (len(names) - 1) / 2
    assert search.candidate_pairs(df, "name", 0.85).count() < 0.001 * every
    assert search.candidate_pairs(df, "name", 0.85, "matching").count() < 0.01 * every


def test_default_measure_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a name",)], "name STRING")
    plan = search.similar_pairs(df, "name")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan


def test_artist_search_against_all_names(spark):
    rnd = random.Random(14)
    plain = ["metallica", "björk", "sigur rós", "the beatles", "mötley crüe", "beyoncé", "ac dc", "straße", "o", "the the", "the"] + ["".join(rnd.choice("abco ") for _ in range(rnd.randint(1, 14))).strip() or "x" for _ in range(250)]
    names = [(f"id{i:03}", n.upper() if i % 2 else n) for i, n in enumerate(plain)] + [("id900", None), ("id901", " - "), ("id000", "metallica")]
    asked = ["Metalica", "Bjork", "sigur ros", "Beatles", "Motley Crue", "Beyonce", "AC/DC", "strasse", "The", "?", "", None] + ["".join(rnd.choice("abco ") for _ in range(rnd.randint(1, 14))) for _ in range(60)]
    a = spark.createDataFrame(names, "artist_mbid STRING, name STRING")
    q = spark.createDataFrame([(x,) for x in asked], "query STRING")
    folded = dict(a.select("name", fn.fold_name(F.col("name"))).collect())
    wanted = dict(q.select("query", fn.fold_name(F.col("query"))).collect())
    for least in (70, 80):
        got = {(r["query"], r["rank"]): (r["artist_mbid"], r["score"]) for r in search.search_artists(q, a, 5, least).collect()}
        want = {}
        for x in set(asked) - {None}:
            hits = {(-round(100 * (1 - edits(wanted[x], f) / max(len(f), len(wanted[x]))), 4), i) for i, n in names if n and (f := folded[n]) and wanted[x]}
            for rank, (score, i) in enumerate(sorted(h for h in hits if h[0] <= -least)[:5], 1):
                want[x, rank] = (i, -score)
        assert got == want
    assert {wanted[x] for x in ("Metalica", "Bjork", "Beatles")} == {"metalica", "bjork", "beatles"} and got["Metalica", 1][0] == "id000" and got["Bjork", 1][0] == "id001"
    with pytest.raises(ValueError):
        search.search_artists(q, a, min_score=60)


def test_frequent_trigrams_are_split(spark):
    """A trigram that every name holds makes no group of all names: a key holds the names of one length only."""
    names = [(f"id{i}", f"the {'x' * (i % 23)}{i}") for i in range(2300)]
    keys = search.name_index(spark.createDataFrame(names, "artist_mbid STRING, name STRING")).groupBy("gram", "size").count()
    assert keys.agg(F.max("count")).first()[0] <= 400


def test_artists_sharing_a_word(spark):
    artists = spark.createDataFrame(
        [(f"id{i}", n, "XX") for i, n in enumerate(["The Beatles", "Beatles Revival", "The The", "Beat", "BEATLES!"])],
        "artist_mbid STRING, name STRING, country STRING",
    )
    q = spark.createDataFrame([("beatles",), ("nobody here",)], "query STRING")
    got = search.artists_sharing_word(q, artists, 2).orderBy("rank").collect()
    assert [(r["name"], r["rank"]) for r in got] == [("BEATLES!", 1), ("The Beatles", 2)]
    assert got[0]["score"] == 100.0 and got[0]["country"] == "XX"


def test_redirect_chains_without_a_hop_limit_end_where_following_one_by_one_ends(spark):
    links = {f"r{i}": f"r{i + 1}" for i in range(40)} | {"a": "b", "b": "c", "c": "b", "s": "s", "q": "a"}
    df = spark.createDataFrame(list(links.items()), "recording_mbid string, canonical_recording_mbid string")
    want = {}
    for start in links:
        path = [start]
        while path[-1] in links and len(set(path)) == len(path):
            path.append(links[path[-1]])
        want[start] = (path, "circular" if len(set(path)) < len(path) else "terminal")
    got = {x["recording_mbid"]: (x["path"], x["status"]) for x in graph.redirect_walks(df, max_hops=None).collect()}
    assert got == want


def test_searches_rank_names_not_artists(spark):
    """A name that many artists share meets a query once; the order among its artists stays that of their ids."""
    plain = ["red bolt", "red bolts", "Red  Bolt!", "blue bolt", "red rod"]
    artists = spark.createDataFrame([(f"id{i:03}", plain[i % 5]) for i in range(400)] + [("id000", "red bolt")], "artist_mbid STRING, name STRING")
    q = spark.createDataFrame([("red bolt",), ("bolt",)], "query STRING")
    assert search.name_index(artists).filter("gram = '##r1'").select("folded", "names").orderBy("folded").collect() == [("red bolt", 161), ("red bolts", 80), ("red rod", 80)]
    found = search.search_artists(q, artists, 7).filter("query = 'red bolt'").orderBy("rank")
    assert [r["artist_mbid"] for r in found.collect()] == ["id000", "id002", "id005", "id007", "id010", "id012", "id015"], "a row listed twice counts once"
    words = search.artists_sharing_word(q, artists, 4)
    got = {(r["query"], r["rank"]): (r["artist_mbid"], r["score"]) for r in words.collect()}
    assert [got["red bolt", i] for i in (1, 2, 3, 4)] == [("id000", 100.0), ("id000", 100.0), ("id002", 100.0), ("id005", 100.0)]
    assert [got["bolt", i][0] for i in (1, 2, 3, 4)] == ["id000", "id000", "id002", "id005"]
