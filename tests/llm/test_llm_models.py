"""Classifiers, URL verdicts, neighbours, mixing and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonearm.llm import mixing, neighbours, quality, toxicity, url_filter

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held_out_auc(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("score", label).collect()
    y, s = np.array([r[label] for r in rows]), np.array([r.score for r in rows])
    return (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()


def test_quality_on_held_out_documents(docs, labels):
    model = quality.fit_quality(docs, labels)
    scored = quality.score_quality(docs, model)
    assert held_out_auc(scored, labels, "quality") > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in scored.collect())


def test_attention_gradient():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(12, quality.FEATURES)), np.array([0, 3, 4, 9]), np.array([0.0, 1, 1, 0])
    before = quality.Attention()
    loss = lambda m: -np.mean(y * np.log(m.forward(x, starts)["y"]) + (1 - y) * np.log(1 - m.forward(x, starts)["y"]))
    assert loss(quality.Attention().fit(x, starts, y)) < loss(before) / 5


def test_toxicity_on_held_out_documents(docs, labels):
    scored = toxicity.score_toxicity(docs, labels)
    assert held_out_auc(scored, labels, "toxic") > 0.7  # some forty toxic documents to learn from


def plain_grams(word):
    line = b"    " + word + b" "
    return [int.from_bytes(line[i : i + 5], "big") for i in range(len(word) + 1)]


@pytest.mark.parametrize("size", [8 << 20, 5000])
def test_every_expression_keeps_its_own_figure(spark, docs, monkeypatch, size):
    """What a batch is scored by are the exact ratios of its grams, contexts and words, or else the backoff figure."""
    monkeypatch.setattr(toxicity, "PACK_BYTES", size)
    monkeypatch.setattr(toxicity, "BATCH_BYTES", 3 * size)
    few = docs.where("doc_id % 20 = 0").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "x" * 33 + " b " + "x" * 5000)], "doc_id long, text string"))
    read = {r.doc_id: (r.text or "").encode().lower().split() for r in few.collect()}
    vocabulary = sorted({w for words in read.values() for w in words})
    seen = {g: (float(g % 1009) - 500, float(g % 997)) for w in vocabulary[::2] for g in plain_grams(w)}
    after = {g >> 8: (float((g >> 8) % 11), 1.0) for w in vocabulary[1::3] for g in plain_grams(w)}
    named = {w: (float(i % 101), 2.0) for i, w in enumerate(vocabulary) if i % 2 or len(w) > 30}
    by_gram, by_context = (spark.createDataFrame([(g, *v) for g, v in d.items()], "gram long, all double, fit double") for d in (seen, after))
    by_word = spark.createDataFrame([(bytearray(w), *v) for w, v in named.items()], "word binary, all double, fit double")
    table = toxicity.model_table(by_gram, by_context, by_word, "all")
    got = {r.doc_id: r for r in toxicity.featured(toxicity.texts_of(few), table, -7.0).collect()}
    assert len(got) == len(read) and (toxicity.packed(toxicity.texts_of(few)).select("batch").distinct().count() > 8) == (size == 5000)
    for doc_id, words in read.items():
        v = [[seen[g][0] if g in seen else after.get(g >> 8, (0.0,))[0] for g in plain_grams(w)] for w in words]
        own = [named.get(w, (-7.0,))[0] for w in words]
        top = sorted((sum(x) / len(x) for x in v), reverse=True)[:3]
        r = got[doc_id]
        assert r.f0 == pytest.approx(np.mean(sum(v, []))) and r.f1 == pytest.approx(top[0]) and r.f2 == pytest.approx(np.mean(top))
        assert r.f3 == pytest.approx(np.mean(own)) and r.f4 == max(own) and r.f5 == pytest.approx(np.mean(sorted(own)[-3:]))
        assert r.fold == zlib.crc32(str(doc_id).encode()) % 5
    other = toxicity.featured(toxicity.texts_of(few), toxicity.model_table(by_gram, by_context, by_word, "fit"), 3.0).collect()
    assert all(r.f5 in (2.0, 3.0) or 2.0 < r.f5 < 3.0 for r in other if read[r.doc_id])


def plain_kneser_ney(texts):
    """(figure of a gram, figure of a word) by the formulas, over (label, text): toxic less plain log-likelihood."""
    d, words = 0.75, {y: [w for label, t in texts if label == y for w in t.encode().lower().split()] for y in (0, 1)}
    counts = {y: Counter(g for w in words[y] for g in plain_grams(w)) for y in (0, 1)}
    spelt = {5: {g.to_bytes(5, "big") for y in (0, 1) for g in counts[y]}}
    for n in (4, 3, 2, 1):
        spelt[n] = Counter(g[1:] for g in spelt[n + 1])

    def shared(tail):
        if not tail:
            return 1 / 256
        follow = {g: n for g, n in spelt[len(tail)].items() if g[:-1] == tail[:-1]}
        return (max(follow.get(tail, 0) - d, 0) + d * len(follow) * shared(tail[1:])) / sum(follow.values())

    def gram(g):
        p = {}
        for y in (0, 1):
            follow = {h: n for h, n in counts[y].items() if h >> 8 == g >> 8}
            n = sum(follow.values())
            low = shared(g.to_bytes(5, "big")[1:])
            p[y] = (max(follow.get(g, 0) - d, 0) + d * len(follow) * low) / n if n else low
        return math.log(p[1] / p[0])

    def word(w):
        spread = Counter(v for _, t in texts for v in set(t.encode().lower().split()))
        p = {}
        for y in (0, 1):
            seen = Counter(words[y])
            p[y] = (max(seen[w] - d, 0) + d * len(seen) * spread[w] / sum(spread.values())) / len(words[y])
        return math.log(p[1] / p[0])

    return gram, word


def test_kneser_ney_figures_follow_the_formulas(spark):
    texts = [(1, "Awful awful rat goes"), (0, "a rat goes home"), (0, "she goes home and home"), (1, "rats awful"), (0, ""), (0, "awe at home")]
    counted = toxicity.word_counts(spark.createDataFrame([(y, 1 + i % 4, t) for i, (y, t) in enumerate(texts)], "label int, fold int, text string"))
    by_gram, by_context = toxicity.ratios(toxicity.gram_counts(counted))
    by_word, no_word = toxicity.word_ratios(counted)
    gram, word = plain_kneser_ney(texts)
    figures, vocabulary = {r.gram: r["all"] for r in by_gram.collect()}, {w for _, t in texts for w in t.lower().encode().split()}
    assert figures.keys() == {g for w in vocabulary for g in plain_grams(w)}
    assert all(v == pytest.approx(gram(g), abs=1e-9) for g, v in figures.items())
    words = {bytes(r.word): r["all"] for r in by_word.collect()}
    assert words.keys() == vocabulary and all(v == pytest.approx(word(w), abs=1e-9) for w, v in words.items())
    # a text whose fold calibrates counts in "all" and not in "fit"
    without = {bytes(r.word) for r in counted.where("toxic_fit + plain_fit = 0").collect()}
    assert without == {w for _, t in texts[3::4] for w in t.lower().encode().split()} - {w for i, (_, t) in enumerate(texts) if i % 4 != 3 for w in t.lower().encode().split()}
    assert by_context.count() == len({g >> 8 for g in figures}) and set(no_word) == {"all", "fit"}


def test_scores_of_odd_rows(odd_docs, no_docs, odd_labels):
    few = [quality.score_quality(odd_docs, quality.fit_quality(odd_docs, odd_labels)), toxicity.score_toxicity(odd_docs, odd_labels)]
    none = odd_labels.limit(0)
    few += [quality.score_quality(odd_docs, quality.fit_quality(odd_docs, none)), toxicity.score_toxicity(odd_docs, none)]
    for scored in few:
        rows = scored.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality.score_quality(no_docs, quality.fit_quality(no_docs, odd_labels)).count() == 0
    assert toxicity.score_toxicity(no_docs, odd_labels).count() == 0


URLS = [
    ("http://A.Example.NET/en/x?y=1#z", "a.example.net", "/en/x", "example.net/en/", "allow"), ("https://x.net", "x.net", "", None, None),
    ("https://x.net/", "x.net", "/", "net/", "block"), ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None),
    ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"), ("ftp://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("a://b://c.net/", "b:", "//c.net/", None, None), ("x://?q", "", "", None, None),
]


def test_url_rules(spark):
    frame = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(frame).collect()}
    assert len(got) == 2 * len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS * 2):
        assert got[i][:3] == (host, path, rule) and got[i][3] == verdict if verdict else got[i][3] in ("allow", "block")
    assert url_filter.judge_urls(frame.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(frame.where("url = 'no scheme'")).collect()} == {"allow"}


def test_neighbours_reach_recall_with_exact_scores(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = frame.collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    hit = total = 0
    for q in neighbours.search(frame).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("l")).collect():
        score = x @ x[ids == q.query_id][0]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q.query_id][:20]
        assert [n.rank for n in q.l] == list(range(1, 21))
        assert all(n.score == pytest.approx(score[ids == n.vec_id][0], abs=1e-12) for n in q.l)
        hit, total = hit + len({n.vec_id for n in q.l} & set(best)), total + 20
    assert total == 20 * sum(i % 20 == 0 for i in ids) and hit / total >= 0.9


def test_neighbours_of_odd_rows(spark):
    nan, one = float("nan"), [1.0, 0.0]
    rows = [(0, one), (20, one), (1, one), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, one), (40, [0.0, 0.0]), (1, one)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = sorted(tuple(r) for r in neighbours.search(frame).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 2, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0)]
    assert neighbours.search(frame.limit(0)).count() == 0


def test_mixture_keeps_all_and_meets_the_limit(docs):
    rows = mixing.mix_schedule(docs, limit=1.5).collect()
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len(r.text.split())
    read = {}
    for r in rows:
        read[r.source] = read.get(r.source, 0) + r.n_tokens
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
    p = np.array(sorted(v / sum(tokens.values()) for v in tokens.values()))
    exponent = max(0.0, 1 - math.log(1.5) / math.log(p[-1] / p[0]))
    for source, n in tokens.items():
        target = (n / sum(tokens.values()) / p[-1]) ** (exponent - 1)
        assert target * n - max(r.n_tokens for r in rows) <= read[source] <= target * n * (1 + 1e-3)


def test_mixture_to_an_entropy_and_a_budget(docs):
    weights = {r.source: r.weight for r in mixing.mix_schedule(docs, entropy=0.999, budget=1e5).collect()}
    every = mixing.plan(mixing.token_rows(docs), entropy=0.999, budget=1e5).collect()
    w = np.array([r.weight for r in every])
    assert w.sum() == pytest.approx(1) and -(w * np.log(w)).sum() >= 0.999 * math.log(len(w)) - 1e-4 and weights
    assert sum(r.n_tokens for r in mixing.mix_schedule(docs, budget=1e5).collect()) <= 1e5


def test_mixture_of_odd_rows(odd_docs, no_docs):
    assert mixing.mix_schedule(odd_docs).select("doc_id").distinct().count() == odd_docs.select("doc_id").distinct().count()
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.mix_schedule(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_pipeline_stages(spark, docs):
    columns = docs.columns
    left = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, left, SF)
        assert after.columns == columns, name
        left = spark.createDataFrame(after.collect(), docs.schema)
    assert {r.doc_id for r in left.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
    ids = corpus_pipeline.STAGES[4][1](spark, left, SF).collect()
    assert len(ids) == left.count() and all(r.n_tokens == len(r.ids) for r in ids)
