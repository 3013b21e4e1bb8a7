"""Phrase mining, decontamination and the Merkle manifest against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonearm.llm import collocations, decontaminate, merkle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "the quick"), (1, "the quick"), (2, "A b c d e f g"), (3, None), (4, ""), (None, "fox"), (5, "word1 and1 word2 and2 word3 and3 word4 and4 word5 and5 word6 and6"),
    (6, "one two three four five six"), (7, "École"), (8, "two two two two two two two two two two two"),
]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def same(df, want):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def plain_phrases(rows, min_count, longest, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        scored = []
        for p, a in frequent.items():
            if 100 * longer[p] < 100 * a:
                score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


def plain_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(low(text))
        for s in range(max(len(words) - 10, 0) + 1 if words else 0):
            windows[tuple(words[s : s + 10])].add("" if item is None else str(item))
    for doc_id, text in docs:
        words, hit, found = WORD.findall(low(text)), set(), set()
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                if (run := tuple(words[s : s + size])) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[run]
        yield doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def plain_manifest(rows):
    def leaf(row):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(s, min(s + 8, len(nodes))) for s in range(0, len(nodes), 8)]
            for run in runs:
                for k in run:
                    for i in under[k]:
                        paths[i].append(("".join(nodes[run[0] : k]), "".join(nodes[k + 1 : run[-1] + 1])))
            nodes, under = [sha(*(nodes[k] for k in run)) for run in runs], [[i for k in run for i in under[k]] for run in runs]
        return nodes[0], paths

    langs = defaultdict(list)
    for row in rows:
        langs[row[2]].append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in langs[lang]]) for lang in order]
    if not trees:
        return
    root, ways = tree([top for top, _ in trees])
    for lang, (top, paths), way in zip(order, trees, ways):
        for row, path in zip(langs[lang], paths):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            fold = leaf((*row[:4], None if row[4] is None else low(row[4]))) if changed else leaf(row)
            for left, right in path + way:
                fold = sha(left, fold, right)
            yield row[0], leaf(row), top, root, sha(*(side for step in path + way for side in step)), fold, fold == root


@pytest.mark.parametrize("min_count, longest, top", [(2, 5, 10), (1, 3, 2000), (3, 2, 3)])
def test_phrases(spark, odd_docs, min_count, longest, top):
    more = [("a b a b. a b c; a a a a", None), ("A B\tc  d\x0be f", "und"), (" . ,", "x"), ("a b c d e f g a b c d e f g", "")] * 3
    docs = odd_docs.select("text", "lang").unionByName(spark.createDataFrame(more, "text string, lang string")).select("*", F.lit("a clash").alias("Text"))
    same(collocations.collocations(docs, min_count, longest, top), plain_phrases([(r[0], r[1]) for r in docs.collect()], min_count, longest, top))


def test_phrase_occurrences_are_not_written(spark, monkeypatch):
    written, staged = {}, collocations.staged

    def counted(df, name):
        out = staged(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(collocations, "staged", counted)
    docs = spark.createDataFrame([("one two three, four five six seven", "en")] * 50, "text string, lang string")
    collocations.collocations(docs, 3).collect()
    assert sum(written.values()) <= 7 + 5 + 3 + 1 + 1  # words, pairs, three and four words, the language; not 350 words


def test_phrases_of_large_texts(spark):
    """Texts beyond the bytes that are worked on at once, with null and empty ones between them."""
    rows = [(t, lang) for i in range(4) for t, lang in (("Ab ba, ab\tBA ab ba é\x01e " * (i * 20_000), "x"), (None, "y"), ("", None), ("ba ab. ba ab ab" + " ab" * i, None))]
    assert sum(len(t or "") for t, _ in rows) > 2 * collocations.CHUNK
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    same(collocations.collocations(docs, 4, 3, 50), plain_phrases(rows, 4, 3, 50))


def test_phrases_are_told_by_words_not_hashes(spark):
    """Bit tables that let every phrase through change no count."""
    rows = [("a b a. b A", "x"), ("b a b", "y"), ("a b", "x")]
    every = spark.sparkContext.broadcast([np.full(collocations.FILTER_WORDS, 2**64 - 1, np.uint64)] * 2)
    found = collocations.likely_phrases(spark.createDataFrame([(lang, t) for t, lang in rows], "lang string, text string"), every, 2)
    want = [("x", 0, "", 7), ("y", 0, "", 3), ("x", 1, "a", 4), ("x", 1, "b", 3), ("y", 1, "a", 1), ("y", 1, "b", 2), ("x", 2, "a b", 2), ("x", 2, "b a", 2), ("y", 2, "b a", 1), ("y", 2, "a b", 1)]
    same(found.groupBy("lang", "size", "phrase").agg(F.sum("a")), want)


def test_phrase_scores_pass_64_bits(spark):
    counts = spark.createDataFrame([("x", "a", 1, 10**12), ("x", "b", 1, 10**11), ("x", "a b", 2, 10**11 - 1)], "lang string, phrase string, size int, a long")
    totals = spark.createDataFrame([("x", 10**13 + 7)], "lang string, n long")
    (row,) = collocations.least_cut(counts, totals).collect()
    assert row.score == 1000 * (10**11 - 1) * (10**13 + 7) // (10**12 * 10**11)


def test_contamination(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id int, text string").select("*", F.lit("a clash").alias("TEXT"))
    more = spark.createDataFrame([(20, "x THE quick, quick the quick"), (21, "a b c d e f g h a b c d e f"), (22, "two " * 23), (22, "two " * 9), (23, "word1 and1 word2 and2 word3 x and3 word4 and4 word5 and5")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    rows = [tuple(r) for r in docs.collect()]
    for some in (items, items.where("item_id = 5"), items.where("item_id = 8 or item_id = 2"), items.limit(0)):
        same(decontaminate.contamination(docs, some), plain_contamination(rows, [(r[0], r[1]) for r in some.collect()]))


def test_contamination_filter_may_let_all_through(spark, odd_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    monkeypatch.setattr(decontaminate, "BITS", 64)  # one cell: nearly everything passes and is sorted out later
    same(decontaminate.contamination(odd_docs, items), plain_contamination([(r.doc_id, r.text) for r in odd_docs.collect()], ITEMS))


def test_manifest(spark, odd_docs):
    docs = odd_docs.select("*", F.lit("a clash").alias("LANG"))
    rows = [(r["doc_id"], r["source"], None, r["n_chars"], r["text"]) for r in odd_docs.collect()]
    same(merkle.verified_manifest(docs), plain_manifest(rows))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 9, "": 65}, {"b": 513, "ä": 1, "c": 4100}, {f"l{i:02}": 1 + i % 3 for i in range(70)}])
def test_manifest_of_many_shapes(spark, sizes):
    rows = [(i // 2, f"s{i % 3}", lang, i, f"Text {i}") for lang, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same(merkle.verified_manifest(docs), plain_manifest(rows))


def test_manifest_path_proves_membership(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in merkle.manifest(docs).limit(50).collect():
        own = r.leaf
        for step in r.path:
            own = sha(step.l, own, step.r)
        assert own == r.root


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert collocations.collocations(no_docs).count() == 0
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert merkle.verified_manifest(no_docs).count() == 0


def test_decontamination_stays_in_the_jvm(spark):
    docs, items = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
