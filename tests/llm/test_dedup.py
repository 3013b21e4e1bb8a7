"""Fingerprints, SimHash groups and repeated strings against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tonearm.llm import fingerprint as fp, mixing, simhash, suffix_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_simhash(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest position reachable over pairs at most two bits apart."""
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_simhash_matches_brute_force(docs):
    rows = sorted(docs.select("doc_id", "text").collect())
    values = [plain_simhash(r.text) for r in rows]
    label = plain_components(values)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r.doc_id: (f"{v:016x}", rows[c].doc_id) for r, v, c in zip(rows, values, label)}


def test_small_shards_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64))
    values = np.unique(np.concatenate([base, near, near[:50] ^ np.uint64(3)]))
    frame = spark.createDataFrame([(int(v).to_bytes(8, "big"),) for v in values], "fp binary")
    at = {int(v): i for i, v in enumerate(values)}
    edges = [(at[int.from_bytes(r.a, "big")], at[int.from_bytes(r.b, "big")]) for r in simhash.shard_edges(frame, 2, shard_rows=16).collect()]
    got = simhash.local_components(len(values), *map(np.array, zip(*edges)))
    assert got.tolist() == plain_components([int(v) for v in values])


def test_simhash_of_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[3].component_id == 3 and by[11].component_id == -5
    assert by[None].component_id is None
    assert simhash.near_duplicates(no_docs).count() == 0


def copies_of(words, rng, times):
    """The words with a word or two replaced, several times."""
    for _ in range(times):
        out = list(words)
        for i in rng.integers(0, len(words), rng.integers(1, 3)):
            out[i] = f"x{rng.integers(0, 1 << 40)}"
        yield " ".join(out)


def test_one_near_copy_stays(spark, odd_docs, no_docs):
    rng = np.random.default_rng(2)
    texts = []
    for n in (300, 1500, 6000):
        words = [f"w{i}" for i in rng.integers(0, 1 << 40, n)]
        texts += [" ".join(words), *copies_of(words, rng, 12), " ".join(reversed(words))]
    order = rng.permutation(len(texts))
    rows = [(int(i), texts[at]) for i, at in enumerate(order)] + [(99, texts[0]), (100, ""), (101, None), (102, " \n")]
    label = plain_components([plain_simhash(t or "") for _, t in rows])
    want = [rows[i][0] for i in sorted(set(label))]
    kept = simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == want and len(want) < len(rows) - 20
    left = simhash.without_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[10] == 1 and ids[1] == 1 and ids[2] == 0 and ids[None] == 1
    assert simhash.without_near_copies(no_docs).count() == 0


def test_near_copies_of_shared_and_missing_ids(spark):
    """An id that several rows share neither drops an unlike text nor keeps a copy; copies without ids leave one."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "p"), (1, b, "q"), (1, b, "p"), (2, c, "p"), (3, a, "p"), (1, c, "p"), (None, b.upper(), "p"), (None, "other one", "q"), (None, "other one", "p")]
    kept = simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.source) for r in kept) == sorted([(1, a, "p"), (1, b, "p"), (1, c, "p"), (0, "other one", "p")])


def test_stages_take_columns_that_differ_by_case(odd_docs):
    clashing = odd_docs.withColumnsRenamed({"score": "DOC_ID", "fp": "Text", "n_tokens": "__digest"})
    for stage in (simhash.without_near_copies, suffix_dedup.without_repeats, mixing.mixed):
        after, plain = stage(clashing), stage(odd_docs)
        assert after.columns == clashing.columns
        assert Counter(map(tuple, after.collect())) == Counter(map(tuple, plain.collect()))


def test_changed_texts_by_both_ways(spark):
    """Texts that lose bytes, and those that are passed on unread, together are what a plain search leaves."""
    shared, rng = "shared passage " * 20, np.random.default_rng(5)
    own = [" ".join(f"u{x}" for x in rng.integers(0, 1 << 40, 30)) for _ in range(40)]
    texts = [t + (" " + shared if i % 3 == 0 else "") for i, t in enumerate(own)] + [own[1], own[2], None, ""]
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = plain_repeats(texts)
    assert len(got) == len(texts) and got[42] is None
    for i, (n_bytes, removed, *_) in enumerate(want):
        assert len((got[i] or "").encode()) == n_bytes - removed


def plain_kept(texts, length=200):
    """(remaining bytes, removed runs) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d) + 1, int)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                mark[k] += 1
                mark[k + length] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((bytes(np.frombuffer(d, np.uint8)[~gone]), spans))
    return out


def plain_repeats(texts, length=200):
    sizes = [len((t or "").encode()) for t in texts]
    return [(n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()) for n, (kept, spans) in zip(sizes, plain_kept(texts, length))]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2, 0.01])
def test_repeated_strings_match_brute_force(docs, hot):
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, hot=hot).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain_repeats([r.text for r in rows])))


def test_repeated_strings_of_odd_rows(odd_docs, no_docs):
    key = lambda i: (i is None, i or 0)
    rows = odd_docs.select("doc_id", "text").collect()
    got = sorted((key(r.doc_id), tuple(r)[1:]) for r in suffix_dedup.remove_repeats(odd_docs).collect())
    assert got == sorted(zip([key(r.doc_id) for r in rows], plain_repeats([r.text for r in rows])))
    changed = suffix_dedup.without_repeats(odd_docs)
    assert changed.columns == odd_docs.columns and changed.count() == odd_docs.count()
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_sort_finds_every_repeat():
    rng = np.random.default_rng(0)
    block = rng.integers(97, 99, 400, dtype=np.uint8)
    text = np.concatenate([block, rng.integers(97, 122, 300, dtype=np.uint8), block[50:350], np.full(260, 97, np.uint8)])
    starts = np.arange(len(text) - 199)
    raw = text.tobytes()
    seen = Counter(raw[i : i + 200] for i in starts)
    assert suffix_dedup.repeated(text, starts).tolist() == [seen[raw[i : i + 200]] > 1 for i in starts]
    assert {(a - b) % 31 for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(31))


def test_fingerprints_are_multisets(spark):
    rows = [(1, "a b c\nd e\nx"), (2, "x\na b c\nd e"), (3, "a b c\nx"), (4, "d e")]
    by = {r.doc_id: r.vector for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by[1] == by[2] != by[3]
    frame = spark.createDataFrame([(by[1], by[3], by[4])], "whole array<long>, part array<long>, one array<long>")
    r = frame.select(fp.inserted(F.col("part"), F.col("one")).alias("i"), fp.deleted(F.col("whole"), F.col("one")).alias("d")).first()
    assert r.i == by[1] and r.d == by[3]


@pytest.mark.parametrize("case", ["given", "odd"])
def test_edits_follow_descending_ids(case, docs, odd_docs, no_docs):
    frame = docs if case == "given" else odd_docs
    rows = sorted(((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        k = len(text) // 3
        edited = text[: len(text) - k] + rows[(i + 1) % len(rows)][1][:k]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = fp.with_edits(frame).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    if case == "given":
        assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95
    assert fp.with_edits(no_docs).count() == 0


def test_likeness_of_very_long_repetitive_texts(spark):
    """60,000 lines of two word pairs each; the edited text keeps 40,000 of them."""
    rows = [(2, "aa bb\n" * 60_000), (1, "x")]
    by = {r.doc_id: r for r in fp.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by[2].near_edited == pytest.approx(2 * 6 * 4 / (6 * 6 + 4 * 4), abs=1e-3) and by[2].near_next < 0.01
    long = fp.fingerprints(spark.createDataFrame([(1, "aa bb\n" * 59_999 + "aa bb"), (2, "aa bb\n" * 29_999 + "aa bb")], "doc_id long, text string"))
    a, b = (r.vector for r in long.orderBy("doc_id").collect())
    assert a[fp.EQUAL_LANES] == 120_000
    r = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(fp.inserted(F.col("b"), F.col("b")).alias("i"), fp.deleted(F.col("a"), F.col("b")).alias("d"), fp.unpacked(F.col("a")).alias("u")).first()
    assert r.i == a and r.d == b
    hashes = [spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in ("aa bb", "bb")]
    assert sorted(r.u) == sorted(60_000.0 * sum(1 if h >> k & 1 else -1 for h in hashes) for k in range(64))


def test_repeats_are_sought_in_small_batches(spark, monkeypatch):
    """Python gets at most a thousand rows at once while repeats are sought; the session's setting stays as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    sizes = lambda: spark.range(2500).coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    seen, write = [], suffix_dedup.staged
    monkeypatch.setattr(suffix_dedup, "staged", lambda df, name: seen.append([r.n for r in sizes().collect()]) or write(df, name))
    docs = spark.createDataFrame([(i, f"{i} " + "shared words " * 20) for i in range(3)], "doc_id long, text string")
    before = spark.conf.get(key, None)
    for run in (suffix_dedup.remove_repeats, suffix_dedup.without_repeats):
        seen.clear()
        assert run(docs).count() == 3
        assert len(seen) == 4 and all(sum(s) == 2500 and max(s) <= 1000 for s in seen)
        assert spark.conf.get(key, None) == before


def test_kept_texts_come_from_one_python_step(spark, monkeypatch):
    """A task has one Python process at a time: the step that removes bytes gives the text as well."""
    plans, staged = {}, suffix_dedup.staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(suffix_dedup, "staged", noted)
    passage = "é passed on from text to text " * 10
    docs = spark.createDataFrame([(1, "x" + passage), (2, "yy" + passage[1:]), (3, "other")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    assert got[3] == "other" and got[1].startswith("x") and len(got[1]) < 10
    above = plans["kept"].split("Join", 1)[0]
    assert above.count("MapInArrow") == 1
