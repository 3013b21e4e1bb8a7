"""The whole pipeline against plain versions of its stages."""

from collections import Counter

import public_tokenizers
from test_dedup import plain_components, plain_kept, plain_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from tonearm.llm import mixing, quality


def planted(docs):
    """The given documents, and copies, near copies, a passage that unlike texts share, empty and null texts."""
    rows = [tuple(r) for r in docs.collect()]
    good = sorted((r for r in rows if len(r[1]) > 800), key=lambda r: -len(r[1]))[:6]
    passage = " ".join(f"shared{i}" for i in range(60))
    more = [(r[1], r[2:]) for r in good[:3] for _ in range(3)] + [(r[1].replace(" the ", " that ", 1), r[2:]) for r in good]
    more += [(r[1][:400] + " " + passage + " " + r[1][400:], r[2:]) for r in rows[:8]] + [("", rows[0][2:]), (None, rows[0][2:])]
    first = max(r[0] for r in rows) + 1
    return rows + [(first + i, t, *others) for i, (t, others) in enumerate(more)]


def test_pipeline_matches_plain_stages(spark, tmp_path):
    """run() next to a plain version of every stage; the scores of the first are those of the quality operator."""
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = planted(docs)
    assert docs.columns[:2] == ["doc_id", "text"]
    spark.createDataFrame(rows, docs.schema).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    every, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    score = {r.doc_id: r.score for r in quality.score_quality(every, quality.fit_quality(every, labels)).collect()}
    left = sorted((r[0], r[1] or "", r[docs.columns.index("source")]) for r in rows if score[r[0]] >= 0.3)
    label = plain_components([plain_simhash(t) for _, t, _ in left])
    left = [left[i] for i in sorted(set(label))]
    kept = [k for k, _ in plain_kept([t for _, t, _ in left])]
    texts = {i: k.decode("utf-8", "ignore") for (i, _, _), k in zip(left, kept)}
    coder = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    coder.no_truncation()
    coder.no_padding()
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) == set(texts) and 0 < len(texts) < len(rows) - 9
    assert max(times.values()) <= 2 and sum(len(k) for k in kept) < sum(len(t.encode()) for _, t, _ in left)
    for r in got:
        ids = coder.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and list(r.ids) == ids
    schedule = mixing.mix_schedule(spark.createDataFrame([(i, texts[i], s) for i, _, s in left], "doc_id long, text string, source string"))
    assert times == Counter(r.doc_id for r in schedule.select("doc_id").collect())
