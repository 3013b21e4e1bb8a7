"""Whole jobs from files to datasets."""

import json
import pathlib

import pytest
import zstandard
from frame_rows import rows

from tonearm.plans import jobs, reports
from tonearm.schemas import ARTIST_METADATA, EXTERNAL_SIMILAR
from tonearm.session import discard, staged


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    root = tmp_path_factory.mktemp("dumps")
    for month in (1, 2):
        lines = [json.dumps({"user_id": u, "recording_msid": f"s{(u * 7 + k * month) % 12}"}) for u in range(30) for k in range(9)]
        (root / f"{month}.listens.zst").write_bytes(zstandard.compress("\n".join(lines).encode()))
    mapping = ["recording_msid,recording_mbid,match_type"] + [f"s{i},m{i},{'exact_match' if i % 4 else 'low_quality'}" for i in range(11)]
    (root / "mapping.csv.zst").write_bytes(zstandard.compress("\n".join(mapping).encode()))
    (root / "redirects.csv").write_text("recording_mbid,canonical_recording_mbid,canonical_release_mbid\nm1,m2,r\n")
    head = "id,artist_credit_id,artist_mbids,artist_credit_name,release_mbid,release_name,recording_mbid,recording_name,combined_lookup,score"
    body = [f'{i},{i},"a{i % 7};a{(i + 1) % 7}","Credit, {i}",r{i},"Rel",m{i},"Rec",x,{i}' for i in range(2, 11)]
    (root / "canonical.csv").write_text("\n".join([head, *body]))
    return root


def _build(spark, dumps, work, **kw):
    return jobs.build_counts(
        spark,
        str(dumps),
        str(work),
        kw.pop("months", [1, 2]),
        {"msid_mapping": f"{dumps}/mapping.csv.zst", "canonical_redirects": f"{dumps}/redirects.csv", "canonical_data": f"{dumps}/canonical.csv"},
        **kw,
    )


def test_counts_job(spark, dumps, tmp_path):
    counts, quality, path = _build(spark, dumps, tmp_path)
    want = {}
    mapped = 0
    for month in (1, 2):
        for u in range(30):
            for k in range(9):
                i = (u * 7 + k * month) % 12
                if i == 11 or i % 4 == 0:
                    continue
                mapped += 1
                c = 2 if i == 1 else i
                for a in (f"a{c % 7}", f"a{(c + 1) % 7}"):
                    want[(u, a)] = want.get((u, a), 0) + 1
    assert {(r[0], r[1]): r[2] for r in rows(counts)} == want
    q = quality.first()
    assert (q["mapped_count"], q["total"]) == (mapped, 540)
    # A second run reuses every stage; other levels or months get their own.
    assert _build(spark, dumps, tmp_path)[2] == path
    other, _, other_path = _build(spark, dumps, tmp_path, levels=["exact_match", "low_quality"])
    assert other_path != path and other.agg({"listen_count": "sum"}).first()[0] > counts.agg({"listen_count": "sum"}).first()[0]
    one, _, _ = _build(spark, dumps, tmp_path, months=[1])
    assert one.agg({"listen_count": "sum"}).first()[0] < counts.agg({"listen_count": "sum"}).first()[0]


def test_full_report(spark, dumps, tmp_path):
    counts, quality, _ = _build(spark, dumps, tmp_path)
    artists = spark.createDataFrame([(f"a{i}", f"Artist {i}") for i in range(6)], "artist_mbid STRING, name STRING")
    recs = spark.createDataFrame(
        [(f"a{s}", f"Artist {s}", r + 1, f"a{(s + r) % 7}", f"Artist {(s + r) % 7}", 1.0 - r / 10) for s in range(3) for r in range(7)],
        "source_artist_id STRING, source_artist STRING, rank INT, artist_id STRING, artist_name STRING, similarity_score DOUBLE",
    )
    meta = spark.createDataFrame([("a0", "Artist 0", "US", ["rock"], [], "1991", None, "Group")], ARTIST_METADATA)
    outside = spark.createDataFrame([("Artist 0", ["Artist 1", "Nobody"])], EXTERNAL_SIMILAR)
    out = str(tmp_path / "report")
    written = reports.full_report(counts, artists, recs, meta, outside, out, quality)
    for name in ("dataset_summary/dataset_statistics", "network/nodes", "comparison/external_comparison", "artist_distribution/buckets", "data_quality/data_quality", "executive/summary"):
        assert spark.read.text(written[name]).count() > 0, name
    comparison = {r["artist_name"]: r["overlap_percentage"] for r in spark.read.json(written["comparison/external_comparison"]).collect()}
    assert comparison == {"Artist 0": 50.0, "Artist 1": 0.0, "Artist 2": 0.0}
    analysis = spark.read.json(written["recommendations/recommendations_analysis"]).collect()
    assert all([x["rank"] for x in r["recommendations"]] == list(range(2, 8)) for r in analysis)
    assert spark.read.json(written["user_segments/cluster_stats"]).agg({"user_count": "sum"}).first()[0] == counts.groupBy("user_id").count().filter("count > 5").count()
    document = reports.summary_document(counts, artists).first()
    listed = [a["total_listens"] for a in document["top_artists"]]
    assert listed == sorted(listed, reverse=True) and document["dataset_statistics"]["total_artists"] == 7


def test_discard_deletes_staged_tables_alone(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    left, gone = staged(given, "left"), staged(given.withColumnRenamed("id", "key"), "gone")
    folder = pathlib.Path(gone.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    discard(gone.join(given, gone.key == given.id))
    assert not folder.exists()
    assert given.count() == left.count() == 5


def test_report_reads_its_recommendations_once(spark, dumps, tmp_path):
    """What several datasets read is written once, however it was made."""
    recs = spark.createDataFrame(
        [(f"a{s}", f"Artist {s}", r + 1, f"a{(s + r) % 7}", f"Artist {(s + r) % 7}", 1.0 - r / 10) for s in range(3) for r in range(7)],
        "source_artist_id STRING, source_artist STRING, rank INT, artist_id STRING, artist_name STRING, similarity_score DOUBLE",
    )
    recs.write.parquet(str(tmp_path / "made"))
    artists = spark.createDataFrame([("a0", "Artist 0")], "artist_mbid STRING, name STRING")
    network = reports.similarity_network(spark.read.parquet(str(tmp_path / "made")), artists)
    for name in ("edges", "nodes", "labels"):
        assert not [f for f in network[name].inputFiles() if "/made/" in f], name
    assert network["nodes"].count() == 7
