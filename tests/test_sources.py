"""Readers and writers on small files."""

import json

import pytest
import zstandard
from frame_rows import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.schemas import ARTISTS, COUNTS, MSID_MAPPING
from tonearm.sources import listens, results, sinks, tables
from tonearm.streaming.landing import land_new_listens

LINES = [
    {"user_id": 1, "recording_msid": "a"},
    {"user_id": 1, "recording_msid": "a"},
    {"user_id": 2, "track_metadata": {"recording_msid": "b"}},
    {"user_id": 3, "track_metadata": {"additional_info": {"recording_msid": "c"}}},
    {"user_id": 4, "recording_msid": None, "track_metadata": {"recording_msid": None, "additional_info": {"recording_msid": "d"}}},
    {"user_id": 5, "recording_msid": "e", "track_metadata": "text"},
    {"recording_msid": "f"},
    {"user_id": 7, "track_metadata": {}},
]
TEXT = "\n".join(json.dumps(x) for x in LINES) + '\n{"user_id": 8, "recording_msid": "g"\nno json at all\n'
EXPECTED = [(1, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


@pytest.mark.parametrize("packed", [False, True])
def test_listen_lines(spark, tmp_path, packed):
    path = tmp_path / ("1.listens.zst" if packed else "1.listens")
    path.write_bytes(zstandard.compress(TEXT.encode()) if packed else TEXT.encode())
    raw = listens.read_raw_listens(spark, str(path))
    assert rows(listens.extract_listens(raw)) == EXPECTED
    assert rows(listens.extract_listens(raw, keep_null_msid=True)) == sorted(EXPECTED + [(7, None)], key=repr)
    assert rows(listens.line_quality(raw)) == [(10, 2, 2, 6)]
    assert rows(listens.distinct_messages(listens.extract_listens(raw))) == [("a",), ("b",), ("c",), ("d",), ("e",)]


def test_months(spark, tmp_path):
    assert listens.parse_months("1-3") == [1, 2, 3] and listens.parse_months("1,3,5") == [1, 3, 5]
    for m in (1, 2, 11):
        (tmp_path / f"{m}.listens.zst").write_bytes(zstandard.compress(f'{{"user_id": {m}, "recording_msid": "s{m}"}}\n'.encode()))
    read = listens.read_monthly_listens(spark, str(tmp_path), [1, 11])
    assert rows(read) == [(1, "s1", 1), (11, "s11", 11)]
    target = str(tmp_path / "landed")
    listens.land_listens(read, target)
    # Landing another month leaves the first ones in place.
    listens.land_listens(listens.read_monthly_listens(spark, str(tmp_path), [2]), target)
    assert rows(listens.read_landed_listens(spark, target)) == [(1, "s1", 1), (11, "s11", 11), (2, "s2", 2)]
    pruned = listens.read_landed_listens(spark, target, [2])
    assert rows(pruned) == [(2, "s2", 2)]
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_stream_lands_each_file_once(spark, tmp_path):
    src, dst, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    src.mkdir()
    (src / "1.listens").write_text(TEXT)
    land_new_listens(spark, str(src), dst, cp).awaitTermination()
    land_new_listens(spark, str(src), dst, cp).awaitTermination()
    assert listens.read_landed_listens(spark, dst).count() == len(EXPECTED)
    (src / "2.listens").write_text('{"user_id": 9, "recording_msid": "z"}\n')
    land_new_listens(spark, str(src), dst, cp).awaitTermination()
    assert rows(listens.read_landed_listens(spark, dst, [2])) == [(9, "z", 2)]


def test_csv_quoting_and_zstd(spark, tmp_path):
    text = 'artist_mbid,name\nx,"Earth, Wind & Fire"\ny,"The ""Quoted"" Band"\nz,Björk\n'
    plain, packed = tmp_path / "artist.csv", tmp_path / "artist2.csv.zst"
    plain.write_text(text)
    packed.write_bytes(zstandard.compress(text.encode()))
    want = [("x", "Earth, Wind & Fire"), ("y", 'The "Quoted" Band'), ("z", "Björk")]
    assert rows(tables.read_table(spark, str(plain), ARTISTS)) == want
    assert rows(tables.read_table(spark, str(packed), ARTISTS)) == want
    landed = tables.csv_to_parquet(spark, str(plain), str(tmp_path / "a.parquet"), ARTISTS, ["name"])
    assert landed.columns == ["name"] and landed.count() == 3
    assert tables.head_rows(landed, 2).count() == 2
    with pytest.raises(ValueError):
        tables.read_table(spark, str(plain))
    moved = tmp_path / "moved.csv"
    moved.write_text("extra,name,artist_mbid\n1,Ex,x\n")
    assert rows(tables.read_csv(spark, str(moved), ARTISTS)) == [("x", "Ex")]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(moved), MSID_MAPPING)


def test_stage_preference(spark, tmp_path):
    raw = tmp_path / "m.csv"
    raw.write_text("recording_msid,recording_mbid,match_type\ns1,,no_match\n")
    root = str(tmp_path / "landed")
    first = tables.read_stage(spark, "msid_mapping", root, str(raw))
    assert rows(first) == [("s1", None, "no_match")]
    spark.createDataFrame([("s2", "m2", "exact_match")], MSID_MAPPING).write.parquet(f"{root}/msid_mapping.parquet")
    assert rows(tables.read_stage(spark, "msid_mapping", root, str(raw)))[0][0] == "s2"
    with pytest.raises(FileNotFoundError):
        tables.read_stage(spark, "artists", root, None)


def test_recommendation_files(spark, tmp_path):
    (tmp_path / "similar_to_Simon_and_Garfunkel.csv").write_text("rank,artist_id,artist_name,similarity_score\n1,x,Ex,0.99\n2,y,,0.5\n")
    (tmp_path / "other.csv").write_text("a\n1\n")
    got = rows(results.read_recommendation_files(spark, str(tmp_path)))
    assert got == [("Simon and Garfunkel", 1, "x", "Ex", 0.99), ("Simon and Garfunkel", 2, "y", None, 0.5)]
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "similar_to_Queen.csv").write_text("rank,artist_id,similarity_score\n1,q,1.0\n")
    assert rows(results.read_recommendation_files(spark, str(tmp_path / "old"))) == [("Queen", 1, "q", None, 1.0)]


def test_recommendations_round_trip(spark, tmp_path):
    recs = spark.createDataFrame(
        [("i1", "A & B's", 1, "i1", "A & B's", 1.0), ("i1", "A & B's", 2, "i2", "C", 0.5), ("i3", "!!!", 1, "i3", "!!!", 1.0),
         ("i4", "Unknown Artist", 1, "i4", "Unknown Artist", 1.0), ("i5", "Unknown Artist", 1, "i5", "Unknown Artist", 1.0)],
        "source_artist_id STRING, source_artist STRING, rank INT, artist_id STRING, artist_name STRING, similarity_score DOUBLE",
    )
    path = str(tmp_path / "recs")
    sinks.write_recommendations(recs, path)
    assert (tmp_path / "recs" / "source_artist_slug=A_and_Bs").exists()
    back = results.read_recommendations(spark, path)
    assert rows(back, "source_artist", "source_artist_id", "rank") == [
        ("A & B's", "i1", 1), ("A & B's", "i1", 2), ("!!!", "i3", 1), ("Unknown Artist", "i4", 1), ("Unknown Artist", "i5", 1)
    ]
    assert all((tmp_path / "recs" / f"source_artist_slug=Unknown_Artist-{i}").exists() for i in ("i4", "i5")), "a folder per seed, not per name"


RECOMMENDED = "source_artist_id STRING, source_artist STRING, rank INT, artist_id STRING, artist_name STRING, similarity_score DOUBLE"
ODD = [None, "", "  edges ", 'q"uo"te', "a,b", "line\nbreak", "cr\rx", "back\\slash", "end\\", "ünï 日本", "tab\there", "null", '"', "_u", "x\u0085y"]


def _folders(path):
    """Folder: the bytes of its files, hidden ones left out."""
    return {d.name: [f.read_bytes() for f in d.iterdir() if not f.name.startswith(".")] for d in path.iterdir() if d.is_dir()}


def test_local_folders_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    """Folders and files that the tasks make and read themselves, byte for byte and row for row, whatever is in names and values."""
    seeds = [(chr(i) if i % 7 == 0 else f"id{chr(i)}", "!!") for i in range(1, 128)] + [(f"u{i}", x) for i, x in enumerate(ODD)]
    data = [(a, n, r, ODD[(i + r) % len(ODD)], ODD[(3 * i + r) % len(ODD)], i * 10.0 ** (-4 * r)) for i, (a, n) in enumerate(seeds) for r in (2, 1, 3)]
    recs = spark.createDataFrame(data, RECOMMENDED)
    mine, theirs = tmp_path / "mine", tmp_path / "theirs"
    sinks.write_recommendations(recs.limit(5), str(mine))
    sinks.write_recommendations(recs, str(mine))
    read = results.read_recommendations(spark, str(mine))
    assert not list(mine.rglob(".*")) and (mine / "_SUCCESS").exists(), "no file but the tasks' own, and none of the run before"
    assert "FileScan" not in read._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sinks, "local_path", lambda *given: None)
    monkeypatch.setattr(results, "local_path", lambda *given: None)
    sinks.write_recommendations(recs, str(theirs))
    assert _folders(mine) == _folders(theirs) and len(_folders(mine)) > 130
    expected = spark.read.schema(read.schema).option("header", True).csv(str(theirs)).select(*read.columns)
    assert rows(read) == rows(expected) == rows(results.read_recommendations(spark, str(mine))) == rows(results.read_recommendations(spark, str(theirs)))


def test_folders_stay_as_they_are_when_a_task_fails(spark, tmp_path):
    path = tmp_path / "recs"
    good = spark.createDataFrame([("i1", "A", 1, "i1", "A", 1.0)], RECOMMENDED)
    sinks.write_recommendations(good, str(path))
    with pytest.raises(Exception, match="on purpose"):
        sinks.write_recommendations(good.withColumn("artist_name", F.raise_error(F.lit("on purpose"))), str(path))
    assert rows(results.read_recommendations(spark, str(path))) == [("i1", "A", 1, "i1", "A", 1.0)] and len(list(tmp_path.iterdir())) == 1
    sinks.write_recommendations(good.filter("false"), f"file:{path}")
    assert results.read_recommendations(spark, str(path)).count() == 0 and [f.name for f in path.iterdir()] == ["_SUCCESS"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        results.read_recommendations(spark, str(tmp_path / "none"))


def test_csv_line_breaks_and_failures(spark, tmp_path):
    file = tmp_path / "names.csv"
    file.write_text('id,name\n1,"a\nb, ""c"""\nx,plain\n,"last\n\n"\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert rows(tables.read_csv(spark, str(file), schema, multi_line=True)) == sorted([(1, 'a\nb, "c"'), (None, "plain"), (None, "last\n\n")], key=repr)
    assert rows(tables.cast_failures(spark, str(file), schema, multi_line=True)) == [("id", 3, 1, 1), ("name", 3, 0, 0)]
    broken = tmp_path / "broken.csv"
    broken.write_text("id,name\n1,a\n2\n3,c,d\n4,\n")
    assert rows(tables.broken_records(spark, str(broken))) == [("2",), ("3,c,d",)]
    assert tables.broken_records(spark, str(file), multi_line=True).count() == 0


def test_log_counts(spark, tmp_path):
    log = tmp_path / "run.log"
    log.write_text("start\nINFO MSID to MBID mapping: 74 mapped (79.9%), 19 unmapped\nMSID to MBID mapping: 1,074 mapped (98.3%), 2,019 unmapped\nMSID to MBID mapping: broken\n")
    assert rows(results.read_mapping_counts(spark, str(log))) == [(1074, 2019), (74, 19)]


def test_stage_reuse_and_paths(spark, tmp_path):
    root = str(tmp_path)
    a = sinks.stage_path(root, "counts", {"levels": ["x"]})
    assert a != sinks.stage_path(root, "counts", {"levels": ["y"]})
    calls = []

    def build(v):
        calls.append(v)
        return spark.createDataFrame([(v,)], "v INT")

    assert rows(sinks.materialise(spark, lambda: build(1), a)) == [(1,)]
    assert rows(sinks.materialise(spark, lambda: build(2), a)) == [(1,)]
    assert rows(sinks.materialise(spark, lambda: build(3), a, force=True)) == [(3,)]
    assert calls == [1, 3]


def test_sorted_csv_and_fingerprint(spark, tmp_path):
    counts = spark.createDataFrame([(2, "b", 1), (1, "z", 2), (1, "a", 3)], COUNTS)
    path = str(tmp_path / "c.csv")
    sinks.write_counts_csv(counts, path)
    body = "".join(p.read_text() for p in sorted((tmp_path / "c.csv").glob("part-*.csv")))
    lines = [x for x in body.splitlines() if not x.startswith("user_id")]
    assert lines == ["1,a,3", "1,z,2", "2,b,1"]
    same = counts.orderBy(F.col("listen_count"))
    assert sinks.content_fingerprint(counts) == sinks.content_fingerprint(same.repartition(3))
    assert sinks.content_fingerprint(counts) != sinks.content_fingerprint(counts.limit(2))
