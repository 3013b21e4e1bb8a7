"""Repeated byte strings across a corpus, through suffix buckets sorted with a difference cover.

Every 200-byte string has an anchor: the rightmost lowest hash among its 24-byte grams. Equal strings have equal
anchors, so the anchor's hash names the suffix bucket in which a string's start belongs, and neighbouring starts
with one anchor travel as one stretch of text. Only buckets with two stretches or more can hold a repeat; a count
of anchor hashes finds them, and only their stretches are fetched.

A task goes through its buckets in order, a bounded block at a time, and sorts a block's suffixes: by their first
31 bytes, then, where those tie, by ranks of sampled suffixes. The sample is a difference cover modulo 31: for any
two suffixes some shift below 31 lands both in the sample, whose ranks were made beforehand by doubling. Starts
that agree with a sorted neighbour on 200 bytes are repeats. Memory depends on the block alone.

Equal stretches count as repeats without sorting, and one of them stands for all. Buckets with more than ``hot``
stretches are divided while they are fetched: starts fall into bands of 32 by their distance from the anchor, and
a band's bucket is named by the 169 bytes that all its strings share, so a common line no longer makes a bucket.
From 64 times as many stretches on the bands have one start, whose bucket is the string itself and needs no
sorting. Texts that are equal as a whole are worked on once.

Offsets are of UTF-8 bytes. A null text is empty; texts under 200 bytes lose nothing. Repeated rows are copies
of one another and lose all they have, from 200 bytes on. Rows without an id are treated like others. An empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tonearm.session import arrow_batches_of, staged

from .common import bit_table, likely_split, texts_of

LENGTH, GRAM, HOT = 200, 24, 1 << 15
#: Width of the bands of starts in hot buckets, and how many times as hot a bucket has bands of one.
BAND, HOTTER = 32, 64
#: Bytes of stretches that are sorted at once.
BLOCK = 1 << 19
#: Rows that travel to Python at once: whole texts with their stretches stand in memory several times.
BATCH = 1000
#: A perfect difference set: every difference modulo 31 occurs.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Stretches that a task remembers to forward equal ones twice only.
SEEN = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
SEGMENT = 1 << 19

_table = np.random.default_rng(2024).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_steps = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in (1, 2, 4, 8)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each position on."""
    by = {1: _table[data]}
    for i, step in enumerate(_steps):
        size = 1 << i
        by[2 * size] = by[size][:-size] * np.uint64(step) + by[size][size:]
    h = by[16][:-8] * np.uint64(_steps[3]) + by[8][16:]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, first start, number of starts, from there to the anchor) of each run of starts with one anchor."""
    window = length - GRAM + 1
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = data[at : at + SEGMENT + length - 1]
        h = (gram_hashes(part) & ~PLACE) | (PLACE - np.arange(len(part) - GRAM + 1, dtype=np.uint64))
        size = 1
        while 2 * size <= window:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        if size < window:
            h = np.minimum(h[: len(h) - (window - size)], h[window - size :])
        cuts = np.concatenate(([0], np.flatnonzero(h[1:] != h[:-1]) + 1))
        to = (PLACE - (h[cuts] & PLACE)).astype(np.int64) - cuts
        out.append(((h[cuts] >> np.uint64(20)).astype(np.int64), cuts + at, np.diff(np.append(cuts, len(h))), to))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def bands(data: bytes, bucket: int, lo: int, n: int, to: int, width: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first start, number of starts) of a hot stretch, cut by the distance of its starts from the anchor."""
    for band in range((to - n + 1) // width, to // width + 1):
        last = lo + to - band * width
        core = data[last : last - width + 1 + length]
        first, last = max(lo, last - width + 1), min(lo + n - 1, last)
        yield xxhash.xxh64_intdigest(core, (bucket + band) & (1 << 63) - 1) >> 1, first, last - first + 1


def shifts() -> np.ndarray:
    """For two residues, the shift that takes both into the cover."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
    return table


SHIFT = shifts()


def sample_ranks(words: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Rank of every cover position by its next ``depth`` bytes or more; other positions hold no rank."""
    rank = np.zeros(size + depth + 2 * PERIOD, np.int64)
    at = np.flatnonzero(np.isin(np.arange(size) % PERIOD, COVER))
    if not len(at):
        return rank
    order = np.lexsort((words[at + 23], words[at + 16], words[at + 8], words[at]))
    s = at[order]
    new = np.zeros(len(s), bool)
    new[0] = True
    for k in (0, 8, 16, 23):
        new[1:] |= words[s[1:] + k] != words[s[:-1] + k]
    rank[s] = np.cumsum(new)
    known = PERIOD
    while known < depth:
        _, inverse = np.unique(rank[at] * (len(at) + 1) + rank[at + known], return_inverse=True)
        rank[at] = inverse + 1
        known *= 2
    return rank


def repeated(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the string at each start equals the one at another start: neighbours in the sorted order are compared."""
    size = len(text)
    padded = np.zeros(size + length + 4 * PERIOD, np.uint64)
    padded[:size] = text
    words = np.zeros(len(padded) - 8, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + len(words)]
    order = np.lexsort((words[starts + 23], words[starts + 16], words[starts + 8], words[starts]))
    s = starts[order]
    new = np.zeros(len(s), bool)
    new[:1] = True
    for k in (0, 8, 16, 23):
        new[1:] |= words[s[1:] + k] != words[s[:-1] + k]
    group = np.cumsum(new)
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(tied):
        rank = sample_ranks(words, size, length)
        residue = starts % PERIOD
        active, label = tied, group[tied]
        while len(active):  # three-way split of every tie at its middle element, all ties at once
            first = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
            counts = np.diff(np.append(first, len(label)))
            pivot = np.repeat(order[active[first + counts // 2]], counts)
            own = order[active]
            shift = SHIFT[residue[own], residue[pivot]]
            side = np.sign(rank[starts[own] + shift] - rank[starts[pivot] + shift])
            key = np.repeat(np.arange(len(first)), counts) * 3 + side + 1
            by = np.argsort(key, kind="stable")
            order[active] = own[by]
            key = key[by]
            open_ = (key % 3 != 1) & (np.bincount(key, minlength=3 * len(first))[key] > 1)
            active, label = active[open_], key[open_]
    s = starts[order]
    same = np.arange(len(s) - 1)
    for k in [*range(0, length - 7, 8), length - 8]:
        same = same[words[s[same] + k] == words[s[same + 1] + k]]
    out = np.zeros(len(s), bool)
    out[order[same]] = True
    out[order[same + 1]] = True
    return out


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


SPAN = "digest binary, start long, stop long"


def spans_batch(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    digest, start, stop = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())], names=["digest", "start", "stop"])


def in_buckets(length: int):
    """Function over (bucket, whole, digest, lo, n, stretch) sorted by bucket and whole: spans of repeated strings."""

    def flush(held: list[tuple[bytes, int, int, bytes]]) -> list[tuple[bytes, int, int]]:
        """Sorts the block; ``held`` has (digest, lo, n, stretch), with an empty digest where spans are out already."""
        out: list[tuple[bytes, int, int]] = []
        if len(held) < 2:
            return out
        sizes = np.array([len(x[3]) for x in held])
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        counts = sizes - length + 1
        cut = np.concatenate(([0], np.cumsum(counts)))
        starts = np.repeat(first - cut[:-1], counts) + np.arange(cut[-1])
        marked = repeated(np.frombuffer(b"".join(x[3] for x in held), np.uint8), starts, length)
        for i in np.unique(np.searchsorted(cut, np.flatnonzero(marked), "right") - 1).tolist():
            digest, lo, _, _ = held[i]
            if digest:
                out += [(digest, lo + a, lo + b + length) for a, b in zip(*(r.tolist() for r in runs(marked[cut[i] : cut[i + 1]])))]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int, bytes]] = []
        bucket, whole, size, alone = None, None, 0, True
        out: list[tuple[bytes, int, int]] = []
        for batch in batches:
            for b, w, digest, lo, n, stretch in zip(*(c.to_pylist() for c in batch.columns)):
                if stretch is None:
                    out.append((digest, lo, lo + n + length - 1))
                    continue
                if b != bucket:
                    if alone and held:
                        held.pop()  # a bucket of one stretch has no partner
                    if size > BLOCK:
                        out += flush(held)
                        held, size = [], 0
                    bucket, whole, alone = b, w, True
                elif w == whole:
                    kept = held[-1]
                    if kept[0]:
                        out.append((kept[0], kept[1], kept[1] + kept[2] + length - 1))
                        held[-1] = (b"", *kept[1:])
                    out.append((digest, lo, lo + n + length - 1))
                    continue
                else:
                    whole, alone = w, False
                held.append((digest, lo, n, stretch))
                size += len(stretch)
            if len(out) > 50_000:
                yield spans_batch(out)
                out = []
        out += flush(held)
        if out:
            yield spans_batch(out)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """((digest, spans) of distinct texts with repeated strings, (digest, n) of texts that are in several rows)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("digest"), "text")
    schema = lambda s: spark.createDataFrame([], s).schema

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                data = np.frombuffer(text.encode("utf-8"), np.uint8)
                if len(data) >= length:
                    found.append(anchors(data, length))
                    owner.append(np.full(len(found[-1][0]), i))
            if found:
                own = pa.array(np.concatenate(owner))
                h, lo, n, to = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(h), batch.column(0).take(own), batch.column(1).take(own), pa.array(lo), pa.array((to << 16 | n).astype(np.int32))], names=["bucket", "doc_id", "digest", "lo", "reach"])

    every = staged(rows.mapInArrow(anchored, schema("bucket long, doc_id long, digest binary, lo long, reach int")), "anchors")
    place = F.xxhash64("digest", "lo")
    shared = every.groupBy("bucket").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("members")).where("a != b")
    shared = staged(shared.select("bucket", F.when(F.col("members") > hot * HOTTER, 1).when(F.col("members") > hot, BAND).otherwise(0).alias("width")), "buckets")
    copies = staged(rows.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    wanted = every.join(shared, "bucket").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.collect_set(F.struct("bucket", "lo", "reach", "width")).alias("wanted"))

    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
    member = schema("bucket long, whole binary, digest binary, lo long, n int, stretch binary")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=member.names)
        seen: dict[bytes, int] = {}
        for batch in batches:
            out: list[tuple] = []
            for digest, text, wanted_ in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8")
                for x in wanted_:
                    n, to = x["reach"] & 0xFFFF, x["reach"] >> 16
                    parts = bands(data, x["bucket"], x["lo"], n, to, x["width"], length) if x["width"] else [(x["bucket"], x["lo"], n)]
                    for bucket, lo, starts in parts:
                        stretch = data[lo : lo + starts + length - 1]
                        whole = xxhash.xxh3_128_digest(stretch)
                        times = seen[whole] = seen.get(whole, 0) + 1
                        # two equal stretches speak for all of the task's; the others are repeats already, and travel by text
                        out.append((bucket, whole, digest, lo, starts, stretch) if times < 3 else (-1 - (digest[0] << 8 | digest[1]), digest, digest, lo, starts, None))
                if len(seen) > SEEN:
                    seen.clear()
                if len(out) > 20_000:
                    yield made(out)
                    out = []
            if out:
                yield made(out)

    # one row of each text; told by a comparison that is no join key, so that both joins use one exchange of the texts
    one = F.least("doc_id", "first_id") == F.greatest("doc_id", "first_id")
    fetched = rows.join(wanted, "digest").where(F.coalesce(one, F.lit(True))).select("digest", "text", "wanted").mapInArrow(stretches, member)
    spans = fetched.repartition("bucket").sortWithinPartitions("bucket", "whole").mapInArrow(in_buckets(length), schema(SPAN))
    return spans.groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), copies


def without(text: str, spans: list[dict]) -> tuple[bytes, int, int]:
    """(remaining bytes, removed bytes, maximal removed runs)."""
    data = text.encode("utf-8")
    kept, at, removed, number = [], 0, 0, 0
    last = -1
    for a, b in sorted((x["start"], x["stop"]) for x in spans):
        if a > last:
            number += 1
        if b > at:
            kept.append(data[at : max(at, a)])
            removed += b - max(at, a)
            at = b
        last = max(last, b)
    kept.append(data[at:])
    return b"".join(kept), removed, number


def kept_texts(rows: DataFrame, length: int, hot: int, as_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """((digest, kept, n_removed, n_spans) of the texts in one row that lose bytes, (digest, copies) of the others).

    What is kept are bytes, or with ``as_text`` the characters that are left whole. These are made in the same step:
    a second one would keep a second Python process per task alive, which later stages then use and fill as well.
    """
    spans, copies = repeated_spans(rows, length, hot)
    spark = rows.sparkSession
    texts = rows.select("doc_id", F.unhex(F.md5("text")).alias("digest"), "text")
    once = texts.join(spans.join(copies, "digest", "left_anti"), "digest").select("digest", "text", "spans", "doc_id")  # the same columns as before: the texts' exchange is used again
    schema = spark.createDataFrame([], f"digest binary, kept {'string' if as_text else 'binary'}, n_removed long, n_spans long").schema

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept, n, number = zip(*(without(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())))
                left = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), left, pa.array(n, pa.int64()), pa.array(number, pa.int64())], names=schema.names)

    return once.mapInArrow(removed, schema), copies


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    rows = texts_of(docs, id_col, text_col)
    with arrow_batches_of(docs.sparkSession, BATCH):
        kept, copies = kept_texts(rows, length, hot)
        kept = staged(kept.select("digest", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")), "kept")
    base = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.md5("text")).alias("digest"), F.sha2("text", 256).alias("own"))
    joined = base.join(kept, "digest", "left").join(copies, "digest", "left")
    gone = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    return joined.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "own")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns, with repeated strings taken out of the text; characters that lose some of their bytes go whole.

    Rows whose text surely keeps all its bytes are passed on as they are, without a shuffle. Columns are found by
    exact spelling, so others of like names stay as they are.
    """
    rows = texts_of(docs, id_col, text_col)
    with arrow_batches_of(docs.sparkSession, BATCH):
        kept, copies = kept_texts(rows, length, hot, as_text=True)
        changed = staged(kept.select("digest", "kept"), "kept")
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]
    text = plain[names.index(text_col)]
    keyed = docs.toDF(*plain).withColumn("digest", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    some, rest = likely_split(keyed, bit_table(changed.select("digest").unionByName(copies.select("digest")), "digest"), "digest")
    met = some.join(changed, "digest", "left").join(copies, "digest", "left")
    gone = F.col("copies").isNotNull() & (F.octet_length(text) >= length)
    met = met.withColumn(text, F.when(gone, "").otherwise(F.coalesce("kept", text)))
    return rest.select(*plain).unionByName(met.select(*plain)).toDF(*names)
