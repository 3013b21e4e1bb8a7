r"""Phrase collocations by set-oriented mining over relations of occurrences.

Texts fall into pieces at punctuation and line breaks, pieces into words at blanks; A-Z is lower-cased. An occurrence of a
phrase is the position of its first word; a text's occurrences stand together, in the order of position. Length by length:

1. extend: a phrase of k words whose neighbour at the next position of its piece is in the relation too becomes one of
   k + 1 words. Both stand in one text, so this merge of sorted positions needs no exchange;
2. count the groups of equal phrases by 32-bit hashes, which alone are shuffled: phrases that share one only add up;
3. keep the occurrences of frequent groups only (a semi-join with a bit table of 2 MB at any size, which is broadcast).

The relations are made again from the texts for the next length, which is cheaper than to write them, so a frame must give the
same rows each time. What is left after the longest one, nearly all of it frequent, is counted by the words themselves, which decide: hashes never do.

A phrase is frequent at ``min_count`` occurrences. All parts of a frequent phrase are frequent, so nothing is lost,
and every count that a score needs is in the table of frequent phrases.

A phrase is cut in two after each of its words; the score of a cut is floor(1000 a n / (l r)) in decimals of 38
digits, and the lowest one counts, of equal ones the first. Phrases that occur inside a longer frequent phrase no less
often drop out. Each language has its own counts; a null one is ``und``.

A null text is empty and has no words; repeated rows count each time; ids are not read, nor are other columns. Ties in
rank go to the higher count, then to the phrase that is smaller byte by byte. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tonearm.session import staged

from .common import FILTER_WORDS, columns_of

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: Ends of pieces, all read as a line feed, and blanks, all read as a space.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bytes of text that are worked on at once, and hashes that a task holds before it counts them.
CHUNK, HELD = 1 << 20, 1 << 22

_plain = np.arange(256, dtype=np.uint8)
_plain[65:91] += 32
_plain[list(ENDS)], _plain[list(BLANKS)] = 10, 32
_table = np.random.default_rng(2024).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_step, _back = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _step
    return x ^ (x >> np.uint64(29))


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of (lang, text) in slices of about ``CHUNK`` bytes."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
    cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """A 64-bit hash of each word: a sum over its bytes, times powers that count from its start."""
    at, data = np.frombuffer(words.buffers()[1], np.int32), np.frombuffer(words.buffers()[2], np.uint8)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_table[data] * np.cumprod(np.full(len(data), _step)), out=sums[1:])
    return (sums[at[1:]] - sums[at[:-1]]) * np.cumprod(np.full(len(data), _back))[at[:-1]]


def words_in(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(word, number of its piece, number of its row) of every word, in order."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    text = _plain[data[at[0] : at[-1]]]
    at = at - at[0]
    edge = np.zeros(len(text) + 1, bool)
    edge[at] = True
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = (text != 10) & (text != 32)
    begin = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
    end = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
    offsets = np.zeros(len(begin) + 1, np.int32)
    np.cumsum(end - begin, out=offsets[1:])
    words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(text[inside[1:-1]]))
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begin, at)))
    return words, np.cumsum(edge[:-1] | (text == 10), dtype=np.int32)[begin], row


def relations(words: pa.StringArray, piece: np.ndarray, row: np.ndarray, lang: list[str], tables: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, positions, hashes) of the phrases of each size: those in the tables, and as far as these go on, all."""
    spoken = np.array([xxhash.xxh64_intdigest(x, 1) for x in lang], np.uint64)
    h = mixed(word_hashes(words) + spoken[row])
    at = np.arange(len(h))
    for size in range(1, longest + 1):
        if size > 1:
            both = np.flatnonzero((at[1:] == at[:-1] + 1) & (piece[at[1:]] == piece[at[:-1]]))
            at, h = at[both], mixed(h[both] * np.uint64(0xFF51AFD7ED558CCD) + h[both + 1])
        if size <= len(tables):
            bits = tables[size - 1][h >> np.uint64(46)] >> (h >> np.uint64(40) & np.uint64(63))
            held = np.flatnonzero(bits & np.uint64(1))
            at, h = at[held], h[held]
        yield size, at, h


def group_hashes(rows: DataFrame, shared: Broadcast, size: int) -> DataFrame:
    """(h, a): how often phrases of ``size`` words occur, by hash; all their parts are in the shared tables."""
    schema = rows.sparkSession.createDataFrame([], "h int, a long").schema

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        h, a = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int32)), pa.array(a)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for chunk in chunks(batch):
                words, piece, row = words_in(chunk.column(1))
                for _, _, h in relations(words, piece, row, chunk.column(0).to_pylist(), shared.value, size):
                    pass
                held.append((h >> np.uint64(32)).astype(np.uint32))
                if sum(map(len, held)) > HELD:
                    yield counted(held)
                    held = []
        if held:
            yield counted(held)

    # counted by tasks already; in the order of their hashes rows are shuffled as fewer bytes
    return rows.mapInArrow(run, schema).repartition("h").groupBy("h").agg(F.sum("a").alias("a"))


def table_of(hashes: DataFrame) -> np.ndarray:
    """The bit table of 32-bit hashes: a bit for the first 24 bits of each, so 2 MB at any size."""
    marks = hashes.select(F.expr("shiftrightunsigned(h, 14)").alias("cell"), F.expr("shiftrightunsigned(h, 8) & 63").alias("bit"))
    cells = marks.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(FILTER_WORDS, np.uint64)
    table[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return table


def likely_phrases(rows: DataFrame, shared: Broadcast, longest: int) -> DataFrame:
    """(lang, size, phrase, a): phrases of each text whose hashes are frequent, by their words; of size 0 the number of words."""
    schema = rows.sparkSession.createDataFrame([], "lang string, size int, phrase string, a long").schema

    def batch_of(lang: pa.Array, size: int, phrase: pa.Array, a: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(a), size, np.int32)), phrase, pa.array(a.astype(np.int64))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch):
                words, piece, row = words_in(chunk.column(1))
                known, lang = words.dictionary_encode(), chunk.column(0).dictionary_encode()
                word, spoken = known.indices.to_numpy().astype(np.int64), lang.indices.to_numpy()[row]
                n = np.bincount(spoken, minlength=len(lang.dictionary))
                yield batch_of(lang.dictionary, 0, pa.array([""] * len(n), pa.string()), n)
                group = row.astype(np.int64)  # of the text and the phrase, one word shorter, that starts at a position
                for size, at, _ in relations(words, piece, row, chunk.column(0).to_pylist(), shared.value, longest):
                    _, first, own, a = np.unique(group[at] * len(known.dictionary) + word[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
                    group[at] = own
                    parts = [known.dictionary.take(pa.array(word[at[first] + k])) for k in range(size)]
                    yield batch_of(lang.dictionary.take(pa.array(spoken[at[first]])), size, pc.binary_join_element_wise(*parts, " "), a)

    return rows.mapInArrow(run, schema)


def phrase_counts(rows: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, a): every frequent phrase of up to ``longest`` words; of size 0 the number of all words."""
    context = rows.sparkSession.sparkContext
    tables: list[np.ndarray] = []
    for size in range(1, longest + 1):
        shared = context.broadcast(tables)
        tables = [*tables, table_of(group_hashes(rows, shared, size).where(F.col("a") >= min_count))]
        shared.unpersist()
    counts = likely_phrases(rows, context.broadcast(tables), longest).groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))
    return counts.where((F.col("size") == 0) | (F.col("a") >= min_count))


def part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def least_cut(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): each phrase at its lowest-scoring cut."""
    split = counts.where("size > 1").select("lang", "phrase", "a", "size", F.split("phrase", " ").alias("w"))
    cuts = split.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.col("w"), F.lit(1), F.col("k")).alias("head"), part(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    met = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    # 19 digits times 19 digits are 38, the most that a decimal holds: exact
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = met.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def covered(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer frequent phrase around a phrase."""
    split = counts.where("size > 2").select("lang", "a", "size", F.split("phrase", " ").alias("w"))
    sized = split.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    return placed.select("lang", "a", part(F.col("w"), F.col("i"), F.col("m")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    rows = columns_of(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = staged(phrase_counts(rows, min_count, longest), "phrase-counts")
    totals, counts = every.where("size = 0").select("lang", F.col("a").alias("n")), every.where("size > 0")
    scored = least_cut(counts, totals).join(covered(counts), ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
