r"""Benchmark decontamination by a prefix-filtered join of shingles, in DataFrame functions only.

Words are runs of digits, letters and all that is not ASCII, A-Z lower-cased. An item's windows are its runs of 10
words, or the whole of a shorter item. A window is the ordered set of its five-word shingles (a shorter window is
one shingle). A document holds a window only if it holds all of the window's shingles, so:

1. The documents are read once. Their shingles pass a bit table of the benchmark's shingle hashes, which has at most
   2 MB whatever the size of the benchmark; what passes is written with its place, some of it wrongly.
2. The written shingles are counted. A window that lacks one of its shingles can't occur. Of the others, the rarest
   shingle is the prefix: for a containment of one, one token is all that has to be joined.
3. Documents' shingles meet the windows' prefixes by their words. The prefix's place in the window gives the one
   start that is possible; a start before the text, or an end beyond it, drops out.
4. A candidate counts if the document holds the window's first shingle at that start and its last one so that the
   two cover the window, word by word: that is exact containment.

Windows and not items are joined, each distinct one once. Hit words are counted from the sorted starts of a document.
Common shingles are never multiplied with one another, and a shingle found in a third of all documents is
spread over the tasks that read them, beside a small table of prefixes.

A null or empty text has no words; a document without words is clean, an item without words has no window. Rows
are told apart by a number of their own, so repeated ids and null ids give one row each. Repeated item ids count
once; a null item id counts as one item, as the empty string. An empty table gives an empty one, an empty
benchmark finds nothing; other columns are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonearm.session import staged

from .common import FILTER_WORDS, columns_of

WINDOW, SHINGLE = 10, 5
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BITS = 64 * FILTER_WORDS


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, GAPS), "")


def window_items(benchmark: DataFrame) -> DataFrame:
    """(item, window): every item's windows, as arrays of words."""
    rows = columns_of(benchmark, "item_id", "text")
    rows = rows.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0))))
    return rows.select("item", "words", starts.alias("at")).select("item", F.slice("words", F.col("at") + 1, F.lit(WINDOW)).alias("window")).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """(wid, size, place, width, shingle) of (wid, window)."""
    width = F.least(F.size("window"), F.lit(SHINGLE))
    rows = windows.select("wid", "window", F.size("window").alias("size"), width.alias("width"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))).alias("place"))
    return rows.select("wid", "size", "place", "width", F.array_join(F.slice("window", F.col("place") + 1, F.col("width")), " ").alias("shingle"))


def bit_table(shingles: DataFrame) -> DataFrame:
    """(cell, bits): a bit per hashed shingle, in at most ``FILTER_WORDS`` rows."""
    bit = F.pmod(F.xxhash64("shingle"), F.lit(BITS))
    marks = shingles.select("shingle").distinct().select(F.floor(bit / 64).cast("int").alias("cell"), F.expr("shiftleft(1L, cast(pmod(xxhash64(shingle), 64) as int))").alias("b"))
    return marks.groupBy("cell").agg(F.bit_or("b").alias("bits"))


def shingle_places(docs: DataFrame, table: DataFrame, widths: list[int]) -> DataFrame:
    """(row, doc_id, n_words, first, pos, shingle): one row per document (``first``), and per shingle that passes the table.

    ``shingle`` is null where it does not pass. The words stay where they are: each place looks ahead in the
    array, so nothing but what is kept is copied.
    """
    rows = columns_of(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("row", "doc_id", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "w0"))

    def ahead(width: int) -> Column:
        some = F.concat_ws(" ", "w0", *(F.get("words", F.col("pos") + k) for k in range(1, width)))
        return F.when(F.col("pos") + width <= F.col("n_words"), some)

    main = (F.coalesce("pos", F.lit(0)) == 0).alias("first")
    rows = rows.select("row", "doc_id", "n_words", main, "pos", *(ahead(w).alias(f"s{w}") for w in widths))
    if len(widths) > 1:
        each = F.posexplode(F.array(*(f"s{w}" for w in widths)))
        rows = rows.select("row", "doc_id", "n_words", "first", "pos", each.alias("turn", "shingle")).withColumn("first", F.col("first") & (F.col("turn") == 0))
    else:
        rows = rows.withColumnRenamed(f"s{widths[0]}", "shingle")
    bit = F.pmod(F.xxhash64("shingle"), F.lit(BITS))
    rows = rows.withColumn("cell", F.when(F.col("shingle").isNotNull(), F.floor(bit / 64).cast("int")))
    met = rows.join(F.broadcast(table), "cell", "left")
    passed = F.coalesce(F.expr("(shiftrightunsigned(bits, cast(pmod(xxhash64(shingle), 64) as int)) & 1) = 1"), F.lit(False))
    met = met.withColumn("passed", passed).where(F.col("first") | F.col("passed"))
    return met.select("row", "doc_id", "n_words", "first", "pos", F.when(F.col("passed"), F.col("shingle")).alias("shingle"))


def prefixes(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, size, shingle, place, head, tail, tail_place): the rarest shingle of each window that may occur."""
    met = shingles.join(counts, "shingle", "left").groupBy("wid", "size")
    met = met.agg(
        (F.count("n") == F.count("*")).alias("whole"), F.min(F.struct("n", "shingle", "place")).alias("rarest"),
        F.min(F.struct("place", "shingle")).alias("h"), F.max(F.struct("place", "shingle")).alias("t"),
    )
    kept = met.where("whole")
    return kept.select("wid", "size", "rarest.shingle", "rarest.place", F.col("h.shingle").alias("head"), F.col("t.shingle").alias("tail"), F.col("t.place").alias("tail_place"))


def occurrences(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row, start, size, wid): where each window occurs, exactly."""
    rarest = prefixes(shingles, hits.groupBy("shingle").agg(F.count("*").alias("n")))
    start = F.col("pos") - F.col("place")
    near = hits.join(rarest, "shingle").where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    near = near.select("row", start.alias("start"), "size", "wid", "head", "tail", (start + F.col("tail_place")).alias("tail_pos"))
    there = hits.select(F.col("row").alias("r"), F.col("pos").alias("p"), F.col("shingle").alias("s"))
    at_head = (F.col("row") == F.col("r")) & (F.col("start") == F.col("p")) & (F.col("head") == F.col("s"))
    at_tail = (F.col("row") == F.col("r")) & (F.col("tail_pos") == F.col("p")) & (F.col("tail") == F.col("s"))
    return near.join(there, at_head, "left_semi").join(there, at_tail, "left_semi").select("row", "start", "size", "wid")


def hit_words(found: DataFrame) -> DataFrame:
    """(row, n_hit): words inside any window; each window adds what reaches beyond those that start before it."""
    spans = found.groupBy("row", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    return spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).alias("n_hit"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items): per document its hit words and the sorted ids of the items that occur in it."""
    held = staged(window_items(benchmark), "benchmark-windows")
    windows = staged(held.select("window").distinct().select(F.monotonically_increasing_id().alias("wid"), "window"), "windows")
    shingles = staged(window_shingles(windows), "window-shingles")
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect()) or [SHINGLE]  # at most five numbers
    places = staged(shingle_places(docs, bit_table(shingles), widths), "shingle-places")
    hits = places.where("shingle is not null").select("row", "n_words", "pos", "shingle")
    found = staged(occurrences(hits, shingles), "occurrences")
    pairs = found.select("row", "wid").distinct().join(windows.join(held, "window").select("wid", "item"), "wid").select("row", "item").distinct()
    named = pairs.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    rows = places.where("first").select("row", "doc_id", "n_words").join(hit_words(found), "row", "left").join(named, "row", "left")
    none = F.array().cast("array<string>")
    return rows.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    items = F.size("items").cast("long").alias("n_items")
    return overlaps(docs, benchmark).select("doc_id", "n_words", "n_hit", items, F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
