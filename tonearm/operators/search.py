"""Finding artists by name, and pairs of nearly equal texts."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fold_name, normalise_name
from ..session import staged
from .sets import head_per_group, repeatable_sample

# Fixed values of the similarity report.
SIMILARITY_THRESHOLD, SAMPLE_SIZE, SAMPLE_SEED = 0.85, 1000, 42
SEARCH_RESULTS = 10
#: Least score of a search by trigrams.
MIN_SCORE = 70.0
#: Texts of one piece that are compared by one task, and bits of a character mask (powers of two that a double holds).
PIECE_ROWS, MASK_BITS = 4096, 62
#: Up to so many rows of searched words or trigrams (some 10 MB) travel to every task.
BROADCAST_ROWS = 100_000


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - edits / longer length."""
    return F.lit(1.0) - F.try_divide(F.levenshtein(a, b).cast("double"), F.greatest(F.length(a), F.length(b)).cast("double"))


@F.pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks; no character is ignored for being frequent, at any length."""
    return pd.Series([SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)])


def numbered(tokens: Column) -> Column:
    """Tokens with the number of earlier equal ones, so that a multiset becomes a set."""

    def mark(c: Column, i: Column) -> Column:
        return F.concat(c, F.size(F.filter(F.slice(tokens, 1, i + 1), lambda x: x == c)).cast("string"))

    return F.transform(tokens, mark)


def _mask(text: Column, seed: int) -> Column:
    """64 bits, one set per numbered character: texts of a few different characters differ in as few bits."""
    bits = F.transform(numbered(F.split(text, "")), lambda x: F.pow(F.lit(2.0), F.pmod(F.xxhash64(x, F.lit(seed)), F.lit(MASK_BITS))).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _edits(measure: str, threshold: float, longer: Column) -> Column:
    """The most edits between a text of ``longer`` characters and a partner that is no longer."""
    share = (1.0 - threshold) * (1.0 if measure == "levenshtein" else 2.0)
    return F.floor(longer * F.lit(share) + 1e-9).cast("int")


def _pieces(rows: DataFrame) -> DataFrame:
    """Each text of ``size`` characters (or its partner) cut in ``edits`` + 1 even pieces: number, start and length."""
    cut = F.col("edits") + 1
    rows = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.col("edits"))))
    start = F.floor(F.col("piece_no") * F.col("size") / cut).cast("int")
    end = F.floor((F.col("piece_no") + 1) * F.col("size") / cut).cast("int")
    return rows.withColumns({"start": start, "length": end - start})


def candidate_pairs(values: DataFrame, column: str, threshold: float, measure: str = "levenshtein", split_at: int = PIECE_ROWS) -> DataFrame:
    """(value1, value2) of all distinct values that can reach the threshold.

    Of a pair the longer text (of equal ones the greater) has at most k edits, which its length and the threshold give, so
    one of its k + 1 pieces stands unchanged in the shorter text. Its place there is shifted by no more than
    the edits before it, and what is left of the difference in length by no more than those after it. Both sides join on
    length, piece number and piece, so no group is compared that does not share a piece in place. Matching blocks count
    as insertions and deletions, up to (1 - threshold) of both lengths.

    Pairs whose characters differ in more bits of a mask than the edits allow drop out in the join. A piece with over
    ``split_at`` texts is split: its texts are dealt over salts, and partners meet each of them.
    """
    if threshold <= 0.5:
        raise ValueError("the threshold must be above 1/2")
    if measure not in ("levenshtein", "matching"):
        raise ValueError(f"unknown measure {measure}")
    texts = values.select(F.col(column).alias("value")).filter(F.length(column) > 1).distinct()
    texts = texts.select("value", F.length("value").alias("n"), *(_mask(F.col("value"), s).alias(f"m{s}") for s in (0, 1)))
    keys = ["size", "piece_no", "piece"]

    long = _pieces(texts.withColumn("size", F.col("n")).withColumn("edits", _edits(measure, threshold, F.col("n"))))
    long = long.select(*keys[:2], F.substring(F.col("value"), F.col("start") + 1, F.col("length")).alias("piece"), *(F.col(c).alias(f"long_{c}") for c in ("value", "m0", "m1")))
    hot = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > split_at).select(*keys, F.ceil(F.col("rows") / split_at).cast("int").alias("salts"))

    widest = threshold if measure == "levenshtein" else threshold / (2.0 - threshold)
    short = texts.withColumn("size", F.explode(F.sequence(F.col("n"), F.floor(F.col("n") / F.lit(widest) + 1e-9).cast("int"))))
    short = _pieces(short.withColumn("edits", _edits(measure, threshold, F.col("size"))))
    apart = F.col("n") - F.col("size")
    shifts = F.sequence(F.ceil((apart - F.col("edits")) / 2).cast("int"), F.floor((apart + F.col("edits")) / 2).cast("int"))
    short = short.filter(-apart <= F.col("edits")).withColumn("shift", F.explode(shifts)).withColumn("at", F.col("start") + F.col("shift")).filter((F.col("at") >= 0) & (F.col("at") + F.col("length") <= F.col("n")))
    short = short.select("value", "n", "m0", "m1", *keys[:2], F.substring(F.col("value"), F.col("at") + 1, F.col("length")).alias("piece")).distinct()

    salts = F.coalesce("salts", F.lit(1))
    long = long.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64("long_value"), salts).cast("int")).drop("salts")
    short = short.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    size, n = F.col("size"), F.col("n")
    if measure == "levenshtein":
        most = 2 * _edits(measure, threshold, size) - (size - n)
    else:
        most = F.floor((size + n) * F.lit(1.0 - threshold) + 1e-9)
    close = [F.bit_count(F.col(f"m{s}").bitwiseXOR(F.col(f"long_m{s}"))) <= most for s in (0, 1)]
    met = long.join(short, [*keys, "salt"]).filter(((n < size) | (F.col("value") < F.col("long_value"))) & close[0] & close[1])
    return met.select(F.least("value", "long_value").alias("value1"), F.greatest("value", "long_value").alias("value2")).distinct()


def similar_pairs(
    df: DataFrame,
    column: str,
    threshold: float = SIMILARITY_THRESHOLD,
    sample_size: int | None = None,
    measure: str = "levenshtein",
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Pairs of different values of similarity in [threshold, 1).

    All values are compared; a report may ask for a repeatable sample of
    ``sample_size`` of them. Every candidate is verified: by its edits, in column
    functions, or with ``matching`` by the blocks that the two texts share. Only
    pairs whose edits allow that many shared characters come to the second one.
    """
    values = df.select(column).filter(F.col(column).isNotNull())
    if sample_size is not None:
        values = repeatable_sample(values, sample_size, column, seed)
    pairs = candidate_pairs(values, column, threshold, measure)
    if measure == "levenshtein":
        scored = pairs.withColumn("similarity", levenshtein_ratio(F.col("value1"), F.col("value2")))
    else:
        both = F.length("value1") + F.length("value2")
        near = pairs.filter(F.levenshtein("value1", "value2") <= both * F.lit(1.0 - threshold) + 1e-9)
        scored = near.withColumn("similarity", matching_ratio(F.col("value1"), F.col("value2")))
    return scored.filter((F.col("similarity") >= threshold) & (F.col("similarity") < 1.0))


def _looked_up(df: DataFrame, name: str) -> DataFrame:
    """What is searched for, written and counted: few rows go to every task, many are joined by merging.

    The planner cannot know how many rows an exploded index has, and would broadcast it in their place.
    """
    table = staged(df, name)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _best_named(scored: DataFrame, named: DataFrame, key: str, n: int) -> DataFrame:
    """The n best artists per query out of its scored names (query, ``key``, score); ``named`` are the artists with their ``key``.

    Artists of one name have one score. So a name gives no more than its n lowest ids, and only those n names of a
    query come into question that lead by score and lowest id: work is bounded by names, however many artists share one.
    """
    lowest = staged(head_per_group(named, key, n, F.col("artist_mbid").asc(), name="place"), "named")
    first = lowest.filter("place = 1").select(key, F.col("artist_mbid").alias("first"))
    best = head_per_group(scored.join(first, key), "query", n, F.col("score").desc(), F.col("first").asc(), name="place")
    met = best.select("query", key, "score").join(lowest.drop("place"), key)
    shown = met.select("query", *(c for c in named.columns if c != key), "score")
    return head_per_group(shown, "query", n, F.col("score").desc(), F.col("artist_mbid").asc())


def artists_sharing_word(queries: DataFrame, artists: DataFrame, n: int = SEARCH_RESULTS) -> DataFrame:
    """Up to n artists per searched name that share a word with it, best first.

    An artist is a candidate when its normalised name shares a word with the
    query; the score is 100 times the edit similarity of the normalised names.
    Queries meet distinct names, a pair once, on its first shared word, so no
    pair is scored twice; Spark keeps n rows per query within every task before
    the ranking shuffle.
    """
    q = queries.select("query", normalise_name(F.col("query")).alias("qn")).distinct()
    q = q.withColumn("qw", F.array_distinct(F.split("qn", " ")))
    extra = [c for c in ("country", "type", "disambiguation") if c in artists.columns]
    named = artists.select("artist_mbid", "name", *extra, normalise_name(F.col("name")).alias("an")).filter(F.col("an").isNotNull())
    names = named.select("an").distinct().withColumn("aw", F.array_distinct(F.split("an", " ")))
    left = _looked_up(q.withColumn("word", F.explode("qw")).filter("word <> ''"), "asked")
    right = names.withColumn("word", F.explode("aw")).filter("word <> ''")
    first = F.element_at(F.array_intersect("qw", "aw"), 1)
    pairs = right.hint("merge").join(left, "word").filter(F.col("word") == first)
    scored = pairs.select("query", "an", F.round(levenshtein_ratio(F.col("qn"), F.col("an")) * 100, 4).alias("score"))
    return _best_named(scored, named, "an", n)


def name_grams(name: Column) -> Column:
    """The numbered trigrams of a name with two marks before and after it: two more than it has characters."""
    marked = F.concat(F.lit("##"), name, F.lit("$$"))
    return numbered(F.transform(F.sequence(F.lit(1), F.length(name) + 2), lambda i: F.substring(marked, i, F.lit(3))))


def shared_grams(size: Column, least: float) -> Column:
    """How many trigrams two names share at least, the longer of ``size`` characters: an edit touches three."""
    return size + 2 - 3 * F.floor(size * F.lit(1.0 - least) + 1e-9)


def name_index(artists: DataFrame) -> DataFrame:
    """Inverted index (gram, size, folded, names, first_artist): a row per numbered trigram of every distinct folded name.

    The length is part of the key: a trigram that a third of all names hold is split by it, and a join never
    meets names whose length is too far from the query's. ``names`` counts the artists of the name, of which
    ``first_artist`` is the lowest. Write it once where searches follow one another.
    """
    names = artists.select("artist_mbid", fold_name(F.col("name")).alias("folded")).filter("folded <> ''")
    names = names.groupBy("folded").agg(F.count(F.lit(1)).alias("names"), F.min("artist_mbid").alias("first_artist"))
    return names.select(F.explode(name_grams(F.col("folded"))).alias("gram"), F.length("folded").alias("size"), "folded", "names", "first_artist")


def search_index(queries: DataFrame, index: DataFrame, artists: DataFrame, n: int = SEARCH_RESULTS, min_score: float = MIN_SCORE) -> DataFrame:
    """Up to n artists per searched name by their ``name_index``, best first: all whose score is ``min_score`` or more.

    The score is 100 times the edit similarity of the folded names (no accents, case, punctuation, leading article).
    Names of that score share at least a number of trigrams that grows with their length (an edit touches three
    of them). So of a query's trigrams all but that number less one are looked up, the rarest ones, and a name
    is kept if enough of them meet for the rest to make up the number. The exact score decides; no match is lost.
    """
    least = min_score / 100.0
    if least <= 2 / 3:
        raise ValueError("the least score must be above 66.7: below it names need not share a trigram")
    q = queries.select("query", fold_name(F.col("query")).alias("asked")).filter("asked <> ''").distinct().withColumn("m", F.length("asked"))
    q = q.withColumn("need", F.ceil(F.col("m") * F.lit(3 * least - 2) + 2 - 1e-9).cast("int"))
    common = index.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    asked = q.withColumn("gram", F.explode(name_grams(F.col("asked")))).join(common, "gram", "left")
    asked = head_per_group(asked, "query", 1 << 30, F.coalesce("held", F.lit(0)).asc(), F.col("gram").asc(), name="place")
    asked = asked.filter((F.col("place") <= F.col("m") + 3 - F.col("need")) & F.col("held").isNotNull())
    sizes = F.sequence(F.ceil(F.col("m") * F.lit(least) - 1e-9).cast("int"), F.floor(F.col("m") / F.lit(least) + 1e-9).cast("int"))
    asked = _looked_up(asked.select("query", "asked", "m", "need", "gram", F.explode(sizes).alias("size")), "asked")
    met = index.select("gram", "size", "folded").hint("merge").join(asked, ["gram", "size"])
    met = met.groupBy("query", "asked", "m", "need", "folded", "size").agg(F.count(F.lit(1)).alias("met"))
    enough = met.filter(F.col("met") + F.col("need") - 1 >= shared_grams(F.greatest("m", "size"), least))
    ratio = levenshtein_ratio(F.col("asked"), F.col("folded"))
    scored = enough.filter(ratio >= F.lit(least - 1e-9)).select("query", "folded", F.round(ratio * 100, 4).alias("score"))
    extra = [c for c in ("country", "type", "disambiguation") if c in artists.columns]
    named = artists.select("artist_mbid", "name", *extra, fold_name(F.col("name")).alias("folded")).filter("folded <> ''").distinct()
    return _best_named(scored, named, "folded", n)


def search_artists(queries: DataFrame, artists: DataFrame, n: int = SEARCH_RESULTS, min_score: float = MIN_SCORE) -> DataFrame:
    """Up to n artists per searched name, misspelt or not, best first; see ``search_index``."""
    return search_index(queries, name_index(artists), artists, n, min_score)
