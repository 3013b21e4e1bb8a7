"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is a multiset of paragraphs (its lines). Each paragraph hashes to a wide vector; a document's fingerprint
is their sum, lane by lane, modulo powers of two. The order of paragraphs does not matter, and adding or
subtracting a paragraph's vector inserts or deletes it (``inserted``, ``deleted``). The vector has

* eight 32-bit lanes from the paragraph's SHA-256, which decide equality;
* the number of its word pairs, and 64 lanes of 32 bits that count, per bit, the paragraph's word pairs whose hash has
  the bit set. Twice the count less the number is a sum of random signs, so dot products of two documents'
  lanes estimate how many word pairs they share: that is their likeness.

A null or empty text has no paragraphs: all lanes are zero, equal to one another and unlike any other. Rows are
ordered by descending id, equal ids by text, null ids last; repeated rows stay. Equality lanes wrap by
design; a count of 32 bits holds the word pairs of any text that fits in a string. An empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import texts_of

EQUAL_LANES, PACKED = 8, 32
WORD = (1 << 32) - 1
#: Two lanes of 32 bits in a long: those of a bit and of the one 32 places up.
ONES = 0x0000000100000001
PAIRS = r"(?=(\S+(?:[^\S\n]+\S+)?))\S+"
#: Rows of a stretch in the order of ids, and the most stretches; their heads are broadcast.
STRETCH, STRETCHES, COARSE = 4000, 1 << 16, 256


def paragraph_digests(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256)))


def pair_hashes(text: Column) -> Column:
    """A hash of each word with the next one of its paragraph; the last word stands alone."""
    return F.transform(F.regexp_extract_all(text, F.lit(PAIRS), F.lit(1)), lambda x: F.xxhash64(x))


def lanes(digests: Column, pairs: Column) -> Column:
    """The vector: equality lanes, number of word pairs, packed likeness lanes."""
    zero = F.lit(0).cast("long")

    def equal(i: int) -> Column:
        return F.aggregate(digests, zero, lambda a, d: (a + F.conv(F.substring(d, 1 + 8 * i, 8), 16, 10).cast("long")).bitwiseAND(F.lit(WORD)))

    def packed(i: int) -> Column:
        return F.aggregate(pairs, zero, lambda a, h: a + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(ONES)))

    return F.array(*map(equal, range(EQUAL_LANES)), F.size(pairs).cast("long"), *map(packed, range(PACKED)))


def combined(a: Column, b: Column, sign: int) -> Column:
    """a plus or minus b, lane by lane."""

    def lane(x: Column, y: Column, i: Column) -> Column:
        low = (x.bitwiseAND(F.lit(WORD)) + sign * y.bitwiseAND(F.lit(WORD))).bitwiseAND(F.lit(WORD))
        high = F.shiftleft(F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32), 32)
        return F.when(i < EQUAL_LANES, low).when(i == EQUAL_LANES, x + sign * y).otherwise(high.bitwiseOR(low))

    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z, i: lane(z["x"], z["y"], i))


def inserted(fingerprint: Column, paragraphs: Column) -> Column:
    """The fingerprint after more paragraphs, given by theirs."""
    return combined(fingerprint, paragraphs, 1)


def deleted(fingerprint: Column, paragraphs: Column) -> Column:
    return combined(fingerprint, paragraphs, -1)


def as_text(vector: Column) -> Column:
    """Fixed-width lower-case hexadecimal digits of all lanes."""
    return F.lower(F.concat_ws("", F.transform(vector, lambda x, i: F.lpad(F.hex(x), F.when(i < EQUAL_LANES, 8).otherwise(16), F.lit("0")))))


def unpacked(vector: Column) -> Column:
    """64 sums of random signs: twice each count less the number."""
    number = F.element_at(vector, EQUAL_LANES + 1)
    held = F.slice(vector, EQUAL_LANES + 2, PACKED)
    counts = F.concat(F.transform(held, lambda x: x.bitwiseAND(F.lit(WORD))), F.transform(held, lambda x: F.shiftrightunsigned(x, 32)))
    return F.transform(counts, lambda c: (2 * c - number).cast("double"))


def likeness(a: Column, b: Column, signs_a: Column, signs_b: Column) -> Column:
    """Share of word pairs in common, 2ab/(aa+bb) estimated from the lanes, from 0 to 1; 1 for equal fingerprints."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    norms = dot(signs_a, signs_a) + dot(signs_b, signs_b)
    return F.when(a == b, 1.0).when(norms == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * dot(signs_a, signs_b) / norms)))


def equal_lanes(digests: Column) -> Column:
    return F.slice(lanes(digests, F.array().cast("array<bigint>")), 1, EQUAL_LANES)


def summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, vector) of (keys, text); the keys name a row.

    Word pairs are exploded and added up by compiled sums, two lanes to a long so that no count reaches the next
    lane. Rows that are partitioned by one of the keys are not shuffled again.
    """
    split = rows.select(*keys, paragraph_digests(F.col("text")).alias("digests"), F.regexp_extract_all("text", F.lit(PAIRS), F.lit(1)).alias("pairs"))
    shown = split.select(*keys, equal_lanes(F.col("digests")).alias("equal"), "pairs")
    hashed = shown.select(*keys, "equal", F.explode_outer("pairs").alias("pair")).select(*keys, "equal", F.when(F.col("pair").isNotNull(), F.xxhash64("pair")).alias("h"))
    two = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(ONES))).alias(f"s{i}") for i in range(PACKED)]
    added = hashed.groupBy(*keys, "equal").agg(F.count("h").alias("number"), *two)

    held = (F.coalesce(F.col(f"s{i}"), F.lit(0)) for i in range(PACKED))
    return added.select(*keys, F.concat("equal", F.array(F.col("number"), *held)).alias("vector"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, vector) per row."""
    rows = texts_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return summed(rows, ["row", "doc_id"]).drop("row")


def stretch_of(rows: DataFrame) -> Column:
    """A number per row that rises with the id, for stretches of about equal size: quantiles, then even steps between two."""
    total, points = rows.agg(F.count("*"), F.percentile_approx("doc_id", [i / COARSE for i in range(COARSE + 1)], 10 * COARSE)).first()
    bounds = sorted(set(points or []))
    steps = max(1, math.ceil(min(total / STRETCH, STRETCHES) / COARSE))
    want = max(1, math.ceil(min(total / STRETCH, STRETCHES)))
    if want < COARSE and bounds:
        bounds = sorted({bounds[i * (len(bounds) - 1) // want] for i in range(want + 1)})
    if len(bounds) < 2:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0).cast("long")
    known = F.array(*(F.lit(b).cast("long") for b in bounds))
    part = F.greatest(F.lit(1), F.least(F.lit(len(bounds) - 1), F.size(F.filter(known, lambda b: b <= F.col("doc_id")))))
    low, high = F.element_at(known, part), F.element_at(known, part + 1)
    step = F.floor((F.col("doc_id") - low).cast("double") * steps / (high - low).cast("double"))
    inside = F.greatest(F.lit(0), F.least(F.lit(steps - 1), step))
    return F.coalesce(((part - 1) * steps + inside).cast("long"), F.lit(-1).cast("long"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text, the text with its last third replaced by the next document's start, and how alike they are.

    The next document has the next smaller id; after the last comes the first. Rows meet their neighbour in
    windows over stretches of ids; the first row of the following stretch is looked up in a table of heads, one
    per stretch and at most 65,536.
    """
    rows = texts_of(docs, id_col, text_col)
    rows = rows.withColumn("stretch", stretch_of(rows))
    tops = rows.groupBy("stretch").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy(F.desc("stretch"))
    first_stretch = F.first("stretch").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = tops.select("stretch", F.lead("stretch").over(order).alias("after"), first_stretch.alias("s0")).select("stretch", F.coalesce("after", "s0").alias("after"))
    named = tops.withColumnRenamed("stretch", "after")
    top_rows = rows.join(F.broadcast(named), (F.col("stretch") == F.col("after")) & F.col("doc_id").eqNullSafe(F.col("top"))).select("after", "text")
    heads = follows.join(top_rows.groupBy("after").agg(F.min("text").alias("head")), "after").select("stretch", "head")
    heads = heads.select("stretch", "head", paragraph_digests(F.col("head")).alias("hd"), pair_hashes(F.col("head")).alias("hp")).select("stretch", "head", lanes(F.col("hd"), F.col("hp")).alias("head_vector"))

    along = Window.partitionBy("stretch").orderBy(F.desc_nulls_last("doc_id"), "text")
    met = rows.select("*", F.lead("text").over(along).alias("follower"), F.row_number().over(along).alias("place")).join(heads.select("stretch", "head"), "stretch", "left")
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - third), F.substring(F.coalesce("follower", "head"), F.lit(1), third))
    met = met.select("stretch", "place", "doc_id", size.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    versions = F.array(*(F.struct(F.lit(i).alias("version"), F.col(c).alias("t")) for i, c in enumerate(("text", "edited"))))
    both = met.select("stretch", "place", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), versions.alias("versions"))
    both = both.select("stretch", "place", "doc_id", "n_chars", "edited_sha256", F.explode("versions").alias("v"))
    keys = ["stretch", "place", "version", "doc_id", "n_chars", "edited_sha256"]
    vectors = summed(both.select(*keys[:2], "v.version", *keys[3:], F.col("v.t").alias("text")), keys)
    beside = Window.partitionBy("stretch").orderBy("place", "version")
    own = F.col("vector")
    three = vectors.select("stretch", *keys[2:], own.alias("own"), F.lead(own, 1).over(beside).alias("changed"), F.lead(own, 2).over(beside).alias("next"))
    three = three.where("version = 0").join(heads.select("stretch", "head_vector"), "stretch", "left").withColumn("next", F.coalesce("next", "head_vector"))
    ready = three.select("*", unpacked(F.col("own")).alias("s1"), unpacked(F.col("changed")).alias("s2"), unpacked(F.col("next")).alias("s3"))
    return ready.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), F.col("s1"), F.col("s2")).alias("near_edited"), likeness(F.col("own"), F.col("next"), F.col("s1"), F.col("s3")).alias("near_next"),
    )
