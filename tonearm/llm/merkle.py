"""Merkle manifest of a dataset: a nested-struct rollup over the digits of each row's rank.

Every row is a leaf, the SHA-256 of its fields. Leaves rank by id within their language; the rank's octal digits
are grouped away one after another, each time nesting the children's structs in their parent, until a block of
512 ranks is one row. Blocks are leaves of the next tier, and so on to one row per language; the languages'
roots are rolled up in the same way. No row ever holds more than a block, and a block's exchange serves its
three aggregations.

Coming down, a block meets the path above it by a union and an aggregate on its key; ``transform`` over the nested
structs gives every child the hashes to its left and right, and ``explode`` emits the proofs. No join is used for
them. A proof is checked by folding: hash(left + own + right), level by level.

A null field is ``-`` and otherwise its UTF-8 length, ``:`` and its value, so nulls and empty texts differ. A
null language is a language of its own, the first; null ids come first in their language, equal ids in the order
of their leaves, so repeated rows have equal leaves and proofs of their own. An empty table has no root and gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.operators.indexing import with_row_index
from tonearm.session import staged

from .common import columns_of

#: Children of a node; octal digits of the rank that a block rolls up, and its ranks.
FAN, DIGITS = 8, 3
SPAN = FAN**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tampered_leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The leaf of the text with A-Z lower-cased, where 3 divides the id's crc32; elsewhere null."""
    hit = F.crc32(doc_id.cast("string")) % 3 == 0
    return F.when(hit, leaf_of(doc_id, source, lang, n_chars, F.translate(text, ascii_uppercase, ascii_lowercase)))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed) per row; the texts go no further."""
    rows = columns_of(docs, *FIELDS)
    values = [F.col(c) for c in FIELDS]
    return rows.select("doc_id", "lang", leaf_of(*values).alias("leaf"), tampered_leaf(*values).alias("changed"))


def ranked(leaf_rows: DataFrame) -> DataFrame:
    """Tier-0 nodes (g, n, rank, hash, below): g is the language, n its number of leaves."""
    order = [F.col(c).asc_nulls_first() for c in ("lang", "doc_id", "leaf", "changed")]
    placed = staged(with_row_index(leaf_rows, *order), "merkle-ranks")
    spans = placed.groupBy(F.col("lang").alias("g")).agg(F.min("idx").alias("start"), F.count("*").alias("n"))
    met = placed.join(spans, F.col("lang").eqNullSafe(F.col("g")))
    return met.select("g", "n", (F.col("idx") - F.col("start")).alias("rank"), F.col("leaf").alias("hash"), F.struct("doc_id", "changed").alias("below"))


def digit(level: int) -> Column:
    return F.pmod(F.shiftright("rank", 3 * level), F.lit(FAN)).cast("int")


def block_rows(nodes: DataFrame) -> DataFrame:
    """(g, n, block, hash, tree): nodes of each 512 ranks as one row of nested structs, with its top hash.

    A level hashes where more than one node is left on it, also a run of one; above that the hash passes on.
    """
    names = [f"d{level}" for level in range(DIGITS)]
    digits = [digit(level).alias(name) for level, name in enumerate(names)]
    rows = nodes.select("g", "n", F.shiftright("rank", 3 * DIGITS).alias("block"), *digits, "hash", "below").repartition("g", "block")
    for level, name in enumerate(names):
        kids = F.sort_array(F.collect_list(F.struct(name, "hash", "below"))).alias("below")
        rows = rows.groupBy("g", "n", "block", *names[level + 1 :]).agg(kids)
        joined = F.sha2(F.array_join("below.hash", ""), 256)
        rows = rows.withColumn("hash", F.when(F.col("n") > FAN**level, joined).otherwise(F.element_at("below.hash", 1)))
    return rows.select("g", "n", "block", "hash", F.col("below").alias("tree"))


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """Block tables, tier by tier; in the last one every group is a single block. The driver sees one number a tier."""
    tiers = []
    while True:
        blocks = staged(block_rows(nodes), "merkle-blocks")
        tiers.append(blocks)
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= SPAN:
            return tiers
        nodes = blocks.select("g", F.ceil(F.col("n") / SPAN).alias("n"), F.col("block").alias("rank"), "hash", F.struct("block").alias("below"))


def sides(kids: Column, at: Column) -> Column:
    """The hashes to the left and to the right of the child at a 0-based place."""
    hashes = kids["hash"]
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("l"), F.array_join(F.slice(hashes, at + 2, F.lit(FAN)), "").alias("r"))


def opened(blocks: DataFrame) -> DataFrame:
    """(g, hash, below, path, top): the nodes of blocks (g, n, tree, path, top), with their paths to the root."""
    tree = F.col("tree")
    levels = sum((F.col("n") > FAN**level).cast("int") for level in range(DIGITS))

    def emitted(kids: Column, steps: list[Column], depth: int) -> Column:
        def child(x: Column, i: Column) -> Column:
            path = [sides(kids, i), *steps]
            if depth:
                return emitted(x["below"], path, depth - 1)
            return F.struct(x["hash"].alias("hash"), x["below"].alias("below"), F.array(*path).alias("steps"))

        out = F.transform(kids, child)
        return F.flatten(out) if depth else out

    rows = blocks.select("g", "path", "top", levels.alias("levels"), F.explode(emitted(tree, [], DIGITS - 1)).alias("x"))
    return rows.select("g", "x.hash", "x.below", F.concat(F.slice("x.steps", F.lit(1), F.col("levels")), "path").alias("path"), "top")


def descended(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of all tier-0 nodes, from those of the topmost blocks: above is (g, block, path, top)."""
    for tier, blocks in reversed(list(enumerate(tiers))):
        both = blocks.select("g", "block", "n", "tree").unionByName(above, allowMissingColumns=True)
        met = both.groupBy("g", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "path", "top")))
        nodes = opened(met)
        if tier:
            above = nodes.select("g", F.col("below.block").alias("block"), "path", "top")
    return nodes


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda own, step: F.sha2(F.concat(step["l"], own, step["r"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: F.array(step["l"], step["r"]))), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed, subroot, root, path) per row; ``path`` holds the siblings, bottom up.

    ``changed`` is the leaf of the tampered row, null where the row is not tampered with.
    """
    tiers = climbed(ranked(staged(leaves(docs), "merkle-leaves")))
    tops = tiers[-1].select(F.col("g").alias("lang"), "hash")
    places = with_row_index(tops, F.col("lang").asc_nulls_first())
    n = tops.count()
    langs = climbed(places.select(F.lit("").alias("g"), F.lit(n).cast("long").alias("n"), F.col("idx").alias("rank"), "hash", F.struct("lang").alias("below")))
    no_path = F.array().cast("array<struct<l:string,r:string>>").alias("path")
    crown = langs[-1].select("g", "block", no_path, F.struct(F.col("hash").alias("root")).alias("top"))
    roots = descended(langs, crown)
    above = roots.select(F.col("below.lang").alias("g"), F.lit(0).cast("long").alias("block"), "path", F.struct("top.root", F.col("hash").alias("subroot")).alias("top"))
    rows = descended(tiers, above)
    return rows.select("below.doc_id", F.col("g").alias("lang"), F.col("hash").alias("leaf"), "below.changed", "top.subroot", "top.root", "path")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Each row's leaf, roots and proof digest, and whether the possibly tampered row still leads to the root."""
    rows = manifest(docs).select("*", folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
