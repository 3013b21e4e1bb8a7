"""Helpers shared by the operators: column access, folds, text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5
#: Words of 64 bits in the filter of known ids: 2 MB at any size.
FILTER_WORDS = 1 << 18


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact spelling.

    Other columns, also ones that differ by case alone, never reach the operator.
    """
    at = [df.columns.index(n) for n in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(n) for i, n in zip(at, names)))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text is empty."""
    picked = columns_of(docs, id_col, text_col).toDF("doc_id", "text")
    return picked.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fold_of(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; -1 without an id, so such rows are neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS, F.lit(-1)).cast("int")


def labels_of(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) with one row per id that may be learned from; of clashing labels the larger counts."""
    known = columns_of(labels, "doc_id", label).toDF("doc_id", "label").dropna()
    return known.where(fold_of() > 0).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("int").alias("label"))


def map_texts(df: DataFrame, schema: str, make: Callable[[], Callable[[list], list]], carry: int = 1, rows: int | None = None) -> DataFrame:
    """Rows (carried columns..., text) through a function over whole texts, batch by batch.

    ``make`` runs once per task and returns the function, which turns a list of texts into one list of
    values per new column. The first ``carry`` columns pass through. Arrow carries the batches, of which ``rows`` at once
    are worked on (None: all), so that wide results never stand in memory for a whole batch.
    """
    fields = df.select().sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            step = rows or max(1, whole.num_rows)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                made = work(batch.column(carry).to_pylist())
                kept = [batch.column(i) for i in range(carry)]
                yield pa.RecordBatch.from_arrays(kept + [m if isinstance(m, pa.Array) else pa.array(m) for m in made], names=names)

    return df.mapInArrow(run, fields)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, fold: int | None = None) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents, the same ones each time.

    The chosen ids are bounded, so they are broadcast and the documents are scanned without a shuffle.
    """
    known = labels_of(labels, label)
    if fold is not None:
        known = known.where(fold_of() == fold)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts_of(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def likely_known(df: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``df`` whose doc_id may be among the known ones: a superset, found without a shuffle.

    A bit per hashed id, in a table of at most ``FILTER_WORDS`` rows, which is broadcast. It keeps texts that
    have no label out of the exchange while the known ids are not too many for it, and lets all through beyond.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(64 * FILTER_WORDS))
    word = F.floor(bit / 64).cast("int")
    words = known.select(word.alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))").alias("b")).groupBy("word").agg(F.bit_or("b").alias("bits"))
    met = df.withColumn("word", word).join(F.broadcast(words), "word")
    return met.where(F.expr("(shiftrightunsigned(bits, cast(pmod(xxhash64(doc_id), 64) as int)) & 1) = 1")).select(*df.columns)


def bit_table(df: DataFrame, *keys: str) -> DataFrame:
    """(cell, bits): a bit per hashed key, in at most ``FILTER_WORDS`` rows."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(64 * FILTER_WORDS))
    marks = df.select(F.floor(bit / 64).cast("int").alias("cell"), (bit % 64).cast("int").alias("at"))
    return marks.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))


def likely_in(df: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``df`` whose keys may be among those of a bit table: a superset, found without a shuffle."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(64 * FILTER_WORDS))
    met = df.withColumns({"cell": F.floor(bit / 64).cast("int"), "at": (bit % 64).cast("int")}).join(F.broadcast(table), "cell")
    return met.where(F.expr("(shiftrightunsigned(bits, at) & 1) = 1")).select(*df.columns)


def likely_split(df: DataFrame, table: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys may be among those of a bit table, rows whose keys surely are not), found without a shuffle."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(64 * FILTER_WORDS))
    met = df.withColumns({"cell": F.floor(bit / 64).cast("int"), "at": (bit % 64).cast("int")}).join(F.broadcast(table), "cell", "left")
    hit = F.expr("coalesce((shiftrightunsigned(bits, at) & 1) = 1, false)")
    return met.where(hit).select(*df.columns), met.where(~hit).select(*df.columns)
