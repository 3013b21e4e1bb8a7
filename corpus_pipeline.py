"""The corpus pipeline: five stages over documents, each written to Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tonearm.llm import bpe_codec, mixing, quality, simhash, suffix_dedup
from tonearm.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more; the classifier learns from the labelled ones among all documents."""
    every = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_quality(docs, quality.fit_quality(every, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose fingerprints of three-word shingles link at two or fewer bits."""
    return simhash.without_near_copies(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that also start elsewhere; emptied documents stay, empty."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources up to 1.5 times, by temperature; every document at least once."""
    return mixing.mixed(docs)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, with the digests of ids and of the text decoded from them."""
    return bpe_codec.encoded_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", to_weights),
    ("BPE encoding and decoding", to_ids),
]
#: Tokenizer, classifier and fingerprints can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
