"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, collocations, decontaminate, fingerprint, merkle, mixing, neighbours, quality, simhash, suffix_dedup, token_counts, toxicity, url_filter
from .oracles import merkle_sql, phrase_sql, window_sql


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(read(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_schedule(read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, read(spark, sf_dir, "labels")))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"))


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_source_mix, op3_token_counts, op4_toxicity, op5_simhash, op6_quality, op7_bpe_round_trip, op8_neighbours,
        op9_url_verdicts, op10_repeated_strings, op11_collocations, op12_contamination, op13_merkle_manifest,
    )
}
#: SQL has none of the other operators' hashes, tokenizers and learned models; the tests hold those against brute force.
ORACLE: dict[str, str] = {"op11_collocations": phrase_sql(), "op12_contamination": window_sql(), "op13_merkle_manifest": merkle_sql()}
