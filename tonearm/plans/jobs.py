"""From raw dumps to counts, model and recommendations, stage by stage."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Iterable, Sequence

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import recommend
from ..operators.profile import mapping_coverage
from ..operators.resolve import filter_match_levels, match_levels, restrict_mapping, user_artist_counts
from ..schemas import DEFAULT_MATCH_LEVELS, DEFAULT_SEEDS, STAGE_COLUMNS, STAGE_SCHEMAS
from ..sources import sinks
from ..sources.listens import distinct_messages, land_listens, read_landed_listens, read_monthly_listens
from ..sources.sinks import materialise, path_exists, stage_path
from ..sources.tables import read_csv


def land_months(spark: SparkSession, data_root: str, work_root: str, months: Sequence[int], suffix: str = ".listens.zst", force: bool = False) -> DataFrame:
    """Land the months that are not there yet; returns the requested ones."""
    target = f"{work_root.rstrip('/')}/listens.parquet"
    missing = [m for m in months if force or not path_exists(spark, f"{target}/month={m}/*.parquet")]
    if missing:
        land_listens(read_monthly_listens(spark, data_root, missing, suffix), target)
    return read_landed_listens(spark, target, months)


def land_dimension(spark: SparkSession, name: str, source: str, work_root: str, force: bool = False) -> DataFrame:
    """One dimension table as Parquet, only the columns that are used."""
    columns = STAGE_COLUMNS[name]
    return materialise(
        spark, lambda: read_csv(spark, source, STAGE_SCHEMAS[name], columns), stage_path(work_root, name), force
    )


def land_mapping(spark: SparkSession, source: str, work_root: str, listens: DataFrame, months: Sequence[int], levels: Iterable[str] = DEFAULT_MATCH_LEVELS, force: bool = False) -> DataFrame:
    """Mapping rows of the accepted levels for the message ids that occur."""
    levels = match_levels(levels)
    raw = read_csv(spark, source, STAGE_SCHEMAS["msid_mapping"], STAGE_COLUMNS["msid_mapping"])
    path = stage_path(work_root, "msid_mapping", {"levels": sorted(levels), "months": sorted(months)})
    return materialise(spark, lambda: restrict_mapping(raw, distinct_messages(listens), levels), path, force)


def build_counts(
    spark: SparkSession,
    data_root: str,
    work_root: str,
    months: Sequence[int],
    sources: dict[str, str],
    levels: Iterable[str] = DEFAULT_MATCH_LEVELS,
    suffix: str = ".listens.zst",
    force: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame, str]:
    """(counts, mapping quality, path of the counts).

    ``sources`` names the CSV dump of ``msid_mapping``, ``canonical_redirects``
    and ``canonical_data``; ``options`` go to ``user_artist_counts``. Every
    stage is kept as Parquet and used again by the next run.
    """
    levels = match_levels(levels)
    listens = land_months(spark, data_root, work_root, months, suffix, force)
    mapping = land_mapping(spark, sources["msid_mapping"], work_root, listens, months, levels, force)
    redirects = land_dimension(spark, "canonical_redirects", sources["canonical_redirects"], work_root, force)
    canonical = land_dimension(spark, "canonical_data", sources["canonical_data"], work_root, force)
    params = {"months": sorted(months), "levels": sorted(levels), **options}
    path = stage_path(work_root, "user_artist_counts", params)
    counts = materialise(
        spark, lambda: user_artist_counts(listens, mapping, redirects, canonical, levels, **options), path, force
    )
    quality = mapping_coverage(listens, filter_match_levels(mapping, levels))
    return counts, quality, path


def model_key(counts: DataFrame, **options) -> str:
    """Names a model by its data and by all parameters of the fit, given or default."""
    defaults = {k: p.default for k, p in inspect.signature(recommend.train_model).parameters.items() if p.default is not p.empty}
    settings = sorted((defaults | options).items())
    weighting = [(k, p.default) for k, p in inspect.signature(recommend.bm25_weights).parameters.items() if p.default is not p.empty]
    return f"{sinks.content_fingerprint(counts)}-{hashlib.md5(repr((settings, weighting)).encode()).hexdigest()[:8]}"


def model_for(spark: SparkSession, counts: DataFrame, work_root: str, force: bool = False, **options) -> tuple[ALSModel, DataFrame]:
    """(model, artist index), trained unless one for the same data and parameters is saved."""
    fingerprint = model_key(counts, **options)
    if not force:
        saved = sinks.load_model(spark, work_root, fingerprint)
        if saved is not None:
            return saved[0], saved[1]
    weighted = recommend.bm25_weights(counts)
    artist_index = recommend.dense_index(counts, "artist_id", "item_idx")
    user_index = recommend.dense_index(counts, "user_id", "user_idx")
    entries = recommend.matrix_entries(weighted.withColumnRenamed("weight", "listen_count"), artist_index, user_index)
    model = recommend.train_model(entries.withColumnRenamed("listen_count", "weight"), **options)
    sinks.save_model(model, artist_index, user_index, work_root, fingerprint)
    return model, artist_index


def recommendations_for(
    spark: SparkSession,
    counts: DataFrame,
    model: ALSModel,
    artist_index: DataFrame,
    artists: DataFrame,
    requested: Sequence[str] | None = None,
    defaults: Sequence[str] = DEFAULT_SEEDS,
    n: int = recommend.SIMILAR_ITEMS,
) -> DataFrame:
    ids = spark.createDataFrame([(a,) for a in requested], "artist_id string") if requested else None
    seeds = recommend.select_seeds(counts, ids, defaults)
    return recommend.recommend(seeds, recommend.artist_factors(model, artist_index), artists, n)
