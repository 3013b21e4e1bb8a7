"""Writers: Parquet stages, CSV exports, JSON datasets, models; and stage reuse."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import slug
from ..session import local_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names (glob patterns allowed)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def stage_path(root: str, name: str, params: Mapping[str, object] | None = None) -> str:
    """Path of a stage's output. Parameters are part of it, so other ones never reuse it."""
    if not params:
        return f"{root.rstrip('/')}/{name}.parquet"
    text = json.dumps(params, sort_keys=True, default=str)
    return f"{root.rstrip('/')}/{name}-{hashlib.md5(text.encode()).hexdigest()[:10]}.parquet"


def materialise(spark: SparkSession, build: Callable[[], DataFrame], path: str, force: bool = False) -> DataFrame:
    """The stage at ``path``, built and written only if it is not there complete."""
    if force or not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_counts_csv(counts: DataFrame, path: str) -> None:
    """Counts as CSV with header, globally sorted by user and artist (range-partitioned)."""
    counts.orderBy("user_id", "artist_id").write.mode("overwrite").option("header", True).csv(path)


def write_recommendations(recommendations: DataFrame, path: str) -> None:
    """One folder per seed, named by the seed's slug, with one CSV of its rows in it.

    Where several seeds have one slug, as all of unknown name do, the id follows it. The file holds the seed's
    name as it is, which a slug does not. A seed has at most the number of rows that was asked for, so one task each
    is bounded.
    """
    # A name without letters or digits would leave an empty folder name.
    name = F.when(slug(F.col("source_artist")) == "", F.col("source_artist_id")).otherwise(slug(F.col("source_artist")))
    named = recommendations.withColumn("source_artist_slug", name)
    shared = named.groupBy("source_artist_slug").agg((F.min("source_artist_id") != F.max("source_artist_id")).alias("shared"))
    folder = F.when(F.col("shared"), F.concat_ws("-", "source_artist_slug", "source_artist_id")).otherwise(F.col("source_artist_slug"))
    columns = ("source_artist_id", "source_artist", "rank", "artist_id", "artist_name", "similarity_score")
    rows = (
        named.join(shared, "source_artist_slug")
        .withColumn("source_artist_slug", folder)
        .repartition("source_artist_slug")
        .sortWithinPartitions("source_artist_slug", "source_artist_id", "rank")
    )
    local = local_path(recommendations.sparkSession, path)
    if local is not None:
        lines = rows.select("source_artist_slug", F.to_csv(F.struct(*columns)))
        _write_local_folders(lines, local, "source_artist_slug", ",".join(columns))
    else:
        rows.select("source_artist_slug", *columns).write.mode("overwrite").partitionBy("source_artist_slug").option("header", True).csv(path)


# What Spark writes in place of characters of a folder's name, and of no name.
_ESCAPES = {ord(c): f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _write_local_folders(lines: DataFrame, path: str, column: str, header: str) -> None:
    """Rows of (folder, CSV line), those of a folder next to each other, as ``partitionBy`` lays them out, a file per folder.

    Spark's writer would start a process to set the mode of every folder, file and checksum, as Hadoop does on a local file
    system without its native library: some 8 ms a folder. Here the tasks make them. A file is moved to its place when
    it is whole, under one name, so a task that runs again changes nothing; the whole is moved to its place at the end.
    """
    parent, name = os.path.split(path.rstrip("/"))
    made = f"{parent}/.{name}-{uuid.uuid4().hex}"
    file = f"part-{uuid.uuid4().hex}.csv"
    escapes, no_name = _ESCAPES, _NO_NAME

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, out, folders = f"{made}/_temporary/{uuid.uuid4().hex}", None, None, 0

        def end() -> None:
            out.close()
            target = f"{made}/{column}={now.translate(escapes) or no_name}"
            os.makedirs(target, exist_ok=True)
            os.replace(part, f"{target}/{file}")

        for batch in batches:
            for folder, line in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                if folder != now:
                    if now is not None:
                        end()
                    now, folders = folder, folders + 1
                    out = open(part, "w", encoding="utf-8", newline="")
                    out.write(f"{header}\n")
                out.write(f"{line}\n")
        if now is not None:
            end()
        yield pa.RecordBatch.from_pydict({"folders": pa.array([folders], pa.int64())})

    os.makedirs(f"{made}/_temporary")
    try:
        lines.mapInArrow(run, "folders long").agg(F.sum("folders")).collect()
        shutil.rmtree(f"{made}/_temporary")
        open(f"{made}/_SUCCESS", "w").close()
        if os.path.lexists(path):
            shutil.rmtree(path) if os.path.isdir(path) and not os.path.islink(path) else os.remove(path)
        os.rename(made, path)
    except BaseException:
        shutil.rmtree(made, ignore_errors=True)
        raise


def write_json(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A report dataset as JSON lines. ``one_file`` is for one-row and top-k datasets."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def content_fingerprint(df: DataFrame) -> str:
    """Hash of a table's rows, whatever their order and files. One aggregate scan."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(*df.columns)).alias("x"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s"),
    ).first()
    return hashlib.md5(f"{df.columns}-{row['n']}-{row['x']}-{row['s']}".encode()).hexdigest()[:10]


def save_model(model: ALSModel, artist_index: DataFrame, user_index: DataFrame, root: str, fingerprint: str) -> str:
    """Model and index tables below a folder named by the data's fingerprint."""
    path = f"{root.rstrip('/')}/model-{fingerprint}"
    artist_index.write.mode("overwrite").parquet(f"{path}/artists.parquet")
    user_index.write.mode("overwrite").parquet(f"{path}/users.parquet")
    model.write().overwrite().save(f"{path}/als")
    return path


def load_model(spark: SparkSession, root: str, fingerprint: str) -> tuple[ALSModel, DataFrame, DataFrame] | None:
    """(model, artist index, user index) for this data, or None. The model is written last."""
    path = f"{root.rstrip('/')}/model-{fingerprint}"
    if not is_complete(spark, f"{path}/als/metadata") or not is_complete(spark, f"{path}/als/itemFactors"):
        return None
    model = ALSModel.load(f"{path}/als")
    return model, spark.read.parquet(f"{path}/artists.parquet"), spark.read.parquet(f"{path}/users.parquet")
