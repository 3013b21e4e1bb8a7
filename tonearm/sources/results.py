"""Reading back results: recommendation files, report datasets, run logs."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_count, seed_name
from ..functions.text import SEED_FILE_PREFIX
from ..schemas import RECOMMENDATIONS
from ..session import listing_of_small_files, local_path

# Fixed value: the log line that holds the mapping counts.
MAPPING_LINE = r"MSID to MBID mapping:\s*([\d,]+) mapped.*?([\d,]+) unmapped"


def read_recommendation_files(spark: SparkSession, path: str) -> DataFrame:
    """All ``similar_to_*.csv`` files of a folder, the seed's name taken from the file name.

    Files of older runs without artist names have null there.
    """
    files = spark.read.option("header", True).option("escape", '"').option("pathGlobFilter", f"{SEED_FILE_PREFIX}*.csv").csv(path)
    fields = [
        (F.col(f.name).try_cast(f.dataType) if f.name in files.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in RECOMMENDATIONS.fields
    ]
    return files.select(seed_name(F.col("_metadata.file_name")).alias("source_artist"), *fields)


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """Recommendations as ``write_recommendations`` leaves them.

    The files hold all columns, so the folders' names are not parsed; a reader of some lines needs no buffer of a million.
    Folders on the plain local file system are listed and read by the tasks.
    """
    names = [T.StructField(n, T.StringType()) for n in ("source_artist_id", "source_artist")]
    schema = T.StructType([*names, *RECOMMENDATIONS.fields])
    local = local_path(spark, path)
    if local is not None and os.path.isdir(local):
        return _local_lines(spark, local).select(F.from_csv("line", schema.toDDL()).alias("r")).select("r.*")
    with listing_of_small_files(spark):
        return spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).option("inputBufferSize", 4096).csv(path)


def _local_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines of all files below a local folder, without blank ones and each file's first.

    Spark's readers take some 2 ms to open a file of a few lines and keep its name in the driver. Here every task lists the
    folder, of which it reads the entries that fall to it by their names. Hidden files are those that Spark does not read either.
    """
    tasks, blanks = 4 * spark.sparkContext.defaultParallelism, bytes(range(33))

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name)

    def files(folder: str, share: int | None = None) -> Iterator[str]:
        with os.scandir(folder) as entries:
            for entry in entries:
                if hidden(entry.name) or (share is not None and zlib.crc32(os.fsencode(entry.name)) % tasks != share):
                    continue
                if entry.is_dir():
                    yield from files(entry.path)
                else:
                    yield entry.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[str] = []
        for share in (x for batch in batches for x in batch.column(0).to_pylist()):
            for file in files(root, share):
                with open(file, "rb") as f:
                    found += [x.decode("utf-8", "replace") for x in f.read().splitlines()[1:] if x.strip(blanks)]
                if len(found) >= 10_000:
                    yield pa.RecordBatch.from_pydict({"line": pa.array(found, pa.string())})
                    found = []
        yield pa.RecordBatch.from_pydict({"line": pa.array(found, pa.string())})

    # Shares of an RDD have no size the planner could take for that of the lines.
    shares = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(tasks)], tasks), "share int")
    return shares.mapInArrow(run, "line string")


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def mapping_counts_from_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """(mapped_count, unmapped_count) of every log line that states them."""
    found = lines.filter(F.col(column).contains("MSID to MBID mapping:"))
    return found.select(
        parse_count(F.regexp_extract(column, MAPPING_LINE, 1)).alias("mapped_count"),
        parse_count(F.regexp_extract(column, MAPPING_LINE, 2)).alias("unmapped_count"),
    ).filter(F.col("mapped_count").isNotNull() & F.col("unmapped_count").isNotNull())


def read_mapping_counts(spark: SparkSession, path: str) -> DataFrame:
    return mapping_counts_from_text(spark.read.text(path))
