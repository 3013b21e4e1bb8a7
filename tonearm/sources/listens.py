"""Listen files: JSON lines, one folder of monthly files, plain or zstd-compressed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_LISTEN

ROWS_PER_FILE = 10_000_000  # about 250 MB of two id columns


def parse_months(text: str) -> list[int]:
    """``1-3`` or ``1,3,5``."""
    if "-" in text:
        first, last = (int(x) for x in text.split("-"))
        return list(range(first, last + 1))
    return [int(x) for x in text.split(",")]


def message_id(raw_prefix: str = "") -> Column:
    """First message id that is present: top level, track metadata, additional info."""
    p = raw_prefix
    return F.coalesce(
        F.col(f"{p}recording_msid"),
        F.col(f"{p}track_metadata.recording_msid"),
        F.col(f"{p}track_metadata.additional_info.recording_msid"),
    )


def read_raw_listens(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Listen documents with the declared schema; only the four id fields are parsed.

    A line that is no JSON object has nulls and its text in ``_corrupt_record``.
    """
    return spark.read.schema(RAW_LISTEN).option("mode", "PERMISSIVE").json(paths)


def extract_listens(raw: DataFrame, keep_null_msid: bool = False) -> DataFrame:
    """(user_id, recording_msid), one row per play.

    ``keep_null_msid`` is for profiling: only rows without a user are left out.
    """
    listens = raw.select("user_id", message_id().alias("recording_msid"))
    return listens.dropna(subset=["user_id"] if keep_null_msid else ["user_id", "recording_msid"])


def line_quality(raw: DataFrame) -> DataFrame:
    """One row: lines, malformed lines, lines without a user or message id, and usable ones."""
    msid = message_id()
    malformed = F.col("_corrupt_record").isNotNull() & F.col("user_id").isNull() & msid.isNull()
    usable = F.col("user_id").isNotNull() & msid.isNotNull()
    kinds = raw.select(F.when(usable, "usable").when(malformed, "malformed").otherwise("missing_key").alias("kind"))
    return kinds.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("kind") == "malformed").alias("malformed"),
        F.count_if(F.col("kind") == "missing_key").alias("missing_key"),
        F.count_if(F.col("kind") == "usable").alias("usable"),
    )


def distinct_messages(listens: DataFrame) -> DataFrame:
    return listens.select("recording_msid").dropna().distinct()


def monthly_path(root: str, month: int, suffix: str = ".listens.zst") -> str:
    return f"{root.rstrip('/')}/{month}{suffix}"


def read_monthly_listens(spark: SparkSession, root: str, months: Iterable[int], suffix: str = ".listens.zst", keep_null_msid: bool = False) -> DataFrame:
    """(user_id, recording_msid, month) of all months in one read.

    The month is the leading number of the file name. A zstd file is one task;
    land the months as Parquet before working on them.
    """
    raw = read_raw_listens(spark, [monthly_path(root, m, suffix) for m in months])
    month = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.", 1).cast("int")
    listens = raw.select("user_id", message_id().alias("recording_msid"), month.alias("month"))
    return listens.dropna(subset=["user_id"] if keep_null_msid else ["user_id", "recording_msid"])


def land_listens(listens: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write (user_id, recording_msid, month) as Parquet, one folder per month.

    Only the months present in the frame are replaced. Rows keep the read
    partitioning: a month with most of the rows is written by many tasks, and
    the one task of a zstd file still writes files of a bounded size.
    """
    writer = listens.write.mode(mode).partitionBy("month").option("maxRecordsPerFile", ROWS_PER_FILE)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_landed_listens(spark: SparkSession, path: str, months: Iterable[int] | None = None) -> DataFrame:
    """Landed listens; ``months`` prunes folders before anything is read."""
    df = spark.read.schema("user_id LONG, recording_msid STRING, month INT").parquet(path)
    return df if months is None else df.filter(F.col("month").isin(list(months)))
