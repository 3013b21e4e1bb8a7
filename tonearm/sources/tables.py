"""Dimension tables: CSV dumps (plain or zstd) and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STAGE_COLUMNS, STAGE_SCHEMAS
from .sinks import path_exists


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, columns: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header and double-quoted fields, as the columns of ``schema``.

    Columns are found by their names in the header, whatever their order and
    whatever else the file holds; types are declared, so only the header is
    read ahead. A value that does not fit its type becomes null; ``cast_failures``
    counts those. ``multi_line`` is for files with line breaks inside quotes: each
    is then read by one task.
    """
    wanted = [f for f in schema.fields if columns is None or f.name in columns]
    raw = _raw_csv(spark, path, multi_line)
    missing = [f.name for f in wanted if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no columns {missing}, only {raw.columns}")
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def _raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path)


def cast_failures(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """(column_name, rows, empty, failed): per column of ``schema`` its values that are missing and that do not fit its type. One scan."""
    raw = _raw_csv(spark, path, multi_line)
    known = [f for f in schema.fields if f.name in raw.columns]
    counts = [F.count(F.lit(1)).alias("rows")]
    for f in known:
        value = F.col(f.name)
        counts += [F.count_if(value.isNull()).alias(f"empty_{f.name}"), F.count_if(value.isNotNull() & value.try_cast(f.dataType).isNull()).alias(f"failed_{f.name}")]
    items = F.array(*(F.struct(F.lit(f.name).alias("column_name"), F.col(f"empty_{f.name}").alias("empty"), F.col(f"failed_{f.name}").alias("failed")) for f in known))
    return raw.agg(*counts).select("rows", F.explode(items).alias("c")).select("c.column_name", "rows", "c.empty", "c.failed")


def broken_records(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(record) of every line that has not as many fields as the header."""
    names = _raw_csv(spark, path, multi_line).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_record")])
    lines = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    found = lines.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").csv(path)
    # a condition that always holds asks for all columns: the parser skips fields that nobody reads, and then finds nothing broken
    read = F.concat_ws("", *names) >= F.lit("")
    return found.filter(F.col("_record").isNotNull() & read).select(F.col("_record").alias("record"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by its suffix (or as a folder), anything else as CSV."""
    if ".csv" in path.rsplit("/", 1)[-1]:
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return read_csv(spark, path, schema)
    return spark.read.parquet(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    read_csv(spark, source, schema, columns).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def head_rows(df: DataFrame, n: int | None) -> DataFrame:
    """Row-limited scan; all rows with None."""
    return df if n is None else df.limit(n)


def read_stage(spark: SparkSession, name: str, landed_root: str, raw_path: str | None = None, max_rows: int | None = None) -> DataFrame:
    """A dimension table: the landed Parquet if it is complete, else the raw CSV dump."""
    landed = f"{landed_root.rstrip('/')}/{name}.parquet"
    if path_exists(spark, landed):
        df = spark.read.parquet(landed)
    elif raw_path and path_exists(spark, raw_path):
        df = read_csv(spark, raw_path, STAGE_SCHEMAS[name], STAGE_COLUMNS[name])
    else:
        raise FileNotFoundError(f"{name}: neither {landed} nor {raw_path}")
    return head_rows(df, max_rows)
