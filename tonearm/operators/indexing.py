"""Dense 0-based positions without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import staged

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_row_index(df: DataFrame, *order: Column, name: str = "idx") -> DataFrame:
    """Add the position of each row in ``order``, which must be total.

    Rows are range-partitioned and sorted locally; a partition's first position
    is the row count of those before it. The numbered rows are written once, so
    positions and offsets come from the same partitioning even when executors
    are lost between them. The only window runs over one row per partition.
    """
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    rows = staged(numbered, "index")
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = rows.withColumn("_part", part).withColumn("_row", row)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    return (
        rows.join(offsets, "_part")
        .withColumn(name, F.col("_off") + F.col("_row"))
        .drop("_mid", "_part", "_row", "_off")
    )


def dense_index(df: DataFrame, id_col: str, name: str = "idx") -> DataFrame:
    """(id, position) of the distinct ids in ascending order."""
    return with_row_index(df.select(id_col).dropna().distinct(), F.col(id_col).asc(), name=name)
