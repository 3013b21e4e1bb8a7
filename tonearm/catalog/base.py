"""Registry: a query takes the tables of one data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.adapters import Tables, over_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = True, recursive: bool = False):
    """Register a query. ``sql`` sees the listening-history views unless ``views`` is off."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = over_views(sql, recursive) if views else sql.strip()
        return fn

    return register


def r6(column: str | Column, name: str | None = None) -> Column:
    """Rounded double: sums of doubles differ in their last digits with the order of rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), 6).alias(name or column)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[r6(c) if c in columns else F.col(c) for c in df.columns])
