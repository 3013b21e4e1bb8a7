"""Years and decades out of dates of mixed precision (``1960``, ``1985-06-21``, ``Unknown``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def start_year(date_text: Column) -> Column:
    """Leading year, null where the text has none."""
    return F.split_part(date_text, F.lit("-"), F.lit(1)).try_cast("int")


def decade(date_text: Column) -> Column:
    return (F.floor(start_year(date_text) / 10) * 10).cast("int")


def decade_label(decade_start: Column) -> Column:
    return F.concat(decade_start.cast("string"), F.lit("s"))
