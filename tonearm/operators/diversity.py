"""Countries, genres and decades of a set of artists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import count_label, decade, decade_label
from ..schemas import UNKNOWN, UNKNOWN_ARTIST


def enrich_artists(artists: DataFrame, metadata: DataFrame, id_col: str = "artist_id") -> DataFrame:
    """Left join of metadata with defaults where an artist has none; tags, end date and type where the table has them."""
    defaults = {"tags": F.array().cast("array<string>"), "end_date": F.lit(UNKNOWN), "type": F.lit(UNKNOWN)}
    more = [c for c in defaults if c in metadata.columns]
    known = metadata.select(F.col("artist_mbid").alias(id_col), "name", "country", "genres", "start_date", *more)
    empty = F.array().cast("array<string>")
    return artists.join(known, id_col, "left").select(
        *artists.columns,
        F.coalesce("name", F.lit(UNKNOWN_ARTIST)).alias("name"),
        "country",
        F.coalesce("genres", empty).alias("genres"),
        F.coalesce("start_date", F.lit(UNKNOWN)).alias("start_date"),
        *(F.coalesce(c, defaults[c]).alias(c) for c in more),
    )


def country_distribution(df: DataFrame) -> DataFrame:
    known = df.filter(F.col("country").isNotNull() & (F.col("country") != UNKNOWN))
    return known.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def genre_distribution(df: DataFrame) -> DataFrame:
    genres = df.select(F.explode("genres").alias("genre")).filter(F.col("genre").isNotNull() & (F.col("genre") != ""))
    return genres.groupBy("genre").agg(F.count(F.lit(1)).alias("n"))


def top_genres(genres: DataFrame, n: int = 15) -> DataFrame:
    return genres.orderBy(F.col("n").desc(), F.col("genre")).limit(n)


def decade_distribution(df: DataFrame) -> DataFrame:
    dated = df.select(decade(F.col("start_date")).alias("decade")).filter(F.col("decade").isNotNull())
    return dated.groupBy("decade").agg(F.count(F.lit(1)).alias("n")).withColumn("label", decade_label(F.col("decade")))


def country_chart(countries: DataFrame, most: int = 8, keep: int = 7) -> DataFrame:
    """Labelled chart rows: the ``keep`` largest and ``Other`` once there are more than ``most``.

    The input holds one row per country.
    """
    number = countries.agg(F.count(F.lit(1))).scalar()
    ranked = countries.withColumn("rank", F.row_number().over(W.orderBy(F.col("n").desc(), F.col("country"))))
    grouped = F.when((number > most) & (F.col("rank") > keep), F.lit("Other")).otherwise(F.col("country"))
    return (
        ranked.groupBy(grouped.alias("country"))
        .agg(F.sum("n").alias("n"))
        .withColumn("label", count_label(F.col("country"), F.col("n")))
    )
