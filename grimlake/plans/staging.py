"""Staging models (M1): rename, trim, cast, key filters.

Filters sit directly on the scan so Catalyst pushes ``IsNotNull`` into the
Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.functions import exprs as X


def stg_bands(raw_bands: DataFrame) -> DataFrame:
    return (raw_bands
            .where(F.col("id").isNotNull())
            .select(X.try_long("id").alias("band_id"),
                    F.trim("name").alias("band_name"),
                    F.trim("country").alias("country"),
                    F.trim("status").alias("status"),
                    X.try_int("formed_in").alias("formed_year"),
                    F.trim("genre").alias("genre"),
                    F.trim("theme").alias("theme"),
                    F.trim("active").alias("active_periods")))


def stg_albums(raw_albums: DataFrame) -> DataFrame:
    return (raw_albums
            .where(F.col("id").isNotNull() & F.col("band").isNotNull())
            .select(X.try_long("id").alias("album_id"),
                    F.col("band").alias("band_id"),
                    F.trim("title").alias("album_title"),
                    X.try_int("year").alias("album_year")))


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    """A null review id is kept; only a null album drops the row."""
    return (raw_reviews
            .where(F.col("album").isNotNull())
            .select(X.try_long("id").alias("review_id"),
                    F.col("album").alias("album_id"),
                    F.trim("title").alias("review_title"),
                    X.try_decimal("score").alias("score_album"),
                    F.col("content").alias("content_review")))
