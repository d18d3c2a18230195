"""Analyst queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.operators import ranks


def top_bands(band_metrics: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` bands by average score among those with five or more
    reviews. The limit is the feature (planned as TakeOrderedAndProject:
    each task keeps its own top k). Ties go to the smaller band id."""
    return (band_metrics.where(F.col("has_substantial_catalog") == 1)
            .orderBy(F.col("avg_score").desc_nulls_last(), F.col("band_id").asc())
            .limit(k)
            .select("band_name", "total_albums", "avg_score", "pct_excellent"))


def country_list(geographic: DataFrame, min_bands: int = 10) -> DataFrame:
    """Countries with at least ``min_bands`` bands, most bands first. (The
    geographic mart carries no average score, so none is selected.)"""
    return (geographic.where(F.col("total_bands") >= min_bands)
            .orderBy(F.col("total_bands").desc(), F.col("country").asc_nulls_last())
            .select("country", "total_bands", "dominant_subgenre"))


def career_pattern(career: DataFrame) -> DataFrame:
    """Average score and row count per career position, best first."""
    return (career.groupBy("album_career_position")
            .agg(F.avg("score_album").alias("avg_score"), F.count(F.lit(1)).alias("total_albums"))
            .orderBy(F.col("avg_score").desc_nulls_last()))


def yearly_trend(temporal: DataFrame) -> DataFrame:
    """Yearly rows with decade, volume, quality and dominant subgenre."""
    return (temporal.select("release_decade", "album_year", "albums_released", "avg_score",
                            "dominant_subgenre")
            .orderBy("release_decade", "album_year")
            .drop("album_year"))


def score_evolution(fct_base: DataFrame, dim_bands: DataFrame, min_rows: int = 5) -> DataFrame:
    """Per band: reviews scoring above / below the previous review in
    release order (year, album id, review id, score), for bands with at least
    ``min_rows`` joined rows (HAVING)."""
    rows = fct_base.select("band_id", "album_id", "review_id", "album_year",
                           F.col("score_album").cast("double").alias("score_album"))
    timeline = ranks.lag_over(rows, "band_id", ["album_year", "album_id", "review_id", "score_album"],
                              "prev_score")
    s, prev = F.col("score_album"), F.col("prev_score")
    joined = timeline.join(dim_bands.select("band_id", "band_name"), "band_id", "inner")
    return (joined.groupBy("band_name")
            .agg(F.count(F.when(s > prev, 1)).alias("improvements"),
                 F.count(F.when(s < prev, 1)).alias("declines"),
                 F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= min_rows).drop("_n"))
