"""Stand-alone aggregate operators (G6, G8, G11, G14-G16, G21-G24) over the
catalogue models. All are ``groupBy`` plans with partial aggregation;
medians, modes and percentiles keep value -> count buffers, so their size
follows the distinct values, not the rows of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.functions import exprs as X
from grimlake.operators import ranks
from grimlake.operators.distinct import bit, with_distinct
from grimlake.operators.percentiles import percentiles
from grimlake.plans import marts

PERCENTILES = (0.25, 0.5, 0.75, 0.9)


def median_by_year(temporal_base: DataFrame) -> DataFrame:
    """Exact continuous median of review scores per release year, of scores
    counted by album."""
    return (temporal_base.where(F.col("score_album").isNotNull()).groupBy("album_year")
            .agg(marts.weighted_median().alias("median_score")))


def dominant_subgenre_by_year(temporal_base: DataFrame) -> DataFrame:
    """Most frequent subgenre per year (rows counted with fan-out)."""
    return marts.dominant_by_rows(temporal_base, ["album_year"], "death_metal_subgenre", "dominant_subgenre")


def dominant_era_by_country(geographic_base: DataFrame) -> DataFrame:
    """Most frequent formation era per (country, continent)."""
    return ranks.dominant_value(geographic_base.where(F.col("formation_era").isNotNull()),
                                ["country", "continent"], "formation_era", "dominant_era")


def conditional_distinct(temporal_base: DataFrame) -> DataFrame:
    """G6 + G8: distinct counts (bitmaps) and an average restricted by a condition."""
    debut = F.col("is_debut_album") == 1
    out = temporal_base.groupBy("album_year").agg(marts.weighted_mean(debut).alias("avg_debut_score"))
    return with_distinct(out, temporal_base, ["album_year"], {
        "active_bands": F.when(F.col("n_rev") > 0, bit("band_id")), "debut_albums": F.when(debut, bit("album_id"))})


def safe_percent(band_metrics: DataFrame) -> DataFrame:
    """Guarded percentages (null when a band has no review)."""
    return band_metrics.select("band_id", "total_reviews", "pct_high_quality", "pct_excellent")


def safe_ratio(band_metrics: DataFrame) -> DataFrame:
    """Reviews per album with the safe-divide macro (0 albums -> null)."""
    return band_metrics.select(
        "band_id", X.safe_divide("total_reviews", "total_albums").alias("reviews_per_album"))


def mode_value(dim_albums: DataFrame) -> DataFrame:
    """Most frequent release year per band, ties to the smallest year."""
    return ranks.dominant_value(dim_albums, "band_id", "album_year", "mode_album_year")


def stddev_by_band(fct: DataFrame) -> DataFrame:
    """Sample standard deviation of scores per band (null for one review)."""
    return fct.groupBy("band_id").agg(
        F.count("score_album").alias("n_scores"),
        X.stddev("score_album").alias("score_stddev"))


def percentile_any(fct: DataFrame, percentages=PERCENTILES) -> DataFrame:
    """Exact continuous percentiles of the score per release decade, from
    range cells of counted scores."""
    return percentiles(fct, ["release_decade"], "score_album",
                       {f"p{int(round(p * 100))}_score": p for p in percentages})


def approx_top_value(fct: DataFrame, k: int = 1) -> DataFrame:
    """Approximate most frequent subgenre per decade (sketch-based
    ``approx_top_k``; mergeable partial buffers)."""
    top = F.expr(f"approx_top_k(death_metal_subgenre, {max(k, 32)})")
    # Among values with the highest count, the smallest.
    best = F.expr("array_min(transform(filter(_top, x -> x.count = _top[0].count), x -> x.item))")
    return (fct.where(F.col("death_metal_subgenre").isNotNull()).groupBy("release_decade").agg(top.alias("_top"))
            .select("release_decade", best.alias("top_subgenre"), F.col("_top")[0]["count"].alias("top_count")))


def top_value_state(fct: DataFrame, tracked: int = 1000) -> DataFrame:
    """(release_decade, state) of one load: a sketch of at most ``tracked``
    subgenres. Counts of a decade are exact while it has fewer kinds than three
    quarters of ``tracked``, else off by at most 3.5 / tracked of its rows."""
    return (fct.where(F.col("death_metal_subgenre").isNotNull()).groupBy("release_decade")
            .agg(F.expr(f"approx_top_k_accumulate(death_metal_subgenre, {tracked})").alias("state")))


def top_value_of_states(states: DataFrame, k: int = 32) -> DataFrame:
    """The most frequent subgenre per decade over the states of any number of loads."""
    merged = states.groupBy("release_decade").agg(F.expr("approx_top_k_combine(state)").alias("state"))
    best = F.expr("array_min(transform(filter(_top, x -> x.count = _top[0].count), x -> x.item))")
    return merged.select("release_decade", F.expr(f"approx_top_k_estimate(state, {k})").alias("_top")).select(
        "release_decade", best.alias("top_subgenre"), F.col("_top")[0]["count"].alias("top_count"))
