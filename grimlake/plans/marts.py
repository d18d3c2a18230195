"""Analysis marts M6-M10.

Each mart reproduces the catalogue's join fan-out exactly (D9): a band's
``sum(is_active_flag)`` counts it once per joined album or review row, as
the source does; the distinct counts are the unbiased ones.

Scale notes:
* All grouping is ``groupBy`` with partial aggregation; distinct bands and albums
  are bitmaps over dense numbers (``operators/distinct.py``); exact medians use
  ``percentile``, whose buffer is a value -> count map (bounded by the
  distinct scores, not the rows).
* M6, M9 and M10 read the fact counted by (album, score), which holds all
  they need of the reviews but distinct review ids (M10 reads those apart):
  one scan, no join of review rows, no hot album.
* Global ranks (W17) run over the finished mart rows (years, countries,
  subgenre x continent: tens to hundreds of rows), the only place a window
  without a partition key is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.functions import exprs as X
from grimlake.functions import rules as R
from grimlake.operators import ranks
from grimlake.operators.distinct import bit, labels, numbered, with_distinct
from grimlake.operators.joins import left_join_split, sized_join
from grimlake.sources.stage import stored_table


def _score() -> F.Column:
    return F.col("score_album").cast("double")


def _count_if(cond) -> F.Column:
    return F.sum(X.flag(cond)).cast("bigint")


# ---- per-album scores: what M6, M9 and M10 read of the fact ------------------------
def score_counts(fct: DataFrame) -> DataFrame:
    """(album_id, score_album, n, n_rev): the fact counted by album and score,
    in one scan. Averages, deviations, medians and conditional counts of its
    reviews all follow from it, and no album has more rows than scores."""
    return fct.groupBy("album_id", _score().alias("score_album")).agg(
        F.count(F.lit(1)).alias("n"), F.count("review_id").alias("n_rev"))


def with_scores(albums: DataFrame, fct: DataFrame) -> DataFrame:
    """Album rows with their score counts; ``rows`` is how many rows the join
    with the reviews themselves would have."""
    out = albums.join(score_counts(fct), "album_id", "left")
    return out.withColumn("rows", F.coalesce("n", F.lit(1)))


def _n_if(cond) -> F.Column:
    return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")


def weighted_mean(cond=None) -> F.Column:
    s, n = F.col("score_album"), F.col("n")
    cond = F.lit(True) if cond is None else cond
    return F.sum(F.when(cond, s * n)) / F.sum(F.when(cond & s.isNotNull(), n))


def _deviation() -> F.Column:
    """Sample standard deviation; sums are taken around the scores' centre."""
    d, n = F.col("score_album") - R.SCORE_CENTER, F.col("n")
    total = F.sum(F.when(d.isNotNull(), n))
    left = F.sum(d * d * n) - F.sum(d * n) * F.sum(d * n) / total
    return F.when(total > 1, F.sqrt(F.greatest(left, F.lit(0.0)) / (total - 1)))


def weighted_median() -> F.Column:
    return F.percentile(F.col("score_album"), F.lit(0.5), F.col("n"))


def dominant_by_rows(base: DataFrame, keys: list[str], value: str, out: str, nulls: bool = False) -> DataFrame:
    """Most frequent value by rows, the smallest of equals, null last; two
    plain aggregations."""
    rows = base if nulls else base.where(F.col(value).isNotNull())
    counts = rows.groupBy(*keys, value).agg(F.sum("rows").alias("_rows"))
    order = F.struct(-F.col("_rows"), F.col(value).isNull(), F.col(value))
    return counts.groupBy(*keys).agg(F.min_by(value, order).alias(out))


# ---- M6 band_metrics ----------------------------------------------------------
BAND_KEYS = ["band_id", "band_name", "country", "continent", "death_metal_subgenre",
             "formation_era", "band_maturity", "years_active"]


def band_metrics(dim_bands: DataFrame, dim_albums: DataFrame, fct: DataFrame) -> DataFrame:
    """bands LEFT albums LEFT reviews, grouped by eight band attributes."""
    albums = with_scores(dim_albums.select("band_id", "album_id", "album_year"), fct)
    base = dim_bands.select(*BAND_KEYS).join(albums, "band_id", "left")
    s = F.col("score_album")
    n_rev = F.coalesce(F.sum("n_rev"), F.lit(0)).cast("bigint")
    sd = _deviation()
    return base.groupBy(*BAND_KEYS).agg(
        F.count_distinct("album_id").alias("total_albums"),
        F.min("album_year").alias("first_album_year"),
        F.max("album_year").alias("latest_album_year"),
        (F.max("album_year") - F.min("album_year")).alias("discography_span"),
        n_rev.alias("total_reviews"),
        weighted_mean().alias("avg_score"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        sd.alias("score_consistency"),
        X.safe_divide(_n_if(s >= R.HIGH_SCORE) * 100.0, n_rev).alias("pct_high_quality"),
        X.safe_divide(_n_if(s >= R.EXCELLENT_SCORE) * 100.0, n_rev).alias("pct_excellent"),
        X.flag(n_rev >= R.SUBSTANTIAL_CATALOG_REVIEWS).alias("has_substantial_catalog"),
        X.flag(sd <= R.CONSISTENT_STDDEV_MAX).alias("is_consistent_quality"),
    )


# ---- M7 geographic_analysis ----------------------------------------------------
def geographic_base(dim_bands: DataFrame, dim_albums: DataFrame) -> DataFrame:
    """bands LEFT JOIN albums (one row per band without albums)."""
    bands = dim_bands.select("band_id", "country", "continent", "formed_year", "formation_era",
                             "death_metal_subgenre", "is_active_flag", "is_veteran_band")
    albums = numbered(dim_albums.select("band_id", "album_id", "release_decade"), "album_id")
    return left_join_split(numbered(bands, "band_id"), albums, ["band_id"])


def geographic_analysis(dim_bands: DataFrame, dim_albums: DataFrame) -> DataFrame:
    """Counts over bands LEFT JOIN albums per (country, continent), joined
    with the dominant era and subgenre (``exprs.dominant``) of the same
    groups. Distinct bands and albums are bitmaps."""
    keys = ["country", "continent"]
    base = geographic_base(dim_bands, dim_albums)
    d = F.col("release_decade")
    out = base.groupBy(*keys).agg(
        F.min("formed_year").alias("first_band_formed"),
        F.max("formed_year").alias("latest_band_formed"),
        F.sum("is_active_flag").cast("bigint").alias("active_bands"),
        F.sum("is_veteran_band").cast("bigint").alias("veteran_bands"),
        labels("death_metal_subgenre").alias("subgenres_count"),
        _count_if(d == "1990s").alias("albums_90s"),
        _count_if(d == "2000s").alias("albums_00s"),
        _count_if(d == "2010s").alias("albums_10s"),
    )
    out = with_distinct(out, base, keys, {"total_bands": bit("band_id"), "total_albums": bit("album_id")})
    out = out.withColumn("albums_per_band", X.safe_divide("total_albums", "total_bands"))
    picks = base.groupBy(*keys).agg(
        X.dominant("formation_era").alias("dominant_era"),
        X.dominant("death_metal_subgenre").alias("dominant_subgenre"))
    # USING-join semantics: a null country matches nothing.
    out = out.join(picks, keys, "left")
    return ranks.global_row_number(
        out, [F.col("total_bands").desc_nulls_last(), F.col("country").asc_nulls_last(),
              F.col("continent").asc_nulls_last()], "country_quantity_rank")


# ---- M8 career_analysis --------------------------------------------------------
CAREER_COLUMNS = [
    "band_id", "band_name", "band_career_phase", "album_number_in_discography",
    "years_since_formation", "album_title", "album_year", "score_album",
    "album_career_position", "previous_album_score", "score_change", "band_avg_score",
    "score_vs_band_avg", "career_timing", "has_sophomore_slump", "is_band_best_album",
]


CAREER_ALBUM = ["album_id", "band_id", "band_name", "band_career_phase", "album_number_in_discography",
                "years_since_formation", "album_title", "album_year"]


def career_analysis(dim_albums: DataFrame, fct: DataFrame) -> DataFrame:
    """One row per (album, review). ``lag`` by band in (year, album_id,
    review_id, score) order (``ranks.lag_over``) on stored rows of ids, year and
    score; the albums' texts are attached afterwards, by a hash of the album
    row (albums that are repeated in full are so in the rows already). The band's
    average and best score are a grouped table joined back."""
    albums = dim_albums.select(*CAREER_ALBUM)
    albums = albums.withColumn("_album", F.xxhash64(*[x for c in CAREER_ALBUM for x in (F.col(c), F.col(c).isNull())]))
    reviews = fct.where(F.col("score_album").isNotNull()).select(
        "album_id", "review_id", _score().alias("score_album"))
    rows = stored_table(sized_join(albums.select("band_id", "album_year", "album_id", "_album"), reviews, "album_id",
                                   right_rows=fct.count()), "career_rows")
    best = ranks.group_stats(rows, "band_id", {
        "band_avg_score": F.avg("score_album"), "_band_max": F.max("score_album")})
    rows = ranks.lag_over(rows, "band_id", ["album_year", "album_id", "review_id", "score_album"],
                          "previous_album_score")
    best = stored_table(best, "career_bands")
    rows = ranks.attach(rows.drop("album_year", "album_id"), best, "band_id", rows=best.count())
    rows = rows.drop("band_id").join(albums.distinct(), "_album")
    s, prev = F.col("score_album"), F.col("previous_album_score")
    n = F.col("album_number_in_discography")
    return rows.select(
        "band_id", "band_name", "band_career_phase", "album_number_in_discography",
        "years_since_formation", "album_title", "album_year", "score_album",
        X.career_position(n).alias("album_career_position"),
        "previous_album_score",
        (s - prev).alias("score_change"),
        "band_avg_score",
        (s - F.col("band_avg_score")).alias("score_vs_band_avg"),
        X.career_timing(F.col("years_since_formation")).alias("career_timing"),
        X.flag((n == 2) & (s < prev)).alias("has_sophomore_slump"),
        X.flag(s == F.col("_band_max")).alias("is_band_best_album"),
    )


# ---- M9 temporal_analysis ------------------------------------------------------
def temporal_base(dim_bands: DataFrame, dim_albums: DataFrame, fct: DataFrame,
                  first_year: int = R.TEMPORAL_FROM, last_year: int = R.TEMPORAL_TO) -> DataFrame:
    """albums JOIN bands LEFT JOIN reviews, reviews counted by album and score."""
    return with_scores(temporal_albums(dim_bands, dim_albums, first_year, last_year), fct)


def temporal_albums(dim_bands: DataFrame, dim_albums: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """albums JOIN bands, release years in range (pushed to the album scan)."""
    albums = (dim_albums.where(F.col("album_year").between(first_year, last_year))
              .select("album_year", "release_decade", "release_era", "album_id", "band_id",
                      "is_debut_album"))
    bands = numbered(dim_bands.select("band_id", "country", "death_metal_subgenre"), "band_id")
    return numbered(albums, "album_id").join(bands, "band_id", "inner")


def temporal_analysis(dim_bands: DataFrame, dim_albums: DataFrame, fct: DataFrame,
                      first_year: int = R.TEMPORAL_FROM, last_year: int = R.TEMPORAL_TO,
                      ordered: bool = True) -> DataFrame:
    keys = ["album_year", "release_decade", "release_era"]
    base = temporal_base(dim_bands, dim_albums, fct, first_year, last_year)
    s = F.col("score_album")
    debut = F.col("is_debut_album") == 1
    out = base.groupBy(*keys).agg(
        labels("country").alias("countries_represented"),
        weighted_mean(debut).alias("avg_debut_score"),
        labels("death_metal_subgenre").alias("subgenres_active"),
        weighted_mean().alias("avg_score"),
        _deviation().alias("score_variance"),
        _n_if(s >= R.EXCELLENT_SCORE).alias("excellent_albums"),
        _n_if(s >= R.HIGH_SCORE).alias("high_quality_albums"),
        _n_if(s < R.POOR_SCORE_BELOW).alias("poor_albums"),
    )
    out = with_distinct(out, base, keys, {
        "albums_released": bit("album_id"), "active_bands": F.when(F.col("n_rev") > 0, bit("band_id")),
        "debut_albums": F.when(debut, bit("album_id"))})
    # Decade and era are functions of the year.
    out = (out.join(base.groupBy("album_year").agg(weighted_median().alias("median_score")), "album_year", "left")
           .join(dominant_by_rows(base, ["album_year"], "death_metal_subgenre", "dominant_subgenre"), "album_year", "left"))
    out = ranks.global_row_number(out, [F.col("albums_released").desc_nulls_last(),
                                        F.col("album_year").asc()], "release_rank")
    out = ranks.global_row_number(out, [F.col("avg_score").desc_nulls_last(),
                                        F.col("album_year").asc()], "quality_rank")
    return out.orderBy("album_year") if ordered else out


# ---- M10 subgenre_analysis -----------------------------------------------------
def subgenre_analysis(dim_bands: DataFrame, dim_albums: DataFrame, fct: DataFrame) -> DataFrame:
    keys = ["death_metal_subgenre", "continent"]
    bands = (dim_bands.where(F.col("death_metal_subgenre").isNotNull())
             .select("band_id", "death_metal_subgenre", "continent", "country", "formed_year",
                     "is_active_flag", "is_veteran_band"))
    albums = numbered(dim_albums.select("band_id", "album_id", "release_decade"), "album_id")
    released = numbered(bands, "band_id").join(albums, "band_id", "inner")
    base = with_scores(released, fct)
    s = F.col("score_album")
    n_s = _n_if(s.isNotNull())
    out = base.groupBy(*keys).agg(
        weighted_mean().alias("avg_score"),
        _deviation().alias("score_variance"),
        weighted_median().alias("median_score"),
        _n_if(s >= R.EXCELLENT_SCORE).alias("excellent_count"),
        _n_if(s >= R.HIGH_SCORE).alias("high_quality_count"),
        _n_if(s < R.POOR_SCORE_BELOW).alias("poor_count"),
        X.safe_divide(_n_if(s >= R.EXCELLENT_SCORE) * 100.0, n_s).alias("pct_excellent"),
        X.safe_divide(_n_if(s >= R.HIGH_SCORE) * 100.0, n_s).alias("pct_high_quality"),
        F.min("formed_year").alias("earliest_band"),
        F.max("formed_year").alias("latest_band"),
        F.sum(F.col("is_active_flag") * F.col("rows")).cast("bigint").alias("active_bands"),
        F.sum(F.col("is_veteran_band") * F.col("rows")).cast("bigint").alias("veteran_bands"),
        labels("country").alias("countries_count"),
    )
    out = with_distinct(out, released, keys, {"total_albums": bit("album_id"), "total_bands": bit("band_id")})
    # Review ids can repeat, so their distinct count needs the ids themselves.
    reviews = (released.select("album_id", *keys).join(fct.select("album_id", "review_id"), "album_id", "inner")
               .groupBy(*keys).agg(F.count_distinct("review_id").alias("_reviews")))
    for table in (reviews, dominant_by_rows(base, keys, "release_decade", "dominant_decade", nulls=True),
                  dominant_by_rows(base, keys, "country", "dominant_country", nulls=True)):
        out = out.join(table, keys, "left")
    out = out.withColumn("total_reviews", F.coalesce("_reviews", F.lit(0))).drop("_reviews")
    tie = [F.col("death_metal_subgenre").asc_nulls_last(), F.col("continent").asc_nulls_last()]
    out = ranks.global_row_number(out, [F.col("avg_score").desc_nulls_last(), *tie],
                                  "quality_rank")
    out = ranks.global_row_number(out, [F.col("total_bands").desc_nulls_last(), *tie],
                                  "popularity_rank")
    return ranks.global_row_number(out, [F.col("pct_excellent").desc_nulls_last(), *tie],
                                   "excellence_rank")
