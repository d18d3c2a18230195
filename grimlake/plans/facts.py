"""Fact model ``fct_reviews`` (M5): reviews x albums (J2), row classes
(C17-C24) and seventeen window columns (W4-W11).

The review texts are by far the widest part, so they come last:

1. ``review_texts``: scored reviews with a surrogate row key, lengths and a
   digest of their texts, written where they are read: no shuffle. The key is stable and lineage is cut (lost executors re-read the files).
   Readers prune columns, so nothing below reads a text again.
2. ``fct_base``: these rows without texts, inner-joined to their albums, with the
   row-local classes, written once. Marts read it.
3. ``window_columns`` on its ids, groups, score and digest. The rows are
   range-partitioned once by the whole order of the score ranks (score, review
   id, album id, digest, key; ``ranks.ordered_cells``), so a frequent score or a
   million reviews without id are many cells. Overall, country, decade and
   subgenre ranks are numbers inside a cell, shifted by offsets from one
   (group, score, cell) histogram that also gives the percent ranks and averages;
   band ranks, averages and counts and album counts share one band partitioning
   (or the cells when a band is too big for one task). The result is written once.
4. ``fct_reviews``: base, windows and texts meet on the row key; the texts are
   shuffled this one time.

Ties in score order are broken by review id, album id and a digest of the
review's texts (D6), so the order is total up to equal reviews, which the row
key orders. Means are compared as exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grimlake.functions import exprs as X
from grimlake.functions import rules as R
from grimlake.operators import ranks
from grimlake.operators.joins import not_broadcast, sized_join
from grimlake.operators.quality import Parts
from grimlake.sources.stage import stored_table

FCT_COLUMNS = [
    "review_id", "album_id", "band_id", "review_title", "score_album", "content_review",
    "score_category", "score_range", "review_title_length", "review_title_category",
    "review_content_length", "review_content_category", "album_title", "band_name",
    "album_year", "country", "continent", "genre", "death_metal_subgenre", "release_decade",
    "release_era", "formation_era", "band_career_phase", "band_maturity",
    "years_since_formation", "album_number_in_discography", "has_review_title",
    "has_review_content", "is_substantial_review", "is_excellent_score", "is_high_score",
    "is_good_score", "is_poor_score", "is_debut_album", "is_golden_age_release",
    "is_above_overall_avg", "is_above_band_avg", "is_above_subgenre_avg",
    "overall_score_rank", "band_score_rank", "country_score_rank", "decade_score_rank",
    "subgenre_score_rank", "score_percentile", "decade_score_percentile",
    "subgenre_score_percentile", "score_vs_overall_avg", "score_vs_band_avg",
    "score_vs_country_avg", "score_vs_decade_avg", "score_above_threshold",
    "score_deviation_from_average", "band_total_reviews", "album_total_reviews",
]

#: What an album brings to its reviews; ``album_classes`` makes the rest from it.
ALBUM_COLUMNS_FOR_FACT = [
    "album_id", "band_id", "album_title", "album_year", "years_since_formation",
    "album_number_in_discography", "band_name", "country", "genre", "band_maturity",
]

WINDOW_COLUMNS = [
    "is_above_overall_avg", "is_above_band_avg", "is_above_subgenre_avg",
    "overall_score_rank", "band_score_rank", "country_score_rank", "decade_score_rank",
    "subgenre_score_rank", "score_percentile", "decade_score_percentile",
    "subgenre_score_percentile", "score_vs_overall_avg", "score_vs_band_avg",
    "score_vs_country_avg", "score_vs_decade_avg", "band_total_reviews",
    "album_total_reviews",
]


def text_measures(df: DataFrame) -> DataFrame:
    """What is kept of the texts: lengths and presence flags."""
    title, content = F.col("review_title"), F.col("content_review")
    return df.withColumns({
        "review_title_length": F.length(title).cast("bigint"),
        "review_content_length": F.length(content).cast("bigint"),
        "has_review_title": X.flag(~X.is_blank(title)),
        "has_review_content": X.flag(~X.is_blank(content)),
    })


def measured_classes(df: DataFrame) -> DataFrame:
    """C17-C24 from the score and ``text_measures``: made where they are read, so
    that no shuffle carries them."""
    s = F.col("score_album")
    sd = s.cast("double")
    title, content = F.col("review_title_length"), F.col("review_content_length")
    return df.withColumns({
        "score_category": X.score_category(s),
        "score_range": X.score_range(s),
        "review_title_category": X.length_category(
            title, F.col("has_review_title") == 0, R.REVIEW_TITLE, R.REVIEW_TITLE_EMPTY, R.REVIEW_TITLE_ELSE),
        "review_content_category": X.length_category(
            content, F.col("has_review_content") == 0, R.REVIEW_CONTENT, R.REVIEW_CONTENT_EMPTY, R.REVIEW_CONTENT_ELSE),
        "is_substantial_review": X.flag(content >= R.SUBSTANTIAL_REVIEW_CHARS),
        "is_excellent_score": X.flag(s >= R.EXCELLENT_SCORE),
        "is_high_score": X.flag(s >= R.HIGH_SCORE),
        "is_good_score": X.flag(s >= R.GOOD_SCORE),
        "is_poor_score": X.flag(s < R.POOR_SCORE_BELOW),
        "score_above_threshold": F.when(sd > R.SCORE_THRESHOLD, sd - R.SCORE_THRESHOLD)
                                  .otherwise(F.lit(0.0)),
        "score_deviation_from_average": F.abs(sd - R.SCORE_CENTER),
    })


def review_classes(df: DataFrame) -> DataFrame:
    """Row-local score and text classes."""
    return measured_classes(text_measures(df))


def album_classes(df: DataFrame) -> DataFrame:
    """Classes of an album (C2, C4, C8-C12) as in ``dims``, made where its reviews are
    joined, so that no shuffle carries them."""
    y = F.col("album_year")
    formed = y - F.col("years_since_formation")
    return df.withColumns({
        "continent": X.continent(F.col("country")),
        "death_metal_subgenre": X.subgenre(F.col("genre")),
        "release_decade": X.decade(y),
        "release_era": X.era(y),
        "formation_era": X.era(formed),
        "band_career_phase": X.career_phase(y, formed),
        "is_debut_album": X.flag(y == formed),
        "is_golden_age_release": X.flag(y.between(*R.GOLDEN_AGE)),
    })


TEXTS = ["review_title", "content_review"]


def digest(title: str = "review_title", content: str = "content_review") -> Column:
    """First 64 bits of the MD5 of a review's texts, as a number in the order of their hex form."""
    md5 = F.md5(F.concat(F.coalesce(title, F.lit("")), F.lit("\x1f"), F.coalesce(content, F.lit(""))))
    return F.conv(F.substring(md5, 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def review_texts(stg_reviews: DataFrame, path: str | None = None) -> DataFrame:
    """Scored reviews with the row key ``_rk``, text measures and ``_digest``, stored.
    The key is made by the tasks that write the rows, with no shuffle after it: a
    task that runs again replaces its own file, keys included. Keys of one file
    are consecutive."""
    scored = text_measures(stg_reviews.where(F.col("score_album").isNotNull()))
    return stored_table(scored.withColumns({"_digest": digest(), "_rk": F.monotonically_increasing_id()}), "review_texts", path)


NARROW = ["_rk", "review_id", "album_id", "band_id", "country", "release_decade",
          "death_metal_subgenre"]


LOW_CARDINALITY = [(), ("country",), ("release_decade",), ("death_metal_subgenre",)]
LOW_RANKS = {(): "overall_score_rank", ("country",): "country_score_rank",
             ("release_decade",): "decade_score_rank",
             ("death_metal_subgenre",): "subgenre_score_rank"}
LOW_PERCENTS = {(): "score_percentile", ("release_decade",): "decade_score_percentile",
                ("death_metal_subgenre",): "subgenre_score_percentile"}
LOW_TAGS = {(): "all", ("country",): "country", ("release_decade",): "decade",
            ("death_metal_subgenre",): "sub"}
#: Order of equal scores: total up to rows that are the same review.
TIES = ["review_id", "album_id", "_digest"]


def narrow_rows(base: DataFrame) -> DataFrame:
    """What the window columns need: ids, groups, score and a digest of the
    review's texts."""
    own = F.col("_digest") if "_digest" in base.columns else digest().alias("_digest")
    return base.select(*NARROW, F.col("score_album").cast("double").alias("score_d"), own)


def window_columns(narrow: DataFrame, keep: tuple = ()) -> DataFrame:
    """W4-W11 on the projection (``NARROW`` + ``score_d``); returns ``_rk``
    and the window columns (plus the ``keep`` columns of ``narrow``).

    * Overall, country, decade and subgenre: rows are in range cells of the whole
      order, and counted by group where the cells are written; a rank is the row's
      number in (group, cell) and the group's rows in earlier cells. Those offsets,
      the percent ranks and the group averages come from one histogram. No task
      holds a whole group.
    * Per band: ordinary windows (rank, average, count share one exchange)
      when the largest band fits a task, else the cells.
    * Per album: counted in the bands' exchange; album ids of several bands (all, in
      the other form) by a grouped count joined back.

    Tables that are joined back are stored and their rows known, so that the small
    ones are broadcast, whatever Spark makes of their bytes: a join that is not
    shuffles all rows once more.
    """
    limit = ranks.max_rows_per_task(narrow.sparkSession)
    sd = F.col("score_d")
    order = [sd.desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in [*TIES, "_rk"]]]
    groups = [P for P in LOW_CARDINALITY if P]
    cells = ranks.ordered_cells(narrow, order, limit, groups=[c for P in groups for c in P])
    histogram = ranks.cell_histogram(cells, groups, "score_d")
    in_cells = histogram.count()  # no cell table has more rows
    out = cells
    sums = {"_sum_band": F.sum(sd.cast(ranks.EXACT)), "band_total_reviews": F.count(F.lit(1))}
    biggest = narrow.groupBy("band_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    count = {"album_total_reviews": F.count(F.lit(1))}
    if biggest <= limit:
        band = Window.partitionBy("band_id")
        # The exchange carries cell and place as one number, and the labels as another.
        labels = [c for P in groups for c in P]
        codes = ranks.labels_coded(cells, labels, "_labels")
        if codes is not None:
            out = ranks.attach(out, codes, labels, rows=0).drop(*labels)
        out = out.withColumn("_at", F.shiftleft(ranks.CELL, 33).bitwiseOR(F.col(ranks.PLACE))).drop(ranks.CELL, ranks.PLACE)
        out = out.withColumns({"band_score_rank": F.row_number().over(band.orderBy("_at")),
                               **{name: agg.over(band) for name, agg in sums.items()}})
        # An album's reviews are where its band's are, but for album ids of several bands.
        albums = ranks.group_stats(narrow, "album_id", {
            "_n": F.count(F.lit(1)), "_known": F.count("band_id"), "_least": F.min("band_id"), "_most": F.max("band_id")})
        several = "_least <> _most OR _known BETWEEN 1 AND _n - 1"
        shared = stored_table(albums.where(several).select("album_id", "_n"), "shared_albums")
        out = out.withColumn("_own", F.count(F.lit(1)).over(Window.partitionBy("band_id", "album_id")))
        out = ranks.attach(out, shared, "album_id", rows=shared.count())
        out = out.withColumn("album_total_reviews", F.coalesce("_n", "_own")).drop("_n", "_own")
        out = out.withColumns({ranks.CELL: F.shiftright("_at", 33), ranks.PLACE: F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
        out = out if codes is None else ranks.attach(out, codes, "_labels", rows=0)
    else:
        out = ranks.cell_ranks(cells, out, "band_id", "band_score_rank")
        for key, aggs in (("band_id", sums), ("album_id", count)):
            table = stored_table(ranks.group_stats(cells, key, aggs), f"{key}_stats")
            out = ranks.attach(out, table, key, rows=table.count())
    for P in groups:
        out = out.withColumn(LOW_RANKS[P], F.col(ranks.group_place(P[0])))
    out = out.withColumn(LOW_RANKS[()], F.col(ranks.PLACE) + 1)
    for P in LOW_CARDINALITY:
        name, tag = LOW_RANKS[P], LOW_TAGS[P]
        table = ranks.cell_table(histogram, groups, P, "score_d").withColumnsRenamed(
            {"_group_n": f"_n_{tag}", "_group_sum": f"_sum_{tag}"})
        out = ranks.attach(out, table, [*P, "score_d", ranks.CELL], rows=in_cells)
        out = out.withColumn(name, (F.col(name) + F.col("_before")).cast("bigint"))
        if P in LOW_PERCENTS:
            out = out.withColumn(LOW_PERCENTS[P], ranks.percent_from(F.col("_before_asc"), F.col(f"_n_{tag}")))
        out = out.drop("_before", "_before_asc")
    out = out.withColumns({"_n_band": F.col("band_total_reviews"), "band_score_rank": F.col("band_score_rank").cast("bigint")})

    def above(tag: str):  # the score against the exact mean, without dividing
        return X.flag(sd.cast(ranks.EXACT) * F.col(f"_n_{tag}") > F.col(f"_sum_{tag}"))

    def versus(tag: str):
        return sd - F.col(f"_sum_{tag}").cast("double") / F.col(f"_n_{tag}")

    return out.select(
        "_rk", *[c for c in keep if c != "_rk"],
        "overall_score_rank", "band_score_rank", "country_score_rank",
        "decade_score_rank", "subgenre_score_rank", "score_percentile",
        "decade_score_percentile", "subgenre_score_percentile",
        F.col("band_total_reviews").cast("bigint").alias("band_total_reviews"),
        F.col("album_total_reviews").cast("bigint").alias("album_total_reviews"),
        above("all").alias("is_above_overall_avg"),
        above("band").alias("is_above_band_avg"),
        above("sub").alias("is_above_subgenre_avg"),
        versus("all").alias("score_vs_overall_avg"),
        versus("band").alias("score_vs_band_avg"),
        versus("country").alias("score_vs_country_avg"),
        versus("decade").alias("score_vs_decade_avg"),
    )


def fct_base(texts: DataFrame, dim_albums_df: DataFrame, path: str | None = None) -> DataFrame:
    """The stored reviews with their album attributes, without texts and window
    columns, written once with ``_rk``. Marts read this, so they never re-run the
    seventeen windows."""
    rows = sized_join(texts.drop(*TEXTS), dim_albums_df.select(*ALBUM_COLUMNS_FOR_FACT), "album_id")
    return stored_table(album_classes(measured_classes(rows)), "fct_base", path)


def stored_windows(base: DataFrame, path: str | None = None) -> DataFrame:
    """Window columns of every fact row written once, keyed by ``_rk`` and
    carrying the review's ids and score for direct window queries."""
    narrow = narrow_rows(base)
    windows = window_columns(narrow, keep=("review_id", "album_id", "band_id", "score_d"))
    return stored_table(windows, "fct_windows", path)


def with_texts(rows: DataFrame, texts: DataFrame, columns: list[str] = TEXTS, max_files: int = 1000) -> DataFrame:
    """``rows`` (with ``_rk``) and their review texts. Keys of one stored file are
    consecutive: where the rows come from at most ``max_files`` files, only those
    files' key ranges are read (row groups of others are passed over by their
    statistics); otherwise the texts are read, and shuffled once, in full."""
    some = rows.select(F.shiftright("_rk", 33).alias("f")).distinct().limit(max_files + 1).collect()
    wanted = texts.select("_rk", *columns)
    if len(some) <= max_files:
        near = F.lit(False)
        for f in sorted(r["f"] for r in some):
            near = near | F.col("_rk").between(f << 33, (f + 1 << 33) - 1)
        wanted = wanted.where(near)
    return rows.join(wanted, "_rk")


def fct_parts(base: DataFrame, windows: DataFrame) -> Parts:
    """``fct_narrow`` as the two stored tables that it is joined from."""
    return Parts("_rk", (base, windows.select("_rk", *WINDOW_COLUMNS)),
                 ("_rk", *[c for c in FCT_COLUMNS if c not in TEXTS]))


def fct_narrow(base: DataFrame, windows: DataFrame) -> DataFrame:
    """``fct_reviews`` without texts, with ``_rk``."""
    return fct_parts(base, windows).whole()


def fct_reviews_keyed(texts: DataFrame, base: DataFrame, windows: DataFrame) -> DataFrame:
    """``fct_reviews`` plus its surrogate row key ``_rk``."""
    # Texts are many times as large as their files: never broadcast.
    return fct_narrow(base, windows).join(not_broadcast(texts.select("_rk", *TEXTS)), "_rk", "inner").select(*FCT_COLUMNS, "_rk")


def with_audit(fct: DataFrame) -> DataFrame:
    """The fact with its load stamps, as the source's view has them."""
    now = F.current_timestamp()
    return fct.withColumns({"created_at": now, "updated_at": now})


def fct_reviews(stg_reviews: DataFrame, dim_albums_df: DataFrame) -> DataFrame:
    texts = review_texts(stg_reviews)
    base = fct_base(texts, dim_albums_df)
    return fct_reviews_keyed(texts, base, stored_windows(base)).select(*FCT_COLUMNS)
