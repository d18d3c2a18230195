"""Fact window columns equal plain window functions, on the normal path and
with the task limit lowered so hot scores are split by review-id ranges and
bands go through the distributed form."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from grimlake.operators import ranks
from grimlake.plans import dims, facts
from grimlake.plans.registry import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


def expected(narrow):
    sd = F.col("score_d")
    order = [sd.desc(), *[F.col(c).asc_nulls_last() for c in facts.TIES]]
    rank = lambda *p: F.row_number().over(Window.partitionBy(*p).orderBy(*order))
    pr = lambda *p: F.percent_rank().over(Window.partitionBy(*p).orderBy(sd))
    avg = lambda *p: F.avg(sd).over(Window.partitionBy(*p))
    cnt = lambda *p: F.count(F.lit(1)).over(Window.partitionBy(*p))
    return narrow.select(
        "_rk",
        rank().alias("overall_score_rank"), rank("band_id").alias("band_score_rank"),
        rank("country").alias("country_score_rank"),
        rank("release_decade").alias("decade_score_rank"),
        rank("death_metal_subgenre").alias("subgenre_score_rank"),
        F.round(pr(), 9).alias("score_percentile"),
        F.round(pr("release_decade"), 9).alias("decade_score_percentile"),
        cnt("band_id").alias("band_total_reviews"), cnt("album_id").alias("album_total_reviews"),
        F.round(sd - avg(), 9).alias("score_vs_overall_avg"),
        F.round(sd - avg("band_id"), 9).alias("score_vs_band_avg"),
        F.round(sd - avg("country"), 9).alias("score_vs_country_avg"))


COLS = ["_rk", "overall_score_rank", "band_score_rank", "country_score_rank",
        "decade_score_rank", "subgenre_score_rank", "score_percentile",
        "decade_score_percentile", "band_total_reviews", "album_total_reviews",
        "score_vs_overall_avg", "score_vs_band_avg", "score_vs_country_avg"]


@pytest.mark.parametrize("limit", [None, 40])
def test_window_columns(spark, limit):
    base = catalog(spark, SF).fct_base
    narrow = facts.narrow_rows(base)
    if limit:
        spark.conf.set(ranks.MAX_ROWS_CONF, str(limit))
    try:
        got = facts.window_columns(narrow.select("*"))
        got = got.select(*[F.round(c, 9).alias(c) if c in ("score_percentile",
                          "decade_score_percentile", "score_vs_overall_avg",
                          "score_vs_band_avg", "score_vs_country_avg") else c for c in COLS])
        rows = lambda df: sorted(tuple(r) for r in df.select(*COLS).collect())
        assert rows(got) == rows(expected(narrow))
    finally:
        spark.conf.unset(ranks.MAX_ROWS_CONF)


def test_decimal_means_are_exact(spark):
    """Scores whose double sums are not exact: none of six 0.1 is above their
    mean, whatever the order of the rows."""
    rows = [(i, i, 1, 1, "a", "1990s", "x", "t", "c", s) for i, s in enumerate(["0.1"] * 6)]
    rows += [(10 + i, i, 2, 2, "b", "1990s", "y", "t", "c", s) for i, s in enumerate(["70.1", "70.1", "70.2"])]
    base = spark.createDataFrame(rows, "_rk long, review_id long, album_id long, band_id long, country string, "
                                 "release_decade string, death_metal_subgenre string, review_title string, "
                                 "content_review string, score string").withColumn(
        "score_album", F.col("score").cast("decimal(18,3)"))
    for parts in (1, 3):
        got = {r._rk: r for r in facts.window_columns(facts.narrow_rows(base.repartition(parts))).collect()}
        assert [got[i].is_above_band_avg for i in range(6)] == [0] * 6
        assert [got[i].is_above_subgenre_avg for i in (10, 11, 12)] == [0, 0, 1]
        assert [got[i].is_above_overall_avg for i in (0, 10, 12)] == [0, 1, 1]


def test_a_score_without_review_ids(spark):
    """Most reviews of one score have no id: the windows stay right with every
    cell under the limit, and equal plain windows."""
    rows = [(i, None if i % 8 else i, i % 5, i % 3, "a" if i % 2 else None, f"{1980 + 10 * (i % 4)}s", "x", "t",
             str(i % 50), "80" if i % 10 else str(50 + i % 40)) for i in range(1500)]
    base = spark.createDataFrame(rows, "_rk long, review_id long, album_id long, band_id long, country string, "
                                 "release_decade string, death_metal_subgenre string, review_title string, "
                                 "content_review string, score string").withColumn(
        "score_album", F.col("score").cast("decimal(18,3)"))
    narrow = facts.narrow_rows(base)
    order = [F.col("score_d").desc(), *[F.col(c).asc_nulls_last() for c in [*facts.TIES, "_rk"]]]
    spark.conf.set(ranks.MAX_ROWS_CONF, "100")
    try:
        cells = ranks.ordered_cells(narrow, order)
        assert cells.groupBy(ranks.CELL).count().agg(F.max("count")).first()[0] <= 100
        got = facts.window_columns(narrow, keep=("country",))
        names = {"overall_score_rank": (), "band_score_rank": ("band_id",), "country_score_rank": ("country",),
                 "decade_score_rank": ("release_decade",), "subgenre_score_rank": ("death_metal_subgenre",)}
        want = narrow.select("_rk", *[F.row_number().over(Window.partitionBy(*P).orderBy(*order)).alias(n)
                                      for n, P in names.items()])
        key = lambda df: sorted(tuple(r) for r in df.select("_rk", *names).collect())
        assert key(got) == key(want)
    finally:
        spark.conf.unset(ranks.MAX_ROWS_CONF)


def test_narrow_shuffles_of_the_fact(spark):
    """Fact rows meet their albums without classes; windows need one exchange by band
    after the cells, and none by album or cell; albums are dealt by year and band."""
    c = catalog(spark, SF)
    assert not {"score_category", "review_content_category"} & set(c.review_texts.columns)
    assert dict(c.review_texts.dtypes)["_digest"] == "bigint"
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "10485760"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = facts.window_columns(facts.narrow_rows(c.fct_base))._jdf.queryExecution().executedPlan().toString()
        numbered = dims.album_numbers(dims.albums_to_number(c.stg_albums, c.dim_bands))
        albums = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(band_id") == 1
    assert "hashpartitioning(album_id" not in plan and "hashpartitioning(_cell" not in plan
    assert "band_name" not in numbered.columns
    assert albums.count("Exchange hashpartitioning(album_year") >= 1


def test_repeated_ids_of_albums_and_bands(spark):
    """An album id of two bands is counted over both; bands that come twice, or under
    one id, multiply their albums once."""
    rows = [(i, i, 1 + i % 2, 7 + i % 3 % 2, "a", "1990s", "x", "t", "c", "80") for i in range(30)]
    base = spark.createDataFrame(rows, "_rk long, review_id long, album_id long, band_id long, country string, "
                                 "release_decade string, death_metal_subgenre string, review_title string, "
                                 "content_review string, score string").withColumn("score_album", F.col("score").cast("decimal(18,3)"))
    got = facts.window_columns(facts.narrow_rows(base), keep=("album_id",))
    assert {(r.album_id, r.album_total_reviews) for r in got.collect()} == {(1, 15), (2, 15)}
    c = catalog(spark, SF)
    bands = c.dim_bands.limit(50).localCheckpoint()
    other = bands.withColumns({"country": F.lit("Elsewhere"), "genre": F.lit(None).cast("string")})
    every = bands.unionByName(bands).unionByName(other)
    albums = c.stg_albums.where("album_year IS NOT NULL")
    got = dims.dim_albums(c.stg_albums, every)
    want = albums.join(every.select("band_id", "country", "genre"), "band_id")
    key = lambda df: sorted(map(str, df.select("album_id", "band_id", "country", "genre").collect()))
    assert key(got) == key(want) and got.count() > 0


def test_cell_tables_are_broadcast_whatever_their_bytes(spark):
    """With no table small enough for Spark's own broadcasts, the rows of the windows are
    dealt once, by band; the labels, null ones too, cross that exchange as one number."""
    rows = [(i, i, 1 + i % 40, 7 + i % 40 % 8, None if i % 5 == 0 else f"c{i % 3}", f"{1980 + 10 * (i % 4)}s",
             None if i % 7 == 0 else f"s{i % 4}", "x", "t", str(50 + i % 40)) for i in range(900)]
    base = spark.createDataFrame(rows, "_rk long, review_id long, album_id long, band_id long, country string, "
                                 "release_decade string, death_metal_subgenre string, review_title string, "
                                 "content_review string, score string").withColumn("score_album", F.col("score").cast("decimal(18,3)"))
    narrow = facts.narrow_rows(base)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = facts.window_columns(narrow)
        plan = got._jdf.queryExecution().executedPlan().toString()
        dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(band_id" in x]
        assert len(dealt) == 1 and "SortMergeJoin" not in plan
        below = plan[plan.index(dealt[0]):].splitlines()[1]
        assert "_labels#" in below and " country#" not in below
        rows = lambda df: sorted(map(str, df.select(*names).collect()))
        names = ["_rk", "overall_score_rank", "band_score_rank", "country_score_rank", "decade_score_rank",
                 "subgenre_score_rank", "band_total_reviews", "album_total_reviews"]
        assert rows(got) == rows(expected(narrow))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_album_classes_follow_from_what_albums_bring(spark):
    """The classes that no shuffle carries are those of the albums' table."""
    c = catalog(spark, SF)
    made = ["continent", "death_metal_subgenre", "release_decade", "release_era", "formation_era", "band_career_phase",
            "is_debut_album", "is_golden_age_release"]
    assert not set(made) & set(facts.ALBUM_COLUMNS_FOR_FACT)
    key = ["album_id", "band_id"]
    got = facts.album_classes(c.dim_albums.select(*facts.ALBUM_COLUMNS_FOR_FACT)).select(*key, *made)
    want = c.dim_albums.select(*key, *made)
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
