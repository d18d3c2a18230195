"""Joins of stored tables by their counted rows."""

import pytest
from pyspark.sql import functions as F

from grimlake.operators import joins, ranks
from grimlake.plans import dims
from grimlake.sources.stage import stored_table


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def bounds(spark):
    spark.conf.set(joins.BROADCAST_ROWS_CONF, "100")
    yield
    spark.conf.unset(joins.BROADCAST_ROWS_CONF)


def test_stored_tables_of_many_rows_are_not_broadcast(spark, bounds):
    """Their files are far smaller than Spark's bound; grouped rows are no exception."""
    many = stored_table(spark.range(1000).selectExpr("id", "'label' AS label"), "many")
    other = spark.range(50, 5000)
    for side in (many, many.where("id > 5"), many.select("id").distinct(), many.groupBy("id").count()):
        joined = other.join(side, "id")
        assert "BroadcastHashJoin" not in plan(joined) and joined.count() == 950
    table = many.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    assert "BroadcastHashJoin" not in plan(ranks.attach(other, table, "id", rows=1000))
    assert "BroadcastHashJoin" in plan(ranks.attach(other, table, "id", rows=0))


def test_few_rows_are_broadcast_to_many(spark, bounds):
    many = stored_table(spark.range(1000).withColumn("a", F.lit(1)), "many")
    tiny = stored_table(spark.range(990, 1010).withColumn("b", F.lit(2)), "tiny")
    for left, right, n in ((many, tiny, 10), (tiny, many, 10), (many, many.withColumnRenamed("a", "c"), 1000), (tiny, tiny.drop("b"), 20)):
        joined = joins.sized_join(left, right, "id")
        assert ("BroadcastHashJoin" in plan(joined)) == (n != 1000) and joined.count() == n


def test_wide_rows_count_by_their_bytes(spark):
    df = spark.createDataFrame([(1, "a")], "id long, label string")
    assert joins.row_bytes(df.schema) == 48
    assert joins.few(df, 100_000) and not joins.few(df, 900_000)


def test_bands_are_joined_to_albums_without_a_broadcast(spark, bounds):
    bands = stored_table(spark.range(500).selectExpr(
        "id AS band_id", "concat('b', id) AS band_name", "'Norway' AS country", "'Europe' AS continent", "'g' AS genre",
        "'s' AS death_metal_subgenre", "1990 AS formed_year", "'Active' AS current_status", "'e' AS formation_era",
        "'1990s' AS formation_decade", "'m' AS band_maturity"), "bands")
    albums = spark.range(600).selectExpr("id AS album_id", "id % 550 AS band_id", "'t' AS album_title", "1991 AS album_year")
    joined = dims.albums_to_number(albums, bands)
    assert "BroadcastHashJoin" not in plan(joined) and joined.count() == 550
    assert "BroadcastHashJoin" not in plan(dims.with_bands(joined, bands)) and dims.dim_albums(albums, bands).count() == 550
