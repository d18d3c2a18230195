"""Distinct counts as bitmaps: equal to ``count(DISTINCT)``, mergeable, no Expand."""

import pytest
from pyspark.sql import functions as F

from grimlake.operators import distinct
from grimlake.plans import aggregates, marts
from grimlake.plans.registry import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("per_cell", [50, 10**6])
def test_counts_equal_count_distinct(spark, per_cell):
    """Null keys, null values, a hot value, negative and very large ids; many cells
    of few values and one cell of several buckets."""
    hot = F.when(F.col("id") % 3 == 0, 7)
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"),
        hot.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * (2**46 + 1) - 2**62).alias("v"),
        F.concat(F.lit("b"), F.col("id") % 90).alias("w"))
    got_rows = distinct.numbered(distinct.numbered(rows, "v", per_cell), "w", per_cell)
    counted = {"nv": distinct.bit("v"), "nw": F.when(F.col("v") > 0, distinct.bit("w"))}
    got = distinct.with_distinct(rows.groupBy("g").agg(F.count("*").alias("n")), got_rows, ["g"], counted)
    want = rows.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("v").alias("nv"),
                                 F.count_distinct(F.when(F.col("v") > 0, F.col("w"))).alias("nw"))
    assert sorted(map(str, got.select("g", "n", "nv", "nw").collect())) == sorted(map(str, want.collect()))


def test_states_merge(spark):
    """States of two loads that share values, merged to a coarser group, count as one."""
    rows = distinct.numbered(spark.range(9000).select((F.col("id") % 4).alias("a"), (F.col("id") % 3).alias("b"),
                                                      (F.col("id") % 1700).alias("v")), "v", 100)
    state = lambda df: distinct.bitmaps(df, ["a", "b"], {"n": distinct.bit("v")})
    both = distinct.merged(state(rows.where("v < 1000")).unionByName(state(rows.where("v > 600"))), ["a"])
    got = {r.a: r.n for r in distinct.counts(both, ["a"], ["n"]).collect()}
    assert got == {r.a: r.n for r in rows.groupBy("a").agg(F.count_distinct("v").alias("n")).collect()}


def test_empty_and_all_null(spark):
    rows = distinct.numbered(spark.createDataFrame([(1, None)], "g long, v long"), "v")
    out = distinct.with_distinct(rows.groupBy("g").agg(F.count("*").alias("n")), rows, ["g"], {"nv": distinct.bit("v")})
    assert [tuple(r) for r in out.collect()] == [(1, 1, 0)]
    assert distinct.numbered(rows.where("false").select("g", "v"), "v").count() == 0


def test_marts_do_not_expand(spark):
    c = catalog(spark, SF)
    base = marts.temporal_base(c.dim_bands, c.dim_albums, c.fct_base)
    for df in (c.temporal_analysis, c.geographic_analysis, c.subgenre_analysis, aggregates.conditional_distinct(base)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_are_built_after_the_shuffle(spark):
    """A bitmap is as large with one bit as with all: no exchange has one, and the
    marks of a group and bucket are dealt to one task."""
    rows = distinct.numbered(spark.range(3000).select((F.col("id") % 4).alias("g"), (F.col("id") % 900).alias("v")), "v", 100)
    states = distinct.bitmaps(rows, ["g"], {"n": distinct.bit("v")})
    conf = {"spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = states.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    above = plan[:plan.index("Exchange")]
    assert above.count("bitmap_construct_agg(position") == 2 and "partial_bitmap_construct_agg" in above
    assert "bitmap_construct_agg" not in plan[plan.index("Exchange"):]
    assert states.groupBy("g", "bucket").count().where("count > 1").isEmpty()
