"""Percentiles by range cells equal Spark's exact ones, whatever the cells."""

import pytest
from pyspark.sql import functions as F

from grimlake.operators.percentiles import percentiles
from grimlake.plans import aggregates

SHARES = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("limit", [None, 700])
def test_percentiles(spark, limit):
    """A group with 20,000 kinds of values, ties, a null group, a group of one, one
    without values."""
    big = spark.range(20_000).select(F.lit("many").alias("g"), (F.col("id") * 7919 % 20_011 / 3 - 1000).alias("v"))
    small = spark.createDataFrame([("ties", 5.0)] * 9 + [("ties", 1.0), ("ties", None), (None, 2.0), (None, 4.0),
                                                         ("one", -3.5), ("none", None)], "g string, v double")
    rows = big.unionByName(small)
    want = rows.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in SHARES.items()])
    norm = lambda df: sorted(tuple(x if x is None or isinstance(x, str) else round(x, 9) for x in r)
                             for r in df.select(F.coalesce("g", F.lit("~")), *SHARES).collect())
    assert norm(percentiles(rows, ["g"], "v", SHARES, limit)) == norm(want)


def test_empty(spark):
    assert percentiles(spark.createDataFrame([], "g long, v double"), ["g"], "v", SHARES).count() == 0


def test_two_loads_combined_equal_one(spark):
    rows = spark.range(4000).select((F.col("id") % 3).cast("string").alias("release_decade"),
                                    F.concat(F.lit("s"), F.floor(F.sqrt(F.col("id") % 97))).alias("death_metal_subgenre"))
    state = aggregates.top_value_state
    two = state(rows.where("death_metal_subgenre < 's5'")).unionByName(state(rows.where("death_metal_subgenre >= 's5'")))
    got, want = (sorted(map(tuple, df.collect())) for df in (
        aggregates.top_value_of_states(two), aggregates.top_value_of_states(state(rows))))
    assert got == want == sorted(map(tuple, aggregates.approx_top_value(rows).collect()))
