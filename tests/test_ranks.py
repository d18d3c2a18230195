"""Distributed operators equal the plain window / join forms, including a
hot key holding a large share of the rows and null group keys."""

import random

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from grimlake.operators import ranks
from grimlake.operators.joins import left_join_split


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        grp = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        score = 50.0 if i % 3 == 0 else float(rnd.randint(0, 20) * 5)
        rows.append((i, grp, score, rnd.randint(1, 40), rnd.randint(1, 10**9)))
    return spark.createDataFrame(rows, "_rk long, grp string, score double, band int, tie long")


def sorted_rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("part", [None, "grp", ["grp", "band"]])
@pytest.mark.parametrize("desc", [True, False])
@pytest.mark.parametrize("limit", [10**9, 50])
def test_row_number_frame(spark, data, part, desc, limit):
    # limit 50: every score value exceeds a "task", so tie ranges split it.
    got = ranks.row_number_frame(data, part, "score", desc, "tie", "rn", limit=limit)
    parts = [] if part is None else ([part] if isinstance(part, str) else part)
    order = F.col("score").desc_nulls_last() if desc else F.col("score").asc_nulls_last()
    w = Window.partitionBy(*parts).orderBy(order, F.col("tie").asc())
    want = data.select("_rk", F.row_number().over(w).alias("rn"))
    assert sorted_rows(got, ["_rk", "rn"]) == sorted_rows(want, ["_rk", "rn"])


@pytest.mark.parametrize("limit", [10**9, 50])
def test_cells_rank_percent_rank_and_mean(spark, data, limit):
    order = [F.col("score").desc_nulls_last(), F.col("tie"), F.col("_rk")]
    cells = ranks.ordered_cells(data, order, limit)
    histogram = ranks.cell_histogram(cells, [("grp",)], "score")
    for part in [(), ("grp",)]:
        table = ranks.cell_table(histogram, [("grp",)], part, "score")
        got = ranks.attach(cells, table, [*part, "score", ranks.CELL]).select(
            "_rk", (F.col("_before") + ranks.place_in(part)).alias("rn"),
            F.round(ranks.percent_from(F.col("_before_asc"), F.col("_group_n")), 9).alias("pr"),
            F.round(F.col("_group_sum").cast("double") / F.col("_group_n"), 9).alias("a"))
        w = Window.partitionBy(*part)
        want = data.select("_rk", F.row_number().over(w.orderBy(*order)).alias("rn"),
                           F.round(F.percent_rank().over(w.orderBy("score")), 9).alias("pr"),
                           F.round(F.avg("score").over(w), 9).alias("a"))
        assert sorted_rows(got, ["_rk", "rn", "pr", "a"]) == sorted_rows(want, ["_rk", "rn", "pr", "a"])
    got = ranks.cell_ranks(cells, cells, "grp", "rn").select("_rk", "rn")
    want = data.select("_rk", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).alias("rn"))
    assert sorted_rows(got, ["_rk", "rn"]) == sorted_rows(want, ["_rk", "rn"])


def test_cells_split_ties_and_nulls(spark):
    """One score, no review ids, two albums, one digest for half of the rows:
    cells still hold few rows, and follow each other."""
    rows = spark.range(6000).select(F.col("id").alias("_rk"), F.lit(80.0).alias("score"), F.lit(None).cast("long").alias("review"),
                                    (F.col("id") % 2).alias("album"), F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(
                                        F.md5(F.col("id").cast("string"))).alias("digest"))
    order = [F.col("score").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("review", "album", "digest", "_rk")]]
    cells = ranks.ordered_cells(rows, order, 400)
    largest = cells.groupBy(ranks.CELL).count().agg(F.max("count")).first()[0]
    assert largest <= 400
    by_cell = [r._rk for r in cells.orderBy(ranks.CELL, ranks.PLACE).collect()]
    assert by_cell == [r._rk for r in rows.orderBy(*order).collect()]
    places = cells.groupBy(ranks.CELL).agg(F.min(ranks.PLACE).alias("a"), F.max(ranks.PLACE).alias("b"), F.count(F.lit(1)).alias("n"))
    assert all(r.a == 0 and r.b == r.n - 1 for r in places.collect())
    assert ranks.ordered_cells(rows.limit(0), order).count() == 0


def test_group_stats_null_group(spark, data):
    got = ranks.attach(data, ranks.group_stats(data, "grp", {"a": F.avg("score"),
                                                             "n": F.count(F.lit(1))}), "grp")
    w = Window.partitionBy("grp")
    want = data.select("_rk", F.avg("score").over(w).alias("a"), F.count(F.lit(1)).over(w).alias("n"))
    assert sorted_rows(got, ["_rk", "a", "n"]) == sorted_rows(want, ["_rk", "a", "n"])


@pytest.mark.parametrize("limit", [1, 50, 10**9])
def test_lag_over(spark, data, limit):
    """Equal to a window whatever the cells, with null and repeated tie keys."""
    rows = data.select("band", (F.col("_rk") % 7).alias("year"), F.col("_rk").cast("long").alias("album"),
                       F.when(F.col("tie") % 5 != 0, F.col("tie") % 11).alias("review"), "score")
    rows = rows.withColumn("album", F.col("album") % 3).where("score IS NOT NULL")
    rows = rows.unionByName(rows.where("review = 1"))
    order = ["year", "album", "review", "score"]
    got = ranks.lag_over(rows, "band", order, "prev", limit=limit)
    w = Window.partitionBy("band").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    want = rows.withColumn("prev", F.lag("score", 1).over(w))
    cols = ["band", *order, "prev"]
    count = lambda df: Counter(tuple(r) for r in df.select(*cols).collect())
    assert count(got) == count(want)


def test_dominant_value_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "x"), (1, "y"), (1, None), (1, None), (1, "x"), (1, "y"), (2, None), (3, "b"),
         (3, "a")], "k int, v string")
    got = {r.k: r.d for r in ranks.dominant_value(df, "k", "v", "d").collect()}
    # 1: x, y and null tie at two -> smallest non-null value; 2: only null; 3: a < b.
    assert got == {1: "x", 2: None, 3: "a"}


def test_left_join_split(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (5, 50)], "k int, r int")
    rows = lambda df: sorted(tuple(str(x) for x in r) for r in df.select("k", "l", "r").collect())
    assert rows(left_join_split(left, right, ["k"])) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("limit", [100, 10**9])
def test_partition_columns_ranks_only(spark, data, limit):
    specs = [ranks.RankSpec.of(p, "score", True, "tie", f"rn{i}")
             for i, p in enumerate([None, "grp", "band"])]
    got = ranks.partition_columns(data, [ranks.Work(s.partition, s.order, rank=s) for s in specs],
                                  limit=limit)
    cols = ["_rk", "rn0", "rn1", "rn2"]
    want = data.select("_rk", *[F.row_number().over(sp.window()).alias(sp.out) for sp in specs])
    assert sorted_rows(got, cols) == sorted_rows(want, cols)


@pytest.mark.parametrize("limit", [100, 10**9])
def test_partition_columns_ranks_and_aggs(spark, data, limit):
    works = [ranks.Work((), "score", ranks.RankSpec.of(None, "score", True, "tie", "r0"),
                        {"a0": F.avg("score")}),
             ranks.Work("grp", "score", ranks.RankSpec.of("grp", "score", True, "tie", "r1"),
                        {"a1": F.avg("score"), "n1": F.count(F.lit(1))}),
             ranks.Work("band", "score", None, {"n2": F.count(F.lit(1))})]
    got = ranks.partition_columns(data, works, limit=limit)
    wg, wb = Window.partitionBy("grp"), Window.partitionBy("band")
    want = data.select(
        "_rk", *[F.row_number().over(w.rank.window()).alias(w.rank.out) for w in works[:2]],
        F.avg("score").over(Window.partitionBy()).alias("a0"), F.avg("score").over(wg).alias("a1"),
        F.count(F.lit(1)).over(wg).alias("n1"), F.count(F.lit(1)).over(wb).alias("n2"))
    cols = ["_rk", "r0", "r1", "a0", "a1", "n1", "n2"]
    rnd = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith("a") else c for c in cols])
    assert sorted_rows(rnd(got), cols) == sorted_rows(rnd(want), cols)


def test_group_profiles_one_job(spark, data):
    profs = ranks.group_profiles(data, [(None, "score"), ("grp", "score"), ("band", "score")])
    n = data.count()
    assert profs[((), "score")].groups == 1 and profs[((), "score")].max_group == n
    g = data.groupBy("grp").count().collect()
    assert profs[(("grp",), "score")].groups == len(g)
    assert profs[(("grp",), "score")].max_group == max(r["count"] for r in g)
