"""Exact continuous percentiles of groups with as many kinds of values as rows.

Spark's ``percentile`` keeps all kinds of values of a group in one task's map.
Here values are counted, the counts are dealt to range cells of the value, and
prefix sums over the cells say in which cell of a group a wanted place lies.
Only those cells are read in order, each by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grimlake.operators import ranks
from grimlake.sources.stage import stored_table


def percentiles(df: DataFrame, keys: Sequence[str], value: str, percentages: dict[str, float],
                limit: int | None = None) -> DataFrame:
    """(keys, names): the percentiles ``percentages`` (name -> share) of the non-null
    values of each group, interpolated between neighbours. A null key is a group;
    a group without values has nulls. ``limit`` is how many kinds of values a
    cell holds about; it changes the plan's balance, not the result."""
    keys = list(keys)
    groups = df.select(*keys).distinct()
    v = F.col(value).cast("double")
    counts = stored_table(df.where(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")),
                          "percentile_counts")
    limit = limit or ranks.max_rows_per_task(df.sparkSession)
    cuts = ranks.tie_splits(counts, "_v", -(-counts.count() // limit))
    counts = ranks.apply_tie_bucket(counts, "_v", cuts, "_cell")

    group = Window.partitionBy(*keys)
    ahead = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (counts.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_in"))
             .withColumn("_before", F.coalesce(F.sum("_in").over(ahead), F.lit(0)))
             .withColumn("_places", F.sum("_in").over(group) - 1))
    places = []
    for name, p in percentages.items():
        at = F.col("_places") * F.lit(float(p))
        for of, weight in ((F.floor(at), 1 - (at - F.floor(at))), (F.floor(at) + 1, at - F.floor(at))):
            places.append(F.struct(F.lit(name).alias("name"), of.alias("place"), weight.alias("weight")))
    here = F.filter(F.array(*places), lambda x: (x["weight"] > 0) & (x["place"] >= F.col("_before")) &
                    (x["place"] < F.col("_before") + F.col("_in")))
    wanted = stored_table(cells.select(*keys, "_cell", "_before", here.alias("_wanted")).where(F.size("_wanted") > 0),
                          "percentile_places")

    inside = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    rows = (ranks.attach(counts, wanted, [*keys, "_cell"], "inner", rows=wanted.count())
            .withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))))
    found = F.filter("_wanted", lambda x: (x["place"] >= F.col("_from")) & (x["place"] < F.col("_from") + F.col("_n")))
    picked = rows.select(*keys, "_v", F.explode(found).alias("_w"))
    out = picked.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("_w.name") == name, F.col("_w.weight") * F.col("_v"))).alias(name) for name in percentages])
    return ranks.attach(groups, out, keys)
