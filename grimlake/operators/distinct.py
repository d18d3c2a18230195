"""Exact distinct counts as mergeable bitmaps.

Several ``count(DISTINCT ...)`` in one aggregate make Spark repeat every row per
distinct column (``Expand``) and shuffle every value. Here a value is a bit:
``numbered`` gives the values of an id column dense places, and a group keeps
one bitmap of 32,768 bits per bucket in which it has a value. Bitmaps OR
together, and their bits are counted at the end. The places are shuffled, each
once, not the bitmaps: one is 4 KB from its first bit on, and built before the
shuffle every task would send one a group and bucket it meets.

Fit for ids with many rows a value and groups that are few against the values
(years, countries, genres). A group with few values costs 4 KB a bucket it
touches, so per-band counts stay ordinary aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grimlake.operators import ranks

#: Bits of one of Spark's bitmaps.
BITS = 32768
#: Values a cell holds on average, so that most cells are one bucket.
PER_CELL = BITS // 2


def bit(column: str) -> Column:
    """Name under which ``numbered`` gives the place of a column's value."""
    return F.col(f"_bit_{column}")


def numbered(df: DataFrame, column: str, per_cell: int = PER_CELL) -> DataFrame:
    """``df`` with ``bit(column)``: a struct (bucket, position) that equal values
    share and different values don't; null for null. Values are dealt to cells by
    their hash and numbered inside them, so no task sees all values. One shuffle
    of the distinct values, one join back (split by AQE where a value is hot)."""
    values = df.select(column).where(F.col(column).isNotNull())
    cells = max(1, -(-df.count() // per_cell))
    cell = F.pmod(F.xxhash64(column), F.lit(cells))
    place = F.row_number().over(Window.partitionBy("_cell").orderBy(column)) - 1
    dense = (values.distinct().withColumn("_cell", cell).withColumn("_place", place)
             .select(column, F.struct(
                 (F.col("_cell") * 2**31 + F.floor(F.col("_place") / BITS)).alias("bucket"),
                 (F.col("_place") % BITS).cast("long").alias("position")).alias(f"_bit_{column}")))
    return df.join(dense, column, "left")


def bitmaps(rows: DataFrame, keys: Sequence[str], counted: dict[str, Column]) -> DataFrame:
    """(keys, counted, bucket, bits): the state of the distinct counts
    ``counted`` (name -> bit struct, null where the row doesn't count). Repeated
    marks are dropped, then a group's marks of a bucket meet in one task, where its
    bitmap is built once."""
    marks = F.array(*[F.struct(F.lit(name).alias("counted"), b["bucket"].alias("bucket"),
                               b["position"].alias("position")) for name, b in counted.items()])
    state = [*keys, "counted", "bucket"]
    return (rows.select(*keys, F.inline(marks)).where(F.col("position").isNotNull()).distinct()
            .repartition(*state).groupBy(*state).agg(F.bitmap_construct_agg("position").alias("bits")))


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of several loads, or of finer groups, as one state a group of ``keys``."""
    return states.groupBy(*keys, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(states: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, names): the distinct counts of merged states."""
    n = lambda name: F.coalesce(F.sum(F.when(F.col("counted") == name, F.bitmap_count("bits"))), F.lit(0))
    return states.groupBy(*keys).agg(*[n(x).cast("long").alias(x) for x in names])


def with_distinct(out: DataFrame, rows: DataFrame, keys: Sequence[str], counted: dict[str, Column]) -> DataFrame:
    """``out`` (one row a group) with the distinct counts of ``rows``; a null key
    is a group, and a group without values counts 0."""
    found = counts(bitmaps(rows, keys, counted), keys, list(counted))
    return ranks.attach(out, found, keys).fillna(0, list(counted))


def labels(column: str | Column) -> Column:
    """Distinct count of a column with a fixed list of labels (genres, countries),
    whose set a group can hold."""
    return F.size(F.collect_set(column)).cast("long")
