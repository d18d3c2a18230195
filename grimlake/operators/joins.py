"""Join forms that stay balanced when one key holds a large share of rows, and
joins of stored tables by their counted rows.

Spark takes a scan to be as large as its files. Stored tables are compressed, and
ids and labels leave a tenth of what they are as rows or less, so millions of rows
pass for a table that is small enough to broadcast, and the driver that collects
them runs out of memory. AQE does not undo it where that would add a shuffle. So
their rows are counted here (from the files' footers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS_CONF = "spark.grimlake.broadcast.maxRows"
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES_CONF = "spark.grimlake.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_rows_limit(spark) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def row_bytes(schema: T.StructType) -> int:
    """About what a row of ``schema`` takes in memory: 8 bytes a value, 24 a text."""
    texts = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    return 16 + sum(24 if isinstance(f.dataType, texts) else 8 for f in schema.fields)


def few(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` has few enough rows to be broadcast: at most
    ``spark.grimlake.broadcast.maxRows``, and ``spark.grimlake.broadcast.maxBytes`` as
    rows in memory. ``rows``, if known, is not counted."""
    spark = df.sparkSession
    rows = df.count() if rows is None else rows
    most = int(spark.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))
    return rows <= broadcast_rows_limit(spark) and rows * row_bytes(df.schema) <= most


def not_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of joins that shuffle and sort both, at any estimate; also
    when filtered or grouped before. ``F.broadcast`` of either side comes first."""
    return df.hint("merge")


def unless_many(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, a scan of stored rows: left to Spark's estimate where its rows are
    few, else ``not_broadcast``."""
    return df if few(df, rows) else not_broadcast(df)


def sized_join(left: DataFrame, right: DataFrame, on, left_rows: int | None = None,
               right_rows: int | None = None) -> DataFrame:
    """Inner join of two stored tables by their counted rows: of one with few rows
    and one with many the first is broadcast; two with many are shuffled."""
    many_left, many_right = not few(left, left_rows), not few(right, right_rows)
    if many_left and many_right:
        right = not_broadcast(right)
    elif many_left:
        right = F.broadcast(right)
    elif many_right:
        left = F.broadcast(left)
    return left.join(right, on, "inner")


def left_join_split(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    right_keys: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a right side with hot keys.

    AQE can split a skewed partition of either side of an *inner* join but
    not the right side of a left outer join (unmatched left rows would be
    emitted once per split). So the matched rows come from an inner join
    and the unmatched left rows from an anti join against the right side's
    distinct keys (one row per key, so no hot key there), padded with nulls.
    Same rows as the left join, including the fan-out of duplicate keys.
    ``right_keys`` may give a cheaper frame with the same set of key values
    as ``right`` (e.g. the albums under an albums-with-reviews frame).
    """
    keys = list(keys)
    matched = left.join(right, keys, "inner")
    key_source = right if right_keys is None else right_keys
    unmatched = left.join(key_source.select(*keys).distinct(), keys, "left_anti")
    pads = [F.lit(None).cast(f.dataType).alias(f.name)
            for f in right.schema.fields if f.name not in keys]
    return matched.unionByName(unmatched.select(*unmatched.columns, *pads))
