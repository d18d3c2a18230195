"""Helpers shared by the operators: stored intermediates, word patterns and
distributed prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.session import checkpoint_dir

#: Fixed values of the query contracts: white space and words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder under the shared ``spark.checkpoint.dir``."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and scan it.

    Cuts lineage (a lost executor rereads files) and fixes values that a
    recomputed task could change, such as generated row ids.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__[STORED] = path
    return out


STORED = "_grimlake_stored"


def drop_stored(*tables: DataFrame) -> None:
    """Delete stored tables whose last reader has been written."""
    for table in tables:
        _delete(table.sparkSession, table.__dict__[STORED])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's stored intermediates. Results that were not
    written yet can't be read afterwards."""
    _delete(spark, scratch_dir(spark))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_key(col: str) -> Column:
    """64-bit hash of an id, null included."""
    return F.xxhash64(F.coalesce(F.col(col).cast("string"), F.lit("\x00")))


def row_hash(docs: DataFrame) -> Column:
    """64-bit hash of a whole row: rows that differ in any column differ in it."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[x for c in plain for x in (c, c.isNull())])


def id_as_text(docs: DataFrame, id_col: str) -> tuple[Column, str]:
    """(id as text, its type). Ids go to Python as text and are cast back: as
    numbers beside a null they would become doubles, which end at 2^53."""
    return F.col(id_col).cast("string"), docs.select(id_col).schema[0].dataType.simpleString()


def pick_rows(docs: DataFrame, picked: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` that ``picked`` names by (k, h), the hashes of id and
    row, ``copies`` times each, with their columns. Rows repeated in full are
    one row, of which a map task sends one."""
    k, h, nth, n = ("__grimlake_k", "__grimlake_h", "__grimlake_nth", "__grimlake_copies")
    wanted = picked.groupBy(F.col("k").alias(k), F.col("h").alias(h)).agg(F.sum("copies").alias(n))
    rows = docs.withColumns({k: id_key(id_col), h: row_hash(docs)})
    first = F.row_number().over(Window.partitionBy(k, h).orderBy(k))
    rows = rows.join(wanted, [k, h]).withColumn(nth, first).filter(F.col(nth) == 1)
    rows = rows.withColumn(nth, F.explode(F.expr(f"sequence(1L, {n})")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def cell_offsets(cells: DataFrame, group: str, cell: str, value: str, width: int) -> DataFrame:
    """Exclusive prefix sum of ``value`` over ``cell`` (a fixed-width string of
    ``width`` characters) within ``group``.

    Two levels: sums of the cells' leading halves are prefixed first, so no
    window holds more than about the square root of a group's cells.
    """
    head = F.substring(cell, 1, width // 2)
    supers = cells.groupBy(group, head.alias("_head")).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select(F.col(group).alias("_group"), F.col("_head").alias("_key"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = (Window.partitionBy(group, "_head").orderBy(cell)
             .rowsBetween(Window.unboundedPreceding, -1))
    local = cells.withColumn("_head", head).withColumn(
        "_local", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (local.join(supers, F.col(group).eqNullSafe(F.col("_group"))
                       & (F.col("_head") == F.col("_key")))
            .select(group, cell, (F.col("_base") + F.col("_local")).cast("long").alias("offset")))
