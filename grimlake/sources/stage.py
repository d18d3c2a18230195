"""Stored intermediate tables in the cluster's checkpoint folder.

A model that several readers scan (the source stores them as tables) is
written once as Parquet under the reliable checkpoint folder and read back.
Compared with ``Dataset.checkpoint`` this keeps the columnar layout, so
readers that need three columns of a wide fact read three columns, and it
cuts lineage the same way: a lost executor re-reads the written files
instead of recomputing the model. Values that a recomputed task could change
(generated row keys) are fixed by the write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grimlake.operators.joins import unless_many
from grimlake.session import checkpoint_dir


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder of stored tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def stored_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once (Parquet, replace mode) and return a scan of it; to a
    folder of its own in the scratch folder unless ``path`` is given. Scans of many
    rows are never broadcast, nor is what is grouped from them (``joins.unless_many``),
    but where ``F.broadcast`` says so."""
    spark = df.sparkSession
    path = path or f"{scratch_dir(spark)}/{name}_{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return unless_many(spark.read.schema(df.schema).parquet(path))


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's stored tables (frames that read them end)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
