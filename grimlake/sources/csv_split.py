"""Multi-line CSV read by many tasks.

Spark's ``multiLine`` reader gives a file to one task, since a line break may lie
inside a quoted field. Here files are read as lines, by byte range, and the
lines are put together again:

1. Each byte range's quotes are counted (one narrow pass). The parity of all
   quotes before a range says whether it begins inside a quoted field.
2. Lines meet their range's parity, and running parities inside the range give
   the lines at which records begin. Lines are shuffled once, by range.
3. A record that crosses ranges leaves a piece in each; the first and last
   records of the ranges, two rows each, are joined along the file.
4. ``from_csv`` parses the records with the reader's own options.

The files are as RFC 4180 has them, as Spark and the usual tools write them: a
field with a quote in it is quoted, and quotes inside are doubled. A record that
isn't fails the job (read such files with the plain reader). Empty lines are
skipped; records end with LF or CR LF.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.sources.stage import stored_table

QUOTED = "\u0001"


def well_formed() -> F.Column:
    """Whether ``text`` is comma-separated fields, each without quotes or quoted
    from end to end: with every quoted stretch as one mark (two where an inner
    quote is doubled), marks stand only beside commas and marks. A text without
    quotes is, and is not searched by patterns, which take many times as long."""
    text = F.col("text")
    unmarked = F.when(F.contains(text, F.lit(QUOTED)), F.translate(text, QUOTED, " ")).otherwise(text)
    marked = F.regexp_replace(unmarked, '"[^"]*+"', QUOTED)
    return F.when(F.contains(text, F.lit('"')), ~marked.rlike(f'"|[^,{QUOTED}]{QUOTED}|{QUOTED}[^,{QUOTED}]')).otherwise(True)


def without_return(text: str = "text") -> F.Column:
    """The text without the CR of its line end."""
    end = functools.reduce(lambda a, b: a | b, [F.endswith(text, F.lit(x)) for x in "\r\n\u0085\u2028\u2029"])
    return F.when(end, F.regexp_replace(text, "\r$", "")).otherwise(F.col(text))


def _pieces(spark: SparkSession, paths: str) -> DataFrame:
    """(file, block, rec, last, text): the lines of a byte range put together;
    ``rec`` 0 belongs to a record that began in an earlier range."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
        (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))).cast("long").alias("quotes"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored_table(lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"))
                          .select("file", "block", F.coalesce(F.sum("q").over(ahead), F.lit(0)).alias("before")),
                          "csv_blocks")
    own = Window.partitionBy("file", "block").orderBy("line")
    quoted = F.col("before") + F.coalesce(F.sum("quotes").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (quoted % 2 == 0).cast("int")
    rows = (lines.join(blocks, ["file", "block"]).withColumn("begins", begins)
            .withColumn("rec", F.sum("begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("recs", F.sum("begins").over(Window.partitionBy("file", "block"))))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"])
    records = rows.groupBy("file", "block", "rec", "recs").agg(F.array_join(texts, "\n").alias("text"))
    return records.select("file", "block", "rec", (F.col("rec") == F.col("recs")).alias("last"), "text")


def records(spark: SparkSession, paths: str, header: bool = True) -> DataFrame:
    """(text) of every record of the CSV files at ``paths``, line breaks in quoted
    fields included, without the files' header records."""
    pieces = stored_table(_pieces(spark, paths), "csv_pieces")
    border = F.col("last") | (F.col("rec") == 0)
    along = Window.partitionBy("file").orderBy("block", "rec")
    # A piece that isn't continued is a record of its own.
    ends = pieces.where(border).withColumn("home", F.sum((F.col("rec") > 0).cast("int")).over(along))
    order = F.struct("block", "rec", "text")
    joined = ends.groupBy("file", "home").agg(F.array_sort(F.collect_list(order)).alias("p")).select(
        F.col("p")[0]["block"].alias("block"), F.col("p")[0]["rec"].alias("rec"),
        F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    every = pieces.where(~border).select("block", "rec", "text").unionByName(joined)
    if header:
        every = every.where(~((F.col("block") == 0) & (F.col("rec") == 1)))
    return every.select(without_return().alias("text")).where("text != ''")


def read(spark: SparkSession, paths: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The files at ``paths`` with a declared schema, as the plain reader with
    ``options`` gives them, by as many tasks as they have byte ranges."""
    rows = records(spark, paths, options.get("header") == "true")
    wrong = F.raise_error(F.concat(F.lit("not RFC 4180, read it with the plain reader: "), F.substring("text", 1, 200)))
    text = F.when(well_formed(), F.col("text")).otherwise(wrong.cast("string"))
    parse = {k: v for k, v in options.items() if k != "header"}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # As rows of a generator, so that what follows reads columns and no record is parsed once for each.
    return rows.select(F.inline(F.array(F.from_csv(text, fields, parse))))
