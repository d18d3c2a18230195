"""Exact dedup with an extendible-hash index on shared files.

Texts are equal when they are identical after each run of white space became
one space. The index addresses normalised texts by a 64-bit hash; its
directory doubles until every bucket fits, tasks own ranges of the key space,
and texts that share a key are chained and told apart by their bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.llm.common import SPACE, id_key, pick_rows, row_hash, stored, text_or_empty

BUCKET_BYTES = 64 << 20
MAX_DEPTH = 20


def normalised(text_col: str = "text"):
    return F.regexp_replace(text_or_empty(text_col), SPACE, " ")


def address(norm, key_bits: int = 64):
    """Index key: the leading ``key_bits`` of the text's hash, as a long."""
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - key_bits) if key_bits < 64 else F.xxhash64(norm)


def chained(docs: DataFrame, text_col: str, key_bits: int = 64) -> DataFrame:
    """One row per distinct text: (key, sha, size, bytes).

    Grouping by key and text compares the bytes of texts with one key, so a
    collision is a chain of several rows. Spark combines equal texts in the
    map tasks first: a text that a third of all rows repeat leaves one row
    per map task, and text is shuffled once.
    """
    norm = normalised(text_col)
    return (docs.select(norm.alias("norm")).select(address(F.col("norm"), key_bits).alias("key"), "norm")
            .groupBy("key", "norm").agg(F.count(F.lit(1)).alias("size"))
            .select("key", F.sha2("norm", 256).alias("sha"), "size",
                    F.octet_length("norm").cast("long").alias("bytes")))


def directory(entries: DataFrame, bucket_bytes: int, max_depth: int, key_bits: int = 64) -> DataFrame:
    """Directory slots of the index: (slot, bucket, depth) at the global depth.

    Level d of the doubling holds the 2^d key prefixes; a bucket splits while
    it holds over ``bucket_bytes`` of several texts, at most ``max_depth``
    times. Its row is repeated for each slot that points to it, as in the
    classic directory. Works on sums per prefix, never on texts.
    """
    cell = F.shiftrightunsigned("key", key_bits - max_depth)
    hist = entries.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("held"), F.count(F.lit(1)).alias("texts"))
    levels = (hist.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
              .groupBy("depth", F.expr(f"shiftright(cell, {max_depth} - depth)").alias("prefix"))
              .agg(F.sum("held").alias("held"), F.sum("texts").alias("texts")))
    over = (F.col("held") > bucket_bytes) & (F.col("texts") > 1) & (F.col("depth") < max_depth)
    split = levels.filter(over).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    rest = levels.filter(~over).withColumn("parent", F.shiftright("prefix", 1))
    return stored(rest.filter("depth = 0").drop("parent").unionByName(
        rest.filter("depth > 0").join(split, ["depth", "parent"], "left_semi").drop("parent")), "op10-directory")


def build_index(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH,
                key_bits: int = 64) -> DataFrame:
    """Write the index: its rows by bucket, each task owning a range of keys.

    Returns the stored index (bucket, key, chain, sha, size, bytes, ...);
    ``chain`` counts the texts of one key from 0.
    """
    max_depth = min(max_depth, key_bits)
    leaves = directory(entries, bucket_bytes, max_depth, key_bits)
    depth = leaves.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("g")).first()["g"]
    slots = leaves.withColumn(
        "slot", F.explode(F.expr(
            f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)"))
    ).select("slot", F.expr(f"shiftleft(prefix, {depth} - depth)").alias("bucket"))
    slot = F.shiftrightunsigned("key", key_bits - depth) if depth else F.lit(0).cast("long")
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("sha")) - 1
    owned = (entries.withColumn("slot", slot).join(slots, "slot").drop("slot")
             .withColumn("chain", chain)
             .repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain"))
    return stored(owned, "op10-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH,
                key_bits: int = 64, keys: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, so null and blank-free empty texts are one
    group. Of equal texts the row with the smallest doc_id stays; null ids
    come last; if rows repeat that id, exactly one of them stays. An empty
    table gives an empty result. Very long texts are compared whole.
    ``key_bits`` shortens the index key (tests force collisions with it);
    ``keys`` adds (k, h), the hashes of the row's id and of the row.
    """
    norm = normalised(text_col)
    named = [id_key(id_col).alias("k"), row_hash(docs).alias("h")] if keys else []
    extra = ["k", "h"] if keys else []
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"), *named)
        .select(F.monotonically_increasing_id().alias("rid"), "doc_id", *extra,
                address(F.col("norm"), key_bits).alias("key"), F.sha2("norm", 256).alias("sha")), "op10-rows")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("rid")))
    heads = rows.groupBy("key", "sha").agg(head.alias("head"))
    entries = stored(chained(docs, text_col, key_bits).join(heads, ["key", "sha"])
                     .select("key", "sha", "size", "bytes", "head"), "op10-entries")
    index = build_index(entries, bucket_bytes, max_depth, key_bits)
    found = index.select("key", "sha", F.col("head.doc_id").alias("keep_id"),
                         F.col("size").alias("group_size"), F.col("head.rid").alias("keep_rid"))
    return (rows.join(found, ["key", "sha"])
            .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    F.col("sha").alias("text_sha256"), *extra))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with their columns."""
    found = exact_dedup(docs, id_col, text_col, keys=True).filter("kept")
    return pick_rows(docs, found.select("k", "h", F.lit(1).alias("copies")), id_col)


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""
