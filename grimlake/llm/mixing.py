"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents, shuffled and laid end to end, form a stream of words
that is cut into blocks. 2^m slots are dealt to the sources by the base-2 van
der Corput sequence: point i goes to the source whose share of the unit
interval holds it, so every stretch of the schedule has the sources close to
their weights. The slots of a source, ranked, take its blocks in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.llm.common import cell_offsets, id_key, n_words, pick_rows, row_hash, stored, text_or_empty

BLOCK_WORDS = 2048
MAX_PASSES = 3
ROWS_PER_CELL = 512
SLOTS_PER_CELL = 4096
CHUNK = 1 << 16
#: Targets this close below a whole word count as whole.
EPSILON = 1e-6


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int,
               keys: bool = False) -> DataFrame:
    """Stored (rid, doc_id, source, size, okey); ``okey`` orders the shuffle."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(text_or_empty(text_col)).alias("size"),
                       *([id_key(id_col).alias("k"), row_hash(docs).alias("h")] if keys else []))
    okey = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    return stored(base.select(F.monotonically_increasing_id().alias("rid"), *base.columns, okey.alias("okey")),
                  "op8-rows")


def source_targets(rows: DataFrame, block_words: int, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: weight, source_size, target, quota (whole words)
    and its share [first, first + slots) of the 2^bits schedule points.

    Weights 1, 2, 3 repeat over the sources by code point, null last. Capping
    at ``max_passes`` times the size and resharing the excess by weight ends
    at min(cap, level * weight) with one common level; it is found over the
    sources ordered by cap / weight. Windows here run over one row per source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    every = Window.partitionBy(F.lit(0))
    level = (ranked.withColumn("weight", ((F.col("nth") - 1) % 3 + 1).cast("long"))
             .withColumn("cap", F.col("source_size") * max_passes)
             .withColumn("total", F.sum("source_size").over(every)))
    by_cap = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "nth")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (level.withColumn("try", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                              / F.sum("weight").over(after))
             .withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("try"), F.col("try")))
                         .over(every))
             .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
             .withColumn("quota", F.floor(F.col("target") + EPSILON).cast("long")))
    in_order = Window.partitionBy(F.lit(0)).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    used = F.when(F.col("quota") > 0, 1).otherwise(0)
    shares = (level.withColumn("cum", F.sum("quota").over(in_order)).withColumn("all", F.sum("quota").over(every))
              .withColumn("nth_used", F.sum(used).over(in_order)).withColumn("n_used", F.sum(used).over(every))
              .withColumn("bits", F.greatest(
                  F.ceil(F.log2(F.greatest(F.col("all") / block_words, F.lit(1.0)))),
                  F.ceil(F.log2(F.greatest(F.col("n_used"), F.lit(1)))) + 1).cast("int"))
              .withColumn("spread", F.expr("shiftleft(1L, bits)") - F.col("n_used")))
    # 2^bits points, one for each used source and the rest by quota; the bounds
    # are sums rounded down, so the shares are whole and fill the schedule.
    upto = F.when(F.col("all") > 0, F.floor(F.col("spread") * (F.col("cum") / F.col("all")))).otherwise(0)
    before_q = F.when(F.col("all") > 0, F.floor(
        F.col("spread") * ((F.col("cum") - F.col("quota")) / F.col("all")))).otherwise(0)
    return stored(shares.select(
        "source", "weight", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce("quota", F.lit(0)).alias("quota"), "bits",
        (before_q + F.col("nth_used") - used).cast("long").alias("first"),
        (upto - before_q + used).cast("long").alias("slots")), "op8-sources")


def reversed_bits(point: Column, bits: Column) -> Column:
    """Slot of a schedule point: its ``bits`` binary digits backwards. The van
    der Corput sequence visits point reverse(i) at slot i, and reversing twice
    gives the start back."""
    digits = F.lpad(F.bin(point), bits, F.lit("0"))
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(
        F.conv(F.reverse(digits), 2, 10).cast("long"))


def schedule(sources: DataFrame) -> DataFrame:
    """One row per slot: (slot, source, block, lo, hi), the words [lo, hi) of
    the source's stream that the slot takes. ``block`` is the slot's rank
    among its source's slots: ranked in cells of the schedule, shifted by the
    cells before, so no source is ranked in one task."""
    chunks = (sources.filter("slots > 0").withColumn(
        "chunk", F.explode(F.expr(f"sequence(0, (slots - 1) div {CHUNK})")))
        .repartition("source", "chunk"))
    last = F.least(F.col("first") + F.col("slots"), F.col("first") + (F.col("chunk") + 1) * CHUNK) - 1
    points = chunks.withColumn("point", F.explode(F.sequence(F.col("first") + F.col("chunk") * CHUNK, last)))
    per = SLOTS_PER_CELL.bit_length() - 1
    cell = F.lpad(F.hex(F.shiftright("slot", per)), 12, "0")
    slots = (points.withColumn("slot", reversed_bits(F.col("point"), F.col("bits")))
             .select("slot", "source", "quota", "slots").withColumn("cell", cell))
    counts = slots.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n"))
    base = cell_offsets(counts, "source", "cell", "n", 20).select(
        F.col("source").alias("_source"), F.col("cell").alias("_cell"), "offset")
    local = F.row_number().over(Window.partitionBy("source", "cell").orderBy("slot")) - 1
    ranked = (slots.withColumn("local", local)
              .join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
              .withColumn("block", F.col("offset") + F.col("local")))

    def cut(j: str) -> Column:  # floor(j * quota / slots) without large products
        return F.expr(f"({j}) * (quota div slots) + ({j}) * (quota % slots) div slots")

    return ranked.select("slot", "source", "block", cut("block").alias("lo"), cut("block + 1").alias("hi"))


def stream_positions(rows: DataFrame, n_rows: int) -> DataFrame:
    """Rows with their start in their source's shuffled stream (``start``).
    Sums run within cells of the shuffle order, about ``ROWS_PER_CELL`` rows
    each, shifted by the cells before; a hot source is many cells."""
    width = 0
    while 16 ** width * ROWS_PER_CELL < n_rows:
        width += 1
    celled = rows.withColumn("cell", F.substring("okey", 1, width))
    sums = celled.groupBy("source", "cell").agg(F.sum("size").alias("n"))
    base = cell_offsets(sums, "source", "cell", "n", width).select(
        F.col("source").alias("_source"), F.col("cell").alias("_cell"), "offset")
    order = (Window.partitionBy("source", "cell").orderBy("okey", "doc_id", "size", "rid")
             .rowsBetween(Window.unboundedPreceding, 0))
    return (celled.withColumn("upto", F.sum("size").over(order))
            .join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
            .withColumn("start", F.col("offset") + F.col("upto") - F.col("size"))
            .drop("upto", "offset", "_source", "_cell", "cell"))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           block_words: int = BLOCK_WORDS, max_passes: int = MAX_PASSES, seed: int = 0, keys: bool = False):
    """(rows, sources, pieces): ``pieces`` has one row per part of a document
    that one slot of the schedule takes: rid, slot, source, block, n."""
    rows = sized_rows(docs, id_col, text_col, source_col, seed, keys)
    sources = source_targets(rows, block_words, max_passes)
    placed = stream_positions(rows.filter("size > 0"), rows.count())
    info = sources.select(F.col("source").alias("_source"), "source_size", "quota", "slots").filter("quota > 0")
    passes = (placed.join(info, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("turn", F.explode(F.expr("sequence(0L, (quota - 1) div source_size)")))
              .withColumn("a", F.col("start") + F.col("turn") * F.col("source_size"))
              .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("quota"))).filter("a < b"))

    def block_of(x: str) -> Column:  # the block j with cut(j) <= x < cut(j + 1)
        return F.expr(f"cast((cast({x} + 1 as decimal(19,0)) * cast(slots as decimal(18,0)) - 1)"
                      f" div cast(quota as decimal(19,0)) as long)")

    parts = passes.withColumn("block", F.explode(F.sequence(block_of("a"), block_of("b - 1"))))
    blocks = schedule(sources).withColumnRenamed("source", "_src").withColumnRenamed("block", "_block")
    took = parts.select("rid", "source", "block", "a", "b").join(
        blocks, F.col("source").eqNullSafe(F.col("_src")) & (F.col("block") == F.col("_block")))
    took = took.select("rid", "slot", "source", "block",
                       (F.least("b", "hi") - F.greatest("a", "lo")).alias("n")).filter("n > 0")
    return rows, sources, took


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, max_passes: int = MAX_PASSES, seed: int = 0, keys: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, source, weight.

    A null text has size 0 and a document of size 0 is never taken. Null
    sources are one source, ordered last. Repeated rows are documents of
    their own; ids that repeat are ordered by size in the shuffle. Tables
    without words have targets of 0. Runs with one seed agree. ``keys`` adds
    (k, h), the hashes of the row's id and of the row.
    """
    rows, sources, took = pieces(docs, id_col, text_col, source_col, block_words, max_passes, seed, keys)
    per_row = took.groupBy("rid").agg(F.sum("n").alias("taken"))
    info = sources.select(F.col("source").alias("_source"), "source_size", "target", "weight")
    return (rows.join(per_row, "rid", "left").join(info, F.col("source").eqNullSafe(F.col("_source")), "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source", "weight",
                    *(["k", "h"] if keys else [])))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as it is taken,
    in part or whole; rows that aren't taken go."""
    found = mix(docs, id_col, text_col, source_col, keys=True, **options).filter("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).alias("copies")
    return pick_rows(docs, found.select("k", "h", copies), id_col)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0') AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), t AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS ratio, sum(source_size) OVER () AS total FROM s
), level AS (
  SELECT max(x) AS level FROM (
    SELECT a.source, any_value(a.ratio) AS ratio,
           (any_value(a.total) - coalesce(sum(3 * b.source_size) FILTER (b.ratio < a.ratio), 0))::DOUBLE
           / sum(b.weight) FILTER (b.ratio >= a.ratio) AS x
    FROM t a, t b GROUP BY a.source) WHERE ratio >= x
), g AS (
  SELECT source, weight, source_size, least(3.0::DOUBLE * source_size, level * weight) AS target,
         CAST(floor(least(3.0::DOUBLE * source_size, level * weight) + 1e-6) AS BIGINT) AS quota
  FROM t, level
), p AS (
  SELECT d.*, g.weight, g.source_size, g.target, g.quota,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
              ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
         (quota // source_size) * size + greatest(0, least(size, quota % source_size - start)) END AS taken,
       source, weight
FROM p
"""
