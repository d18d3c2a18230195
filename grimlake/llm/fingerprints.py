"""Document fingerprints by consistent weighted sampling.

A document is its words weighted by their counts. For each of the samples a
word of weight S draws r, c from Gamma(2, 1) and b from U(0, 1), all hashed
from the word, and takes t = floor(ln S / r + b), ln a = ln c - r (t - b + 1);
the word with the smallest a is the sample. The minimum itself stands for the
sampled (word, t): two documents share it with a probability equal to their
generalised Jaccard similarity, sum of min weights over sum of max weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grimlake.llm.common import WORD, stored, text_or_empty

SAMPLES = 32
CHARS_PER_TASK = 2_000_000
#: Hex digits kept of each sample.
DIGITS = 4


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """ln a of sample ``k`` for a word hash and its log weight."""
    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))

    def uniform(h: Column, shift: int, bits: int) -> Column:
        part = F.shiftrightunsigned(h, shift) if shift else h
        return (part.bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(0.5)) * F.lit(2.0 ** -bits)

    r = -F.log(uniform(one, 0, 32) * uniform(one, 32, 32))
    b = uniform(two, 0, 20)
    log_c = F.log(-F.log(uniform(two, 20, 22) * uniform(two, 42, 22)))
    return log_c - r * (F.floor(log_weight / r + b) - b + 1)


def signature(samples: int) -> list[Column]:
    """Aggregates of one document's (term, log_s) rows: the minimum of each sample."""
    return [F.min(sample(F.col("term"), F.col("log_s"), k)).alias(f"s{k}") for k in range(samples)]


def to_hex(samples: int) -> Column:
    """Samples as ``DIGITS`` hex digits each; of a document without words, of null."""
    mask = (1 << (4 * DIGITS)) - 1
    return F.concat(*[F.lower(F.lpad(F.hex(F.xxhash64(f"s{k}").bitwiseAND(F.lit(mask))), DIGITS, "0"))
                      for k in range(samples)])


def likeness(a: str, b: str, samples: int) -> Column:
    """Share of equal samples of two fingerprints."""
    same = [F.when(F.substring(a, 1 + DIGITS * k, DIGITS) == F.substring(b, 1 + DIGITS * k, DIGITS), 1)
            .otherwise(0) for k in range(samples)]
    total = same[0]
    for x in same[1:]:
        total = total + x
    return total / F.lit(float(samples))


def fingerprint(bodies: DataFrame, keys: list[str], body: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and fingerprint of each row of ``bodies``; rows with equal keys
    are one document. If ``bodies`` is partitioned by some of the keys, both
    aggregations run in place."""
    terms = bodies.select(*keys, F.explode_outer(F.regexp_extract_all(F.col(body), F.lit(WORD), 0)).alias("word"))
    counts = (terms.select(*keys, F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
              .groupBy(*keys, "term").agg(F.log(F.count("term").cast("double")).alias("log_s")))
    return counts.groupBy(*keys).agg(*signature(samples)).select(*keys, to_hex(samples).alias("fingerprint"))


def followers(docs: DataFrame) -> DataFrame:
    """(kd, h, doc_id, n, nkd, nh): each distinct document of (doc_id, kd, h, n) and the
    next one by descending doc_id, the first after the last.

    Ids alone are ordered: ranges of them in tasks of their own, and one row
    per range to find the next range's first id.
    """
    ids = docs.groupBy("kd", "h").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"))
    place = F.struct("doc_id", "h", "kd").alias("place")
    ranged = stored(ids.repartitionByRange(F.col("doc_id").desc_nulls_last(), F.col("h").desc())
                    .select(F.spark_partition_id().alias("range"), "kd", "h", "n", place), "op9-ids")
    heads = ranged.groupBy("range").agg(F.max("place").alias("head"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("range")
    every = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(F.col("range").alias("_range"), F.coalesce(
        F.lead("head").over(by_range), F.first("head").over(every)).alias("after"))
    inner = Window.partitionBy("range").orderBy(F.col("place").desc())
    return (ranged.withColumn("next", F.lead("place").over(inner))
            .join(after, F.col("range") == F.col("_range"))
            .select("kd", "h", "place.doc_id", "n", F.coalesce("next", "after").alias("next"))
            .select("kd", "h", "doc_id", "n", F.col("next.kd").alias("nkd"), F.col("next.h").alias("nh")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        samples: int = SAMPLES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Null text counts as empty; texts without words share one fingerprint. Null
    ids come last. Rows that repeat an id with another text are ordered by the
    text's hash; rows repeated in full are one document in that order and get
    equal results. A table of one document follows itself; an empty table
    gives an empty result. Text is moved once, and the third that replaces a
    text's end once more; very long texts are rows like others.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    no_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00"))
    base = base.select("doc_id", F.xxhash64(no_id).alias("kd"), F.xxhash64("text").alias("h"), "text")
    sizes = base.select("doc_id", "kd", "h", F.char_length("text").alias("n"))
    base = base.drop("doc_id")  # both uses of the texts below read one shuffle of the same columns
    chars = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    nexts = stored(followers(sizes), "op9-next")
    parts = max(1, -(-int(chars) // CHARS_PER_TASK))
    same = Window.partitionBy("kd", "h").orderBy(F.lit(0))
    rows = base.repartition(parts, "kd", "h").withColumn("copy", F.row_number().over(same))
    heads = (rows.filter("copy = 1").select(F.col("kd").alias("nkd"), F.col("h").alias("nh"), "text")
             .join(nexts, ["nkd", "nh"])
             .select("kd", "h", "n", "doc_id", F.expr("left(text, n div 3)").alias("head"))
             .repartition(parts, "kd", "h"))
    edits = rows.join(heads, ["kd", "h"]).withColumn(
        "edited", F.concat(F.expr("left(text, n - n div 3)"), "head"))
    # Body 2 carries the edited text's digest along the same grouping.
    none = F.lit(None).cast("string")
    bodies = edits.select("kd", "h", "copy", "n", "doc_id", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("body"), none.alias("sha")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("body"), none.alias("sha")),
        F.struct(F.lit(2).alias("which"), F.lit("").alias("body"), F.sha2("edited", 256).alias("sha")))).alias("x"))
    bodies = bodies.select("kd", "h", "copy", "n", "doc_id", "x.which", "x.sha", "x.body")
    prints = fingerprint(bodies, ["kd", "h", "copy", "n", "doc_id", "which", "sha"], "body", samples)
    of = lambda i: F.max(F.when(F.col("which") == i, F.col("fingerprint")))
    done = stored(prints.groupBy("kd", "h", "copy", "n", "doc_id").agg(
        of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"), F.max("sha").alias("edited_sha256")),
        "op9-prints")
    other = done.filter("copy = 1").select(F.col("kd").alias("nkd"), F.col("h").alias("nh"),
                                           F.col("fingerprint").alias("next_fingerprint"))
    return (done.join(nexts.select("kd", "h", "nkd", "nh"), ["kd", "h"]).join(other, ["nkd", "nh"])
            .select("doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint",
                    "edited_fingerprint", likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"),
                    likeness("fingerprint", "next_fingerprint", samples).alias("near_next")))
