"""What the CSV reader by byte range does to every record: once, and without patterns where none are needed."""

import itertools
import os
import tempfile

from pyspark.sql import functions as F

from grimlake.plans import staging
from grimlake.sources import csv_split
from grimlake.sources import raw as raw_io
from grimlake.sources.schemas import RAW_REVIEWS

MARK = csv_split.QUOTED


def texts(spark, parts, most):
    rows = {"".join(p) for n in range(most + 1) for p in itertools.product(parts, repeat=n)}
    return spark.createDataFrame([(x,) for x in sorted(rows)], "text string")


def test_records_are_parsed_once(spark):
    base = tempfile.mkdtemp(prefix="grimlake-csv-")
    os.makedirs(f"{base}/reviews")
    with open(f"{base}/reviews/0.csv", "w") as f:
        f.write('id,album,title,score,content\n1,2,a,5,"x\ny"\n2,,b,6,z\n')
    df = staging.stg_reviews(raw_io.read_csv_table(spark, base, "reviews", RAW_REVIEWS, split=True))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert [(r.review_id, r.album_id, r.content_review) for r in df.collect()] == [(1, 2, "x\ny")]


def test_well_formed_texts_are_those_of_the_pattern(spark):
    df = texts(spark, ['"', ",", "a", MARK, "\n"], 6)
    marked = F.regexp_replace(F.translate("text", MARK, " "), '"[^"]*+"', MARK)
    want = ~marked.rlike(f'"|[^,{MARK}]{MARK}|{MARK}[^,{MARK}]')
    odd = df.where(~csv_split.well_formed().eqNullSafe(want))
    assert odd.count() == 0 and 0 < df.where(want).count() < df.count()


def test_only_line_ends_are_taken_off(spark):
    df = texts(spark, ["a", "\r", "\n", "\u0085", " ", "é"], 4)
    odd = df.where(csv_split.without_return() != F.regexp_replace("text", "\r$", ""))
    assert odd.count() == 0


def test_texts_without_quotes_meet_no_pattern(spark):
    plan = spark.range(1).select(F.lit("x").alias("text")).select(csv_split.well_formed())
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.startswith("Project [CASE WHEN Contains(")
