"""The registered queries of the subpackage, as the driver calls them."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from grimlake.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
#: op4's SQL takes long even here; it is compared in test_corpus.
SQL = sorted(set(queries.oracle_sql()) - {"op4_substring_dedup"})


def test_all_are_registered():
    found = E.queries()
    assert set(queries.queries()) | {"pipeline"} <= set(found)
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.queries()}
    assert set(queries.oracle_sql()) <= set(E.oracle_sql())


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", SQL)
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    want = Counter(tuple(norm(dict(zip(names, r))[c]) for c in sorted(names)) for r in rel.fetchall())
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(norm(r[c]) for c in sorted(names)) for r in df.collect()) == want


def test_rows_of_those_without_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_piece_tokens", "op12_byte_tokens"):
        assert E.queries()[name](spark, SF).count() == docs
