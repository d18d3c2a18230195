"""A1-A12 on the edge rows of the activity-period grammar (current year 2024)."""

import pytest
from pyspark.sql import types as T

from grimlake.plans import periods

Y = 2024
# active, periods_count, start, end, status, years_active, (flag, previous, year), is_na
CASES = [
    ("N/A", 0, None, None, "Unknown", None, (False, None, None), True),
    (None, 0, None, None, "Unknown", None, (False, None, None), False),
    ("1990-1995", 1, 1990, 1995, "Split-up", 5, (False, None, None), False),
    ("1990-present", 1, 1990, None, "Active", Y - 1990, (False, None, None), False),
    ("?-1995", 1, 1995, None, "Unknown", None, (False, None, None), False),
    ("?-1995|1999-present", 2, 1999, None, "Active", Y - 1999, (False, None, None), False),
    ("1985-?", 1, 1985, None, "Unknown", None, (False, None, None), False),
    ("1990-1994 (as Foo)|1994-present", 2, 1990, None, "Active", Y - 1990, (True, "Foo", 1994), False),
    ("1990-1994 (as Foo)", 1, 1990, None, "Unknown", None, (True, "Foo", None), False),
    ("1988-1989|1990-2000|2001-2003|2005-present", 3, 1988, 2003, "Split-up", 15,
     (False, None, None), False),
    ("1991", 1, None, None, "Unknown", None, (False, None, None), False),
    ("199?-2000", 1, None, None, "Unknown", None, (False, None, None), False),
    ("", 1, None, None, "Unknown", None, (False, None, None), False),
]

SCHEMA = T.StructType([
    T.StructField("band_id", T.LongType()), T.StructField("band_name", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("formed_year", T.IntegerType()), T.StructField("genre", T.StringType()),
    T.StructField("theme", T.StringType()), T.StructField("active_periods", T.StringType()),
])


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, f"b{i}", None, None, None, None, None, c[0]) for i, c in enumerate(CASES)]
    out = periods.parse(spark.createDataFrame(rows, SCHEMA), current_year=Y).collect()
    return {r.band_id: r for r in out}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_edge_row(parsed, i):
    active, count, start, end, status, years, (flag, prev, year), na = CASES[i]
    r = parsed[i]
    assert r.periods_count == count, active
    assert r.start_year == start, active
    assert r.end_year == end, active
    assert r.current_status == status, active
    assert r.years_active == years, active
    assert (r.has_name_change, r.previous_name, r.name_change_year) == (flag, prev, year), active
    assert r.is_na_case == na, active
    assert r.original_active == active


def test_parser_never_fails_on_junk(spark):
    junk = ["|||", "(as ", "-", "????-????", "abcd-efgh", "12345-678901|x", "  |  ", "present"]
    rows = [(i, "x", None, None, None, None, None, j) for i, j in enumerate(junk)]
    out = periods.parse(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(junk)
    assert all(r.current_status in ("Active", "Split-up", "Unknown") for r in out)
