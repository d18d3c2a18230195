"""Activity-period parsing.

Input text such as ``1988-1994 (as Foo)|1995-present`` is split on the bar
sign into at most three trimmed periods; years, status, duration and name
change are derived with LIKE patterns and ``try_cast`` (bad year text gives
null instead of failing the job). Row-local: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.functions import exprs as X
from grimlake.functions import rules as R

OUTPUT_COLUMNS = [
    "band_id", "band_name", "country", "status", "formed_year", "genre", "theme",
    "original_active", "current_status", "start_year", "end_year", "years_active",
    "has_name_change", "previous_name", "name_change_year", "periods_count", "is_na_case",
]


def split_periods(df: DataFrame, src: str = "active_periods") -> DataFrame:
    """A1-A5: clean marker, three periods, count (capped at 3), name-change
    flag and the last period."""
    a = F.col(src)
    unknown = a.isNull() | (a == R.UNKNOWN_MARKER)
    period = lambda n: F.when(unknown, F.lit(None)).otherwise(F.trim(X.split_part(a, "|", n)))
    df = df.withColumns({
        "clean_active": F.when(unknown, F.lit(R.UNKNOWN_MARKER)).otherwise(a),
        "period_1": period(1),
        "period_2": period(2),
        "period_3": period(3),
        "periods_count": X.first_match(
            [(unknown, 0), (a.like("%|%|%"), 3), (a.like("%|%"), 2)], 1),
        "has_name_change": X.first_match(
            [(unknown, False), (a.like("%(as %"), True)], False),
    })
    na = F.col("clean_active") == R.UNKNOWN_MARKER
    return df.withColumn("last_period", X.first_match(
        [(na, F.lit(None).cast("string")),
         (F.col("periods_count") == 3, F.col("period_3")),
         (F.col("periods_count") == 2, F.col("period_2"))],
        F.col("period_1")))


def period_years(df: DataFrame, current_year: int = R.CURRENT_YEAR) -> DataFrame:
    """Start year, end year, years active."""
    p1, p2, last = F.col("period_1"), F.col("period_2"), F.col("last_period")
    na = F.col("clean_active") == R.UNKNOWN_MARKER
    null_int = F.lit(None).cast("int")
    start = X.first_match([
        (na, null_int),
        (p1.isNull(), null_int),
        (p1.like("____-%") | p1.like("____-present"), X.try_int(F.left(p1, F.lit(4)))),
        (p1.like("?-%") & p2.isNotNull() & p2.like("____-%"), X.try_int(F.left(p2, F.lit(4)))),
        (p1.like("?-%") & (F.length(p1) == 6), X.try_int(F.right(p1, F.lit(4)))),
    ], null_int)
    end = X.first_match([
        (na, null_int),
        ((F.col("periods_count") >= 1) & last.isNotNull(), X.first_match([
            (last.like("%present%"), null_int),
            (last.like("%?%"), null_int),
            (last.like("____-____"), X.try_int(F.right(last, F.lit(4)))),
            # Unreachable: '?' was caught above; kept for rule parity.
            (last.like("?-____"), X.try_int(F.right(last, F.lit(4)))),
        ], null_int)),
    ], null_int)
    df = df.withColumns({"start_year": start, "end_year": end})
    s, e = F.col("start_year"), F.col("end_year")
    return df.withColumn("years_active", X.first_match([
        (s.isNull() | na, null_int),
        (last.like("%present%") & s.isNotNull(), F.lit(current_year) - s),
        (e.isNotNull() & s.isNotNull(), e - s),
    ], null_int))


def period_status(df: DataFrame) -> DataFrame:
    """Current status and the literal-unknown flag."""
    last = F.col("last_period")
    na = F.col("clean_active") == R.UNKNOWN_MARKER
    return df.withColumns({
        "current_status": X.first_match([
            (na, R.STATUS_UNKNOWN),
            (last.like("%present%"), R.STATUS_ACTIVE),
            (last.like("%?%"), R.STATUS_UNKNOWN),
            (last.like("____-____"), R.STATUS_SPLIT),
        ], R.STATUS_UNKNOWN),
        # A null text is unknown too, but only the literal marker sets this.
        "is_na_case": X.flag(F.col("active_periods") == R.UNKNOWN_MARKER).cast("boolean"),
    })


def name_change(df: DataFrame) -> DataFrame:
    """Previous name between '(as ' and ')', and the change year."""
    a, p2 = F.col("active_periods"), F.col("period_2")
    changed = F.col("has_name_change")
    na = F.col("clean_active") == R.UNKNOWN_MARKER
    null_str, null_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    return df.withColumns({
        "previous_name": X.first_match([
            (~changed, null_str),
            (na, null_str),
            (a.like("%(as %"), X.split_part(X.split_part(a, "(as ", 2), ")", 1)),
        ], null_str),
        "name_change_year": X.first_match([
            (~changed, null_int),
            (na, null_int),
            (p2.isNotNull() & p2.like("____-%"), X.try_int(F.left(p2, F.lit(4)))),
        ], null_int),
    })


def parse(stg_bands: DataFrame, current_year: int = R.CURRENT_YEAR) -> DataFrame:
    """int_metal_bands_parsed: 17 columns, one row per staged band."""
    df = split_periods(stg_bands)
    df = period_years(df, current_year)
    df = period_status(df)
    df = name_change(df)
    return df.select(*[c if c != "original_active" else F.col("active_periods").alias(c)
                       for c in OUTPUT_COLUMNS])


def export_order(parsed: DataFrame) -> DataFrame:
    """The model's final order by band name (only for export; stored
    tables carry no order). Range-partitioned sort, no single partition."""
    return parsed.orderBy(F.col("band_name").asc_nulls_last(), F.col("band_id").asc_nulls_last())
