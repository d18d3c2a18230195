"""Column helpers: the catalogue's reusable macros as Column -> Column functions.

All helpers build JVM-side expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from grimlake.functions import rules as R

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- casts ----------------------------------------------------------------

def try_int(c: ColumnLike) -> Column:
    """Integer cast that yields null on bad text instead of failing (ANSI)."""
    return col(c).try_cast("int")


def try_long(c: ColumnLike) -> Column:
    return col(c).try_cast("bigint")


def try_decimal(c: ColumnLike, precision: int = 18, scale: int = 3) -> Column:
    return col(c).try_cast(f"decimal({precision},{scale})")


# ---- text -----------------------------------------------------------------

def split_part(c: ColumnLike, delimiter: str, part: int) -> Column:
    """Literal-delimiter split; a missing part is the empty string."""
    return F.split_part(col(c), F.lit(delimiter), F.lit(part))


def is_blank(c: ColumnLike) -> Column:
    """Null or only spaces (trim removes spaces only)."""
    c = col(c)
    return c.isNull() | (F.trim(c) == "")


def contains_any(c: Column, words: Iterable[str], case_blind: bool = True) -> Column:
    cond = None
    for w in words:
        term = c.ilike(f"%{w}%") if case_blind else c.like(f"%{w}%")
        cond = term if cond is None else (cond | term)
    return cond


# ---- arithmetic -----------------------------------------------------------

def safe_divide(num: ColumnLike, den: ColumnLike) -> Column:
    """Division that is null for a zero or null denominator."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (a null condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# ---- ordered rule evaluation ---------------------------------------------

def first_match(pairs: Sequence[tuple[Column, object]], default: object) -> Column:
    """Searched CASE: first true condition wins; null conditions fall through."""
    expr = None
    for cond, label in pairs:
        value = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    default_col = default if isinstance(default, Column) else F.lit(default)
    return default_col if expr is None else expr.otherwise(default_col)


def at_least(c: ColumnLike, table, default) -> Column:
    c = col(c)
    return first_match([(c >= t, label) for t, label in table], default)


def at_most(c: ColumnLike, table, default) -> Column:
    c = col(c)
    return first_match([(c <= t, label) for t, label in table], default)


def year_range(c: ColumnLike, table, default) -> Column:
    c = col(c)
    pairs = []
    for lo, hi, label in table:
        pairs.append((c >= lo if hi is None else c.between(lo, hi), label))
    return first_match(pairs, default)


def keyword_label(c: ColumnLike, table, default, lower_like: bool = False) -> Column:
    """Keyword rules: ``ilike '%w%'`` (or ``lower(c) like '%w%'``)."""
    c = col(c)
    if lower_like:
        low = F.lower(c)
        pairs = [(contains_any(low, words, case_blind=False), label) for words, label in table]
    else:
        pairs = [(contains_any(c, words), label) for words, label in table]
    return first_match(pairs, default)


# ---- classifiers shared by several models ---------------------------------

def era(year: ColumnLike) -> Column:
    return year_range(year, R.ERAS, R.ERA_ELSE)


def decade(year: ColumnLike) -> Column:
    return year_range(year, R.DECADES, R.DECADE_ELSE)


def continent(country: ColumnLike) -> Column:
    c = col(country)
    return first_match([(c.isin(*names), name) for name, names in R.CONTINENTS],
                       R.CONTINENT_ELSE)


def band_maturity(years_active: ColumnLike) -> Column:
    return at_least(years_active, R.BAND_MATURITY, R.BAND_MATURITY_ELSE)


def subgenre(genre: ColumnLike) -> Column:
    g = col(genre)
    pairs = [(contains_any(g, words), label) for words, label in R.SUBGENRE_KEYWORDS]
    pairs.append((g == R.SUBGENRE_EXACT[0], R.SUBGENRE_EXACT[1]))
    return first_match(pairs, R.SUBGENRE_ELSE)


def title_theme(title: ColumnLike) -> Column:
    return keyword_label(title, R.TITLE_THEMES, R.TITLE_THEME_ELSE, lower_like=True)


def title_length_category(length: ColumnLike) -> Column:
    return at_most(length, R.TITLE_LENGTH, R.TITLE_LENGTH_ELSE)


def career_phase(album_year: ColumnLike, formed_year: ColumnLike) -> Column:
    y, f = col(album_year), col(formed_year)
    d = y - f
    pairs = [(y == f, R.CAREER_PHASE_DEBUT)]
    pairs += [(d <= t, label) for t, label in R.CAREER_PHASE_MAX]
    pairs.append((d > R.CAREER_PHASE_LEGACY[0], R.CAREER_PHASE_LEGACY[1]))
    return first_match(pairs, R.CAREER_PHASE_ELSE)


def score_category(score: ColumnLike) -> Column:
    return at_least(score, R.SCORE_CATEGORY, R.SCORE_CATEGORY_ELSE)


def score_range(score: ColumnLike) -> Column:
    return at_least(score, R.SCORE_RANGE, R.SCORE_RANGE_ELSE)


def text_length_category(text: ColumnLike, table, empty_label, else_label) -> Column:
    t = col(text)
    return length_category(F.length(t), is_blank(t), table, empty_label, else_label)


def length_category(n: Column, blank: Column, table, empty_label, else_label) -> Column:
    """``text_length_category`` of a text of which only this is known."""
    return first_match([(blank, empty_label)] + [(n <= lim, label) for lim, label in table], else_label)


def career_position(album_number: ColumnLike) -> Column:
    n = col(album_number)
    pairs = [(n == k, label) for k, label in R.CAREER_POSITION_EXACT]
    pairs += [(n <= k, label) for k, label in R.CAREER_POSITION_MAX]
    return first_match(pairs, R.CAREER_POSITION_ELSE)


def career_timing(years_since_formation: ColumnLike) -> Column:
    return at_most(years_since_formation, R.CAREER_TIMING, R.CAREER_TIMING_ELSE)


# ---- aggregate macros -------------------------------------------------------

def median(c: ColumnLike) -> Column:
    """Exact continuous median (``percentile_cont(0.5)``)."""
    return F.percentile(col(c).cast("double"), F.lit(0.5))


def percentile_cont(c: ColumnLike, p: float) -> Column:
    return F.percentile(col(c).cast("double"), F.lit(p))


def mode(c: ColumnLike) -> Column:
    """Most frequent value; ties go to the smallest value."""
    return F.mode(col(c), deterministic=True)


def dominant(c: ColumnLike, count_nulls: bool = False) -> Column:
    """Most frequent value of a group, ties to the smallest value.

    With ``count_nulls`` a null is a value of its own that sorts last on
    ties (``ORDER BY count DESC, value NULLS LAST``); otherwise nulls are
    ignored. A partial aggregate: its buffer maps each distinct value to
    its count, so it follows the distinct values, not the group size."""
    c = col(c)
    if not count_nulls:
        return F.mode(c, deterministic=True)
    return F.mode(F.struct(c.isNull().alias("n"), c.alias("v")), deterministic=True)["v"]


def stddev(c: ColumnLike) -> Column:
    """Sample standard deviation (null for a single row)."""
    return F.stddev_samp(col(c).cast("double"))
