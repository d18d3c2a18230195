"""Boundary rows of the rule tables."""

import pytest
from pyspark.sql import functions as F

from grimlake.functions import exprs as X


def values(spark, expr, inputs, dtype="int"):
    df = spark.createDataFrame([(v,) for v in inputs], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_score_category(spark):
    got = values(spark, X.score_category, [39, 40, 49, 50, 59, 60, 69, 70, 79, 80, 89, 90, 94, 95,
                                           100, None])
    assert got == ["Very Poor (0-39)", "Poor (40-49)", "Poor (40-49)", "Below Average (50-59)",
                   "Below Average (50-59)", "Average (60-69)", "Average (60-69)", "Good (70-79)",
                   "Good (70-79)", "Very Good (80-89)", "Very Good (80-89)", "Excellent (90-94)",
                   "Excellent (90-94)", "Masterpiece (95-100)", "Masterpiece (95-100)",
                   "Very Poor (0-39)"]


def test_score_range(spark):
    assert values(spark, X.score_range, [59, 60, 79, 80, None]) == [
        "Low (<60)", "Medium (60-79)", "Medium (60-79)", "High (80+)", "Low (<60)"]


def test_title_length(spark):
    assert values(spark, X.title_length_category, [10, 11, 20, 21, 30, 31, None]) == [
        "Short (≤10 chars)", "Medium (11-20 chars)", "Medium (11-20 chars)",
        "Long (21-30 chars)", "Long (21-30 chars)", "Very Long (30+ chars)",
        "Very Long (30+ chars)"]


def test_band_maturity(spark):
    assert values(spark, X.band_maturity, [0, 1, 4, 5, 14, 15, 29, 30, None]) == [
        "Unknown Duration", "New (1-4 years)", "New (1-4 years)", "Emerging (5-14 years)",
        "Emerging (5-14 years)", "Established (15-29 years)", "Established (15-29 years)",
        "Veteran (30+ years)", "Unknown Duration"]


def test_era_and_decade(spark):
    years = [1959, 1960, 1979, 1980, 1989, 1990, 1999, 2000, 2009, 2010, 2019, 2020, None]
    assert values(spark, X.era, years) == [
        "Unknown Era", "Proto-Metal Era", "Proto-Metal Era", "Classic Metal Era",
        "Classic Metal Era", "Death Metal Golden Age", "Death Metal Golden Age",
        "Nu-Metal/Mainstream Era", "Nu-Metal/Mainstream Era", "Revival Era", "Revival Era",
        "Modern Era", "Unknown Era"]
    assert values(spark, X.decade, years) == [
        "Pre-1980s", "Pre-1980s", "Pre-1980s", "1980s", "1980s", "1990s", "1990s", "2000s",
        "2000s", "2010s", "2010s", "2020s+", "Pre-1980s"]


def test_career_phase(spark):
    df = spark.createDataFrame([(2000, 2000 + d) if d is not None else (2000, None)
                                for d in [-1, 0, 2, 3, 5, 6, 10, 11, 20, 21, None]],
                               "formed int, album int")
    got = [r[0] for r in df.select(X.career_phase(F.col("album"), F.col("formed"))).collect()]
    assert got == ["Early Career (0-2 years)", "Debut Year", "Early Career (0-2 years)",
                   "Establishing Phase (3-5 years)", "Establishing Phase (3-5 years)",
                   "Mature Phase (6-10 years)", "Mature Phase (6-10 years)",
                   "Veteran Phase (11-20 years)", "Veteran Phase (11-20 years)",
                   "Legacy Phase (20+ years)", "Unknown Phase"]


def test_subgenre_first_match(spark):
    genres = ["Brutal Technical Death Metal", "TECH Death Metal", "Melodic Black Metal",
              "Blackened Death Metal", "Death/Doom Metal", "Deathgrind", "Death Metal",
              "Death Metal/Thrash Metal", None]
    assert values(spark, X.subgenre, genres, "string") == [
        "Brutal Death Metal", "Technical Death Metal", "Melodic Death Metal",
        "Blackened Death Metal", "Death/Doom Metal", "Deathgrind", "Traditional Death Metal",
        "Other Death Metal", "Other Death Metal"]


def test_title_theme(spark):
    titles = ["Death March", "In Dark", "Black Harvest", "Blood Sea", "Gore", "Evil Bargain",
              "Hellgate", "Demonology", "Toward the Light", "Battlements", "Ritual of Ash",
              "Cult", "Silent Shore", None]
    assert values(spark, X.title_theme, titles, "string") == [
        "Death-themed", "Dark-themed", "Dark-themed", "Gore-themed", "Gore-themed",
        "Evil-themed", "Evil-themed", "Evil-themed", "War-themed", "War-themed",
        "Occult-themed", "Occult-themed", "Other-themed", "Other-themed"]


def test_continent(spark):
    got = values(spark, X.continent, ["Brazil", "Czechia", "Nepal", "Fiji", "Kenya", None,
                                      "Canada", "Sweden"], "string")
    assert got == ["South America", "Other/Unknown", "Asia", "Oceania", "Africa",
                   "Other/Unknown", "North America", "Europe"]


@pytest.mark.parametrize("n,label", [(None, "No Content"), (0, "No Content"), (99, "Brief Review"),
                                     (100, "Brief Review"), (101, "Short Review"),
                                     (500, "Short Review"), (501, "Medium Review"),
                                     (1000, "Medium Review"), (1001, "Long Review"),
                                     (2000, "Long Review"), (2001, "Very Long Review")])
def test_content_length(spark, n, label):
    from grimlake.functions import rules as R
    text = None if n is None else "x" * n
    got = values(spark, lambda c: X.text_length_category(c, R.REVIEW_CONTENT,
                                                         R.REVIEW_CONTENT_EMPTY,
                                                         R.REVIEW_CONTENT_ELSE), [text], "string")
    assert got == [label]


def test_career_position_and_timing(spark):
    assert values(spark, X.career_position, [1, 2, 3, 4, 5, 6]) == [
        "Debut", "Sophomore", "Third", "Early Career", "Early Career", "Mature Career"]
    assert values(spark, X.career_timing, [-3, 2, 3, 5, 6, 10, 11, None]) == [
        "Immediate", "Immediate", "Early", "Early", "Mid", "Mid", "Late", "Late"]
