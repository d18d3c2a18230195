"""Ordered rule tables of the catalogue classifiers.

Every table is evaluated top down, first match wins, and a null input
matches no rule (it falls through to the default label).

FIXED VALUES: the labels, thresholds, year bounds, keywords and country
lists below must equal the catalogue's published definitions for results to
match; they are stated here in their natural order.
"""

from __future__ import annotations

CURRENT_YEAR = 2024

# ---- FIXED VALUES: band maturity (years active, >=) -----------------------
BAND_MATURITY = [
    (30, "Veteran (30+ years)"),
    (15, "Established (15-29 years)"),
    (5, "Emerging (5-14 years)"),
    (1, "New (1-4 years)"),
]
BAND_MATURITY_ELSE = "Unknown Duration"

# ---- FIXED VALUES: eras (inclusive year ranges; None = open upper end) ----
ERAS = [
    (1960, 1979, "Proto-Metal Era"),
    (1980, 1989, "Classic Metal Era"),
    (1990, 1999, "Death Metal Golden Age"),
    (2000, 2009, "Nu-Metal/Mainstream Era"),
    (2010, 2019, "Revival Era"),
    (2020, None, "Modern Era"),
]
ERA_ELSE = "Unknown Era"

# ---- FIXED VALUES: decades ------------------------------------------------
DECADES = [
    (1980, 1989, "1980s"),
    (1990, 1999, "1990s"),
    (2000, 2009, "2000s"),
    (2010, 2019, "2010s"),
    (2020, None, "2020s+"),
]
DECADE_ELSE = "Pre-1980s"

# ---- FIXED VALUES: continents and their country lists ---------------------
CONTINENTS = [
    ("North America", ["United States", "Canada", "Mexico"]),
    ("South America", ["Brazil", "Argentina", "Chile", "Colombia", "Peru", "Ecuador",
                       "Venezuela", "Uruguay", "Paraguay", "Bolivia"]),
    ("Europe", ["Germany", "United Kingdom", "France", "Italy", "Spain", "Netherlands",
                "Belgium", "Switzerland", "Austria", "Sweden", "Norway", "Finland",
                "Denmark", "Poland", "Czech Republic", "Hungary", "Romania", "Bulgaria",
                "Croatia", "Serbia", "Greece", "Portugal", "Ireland", "Slovakia",
                "Slovenia", "Estonia", "Latvia", "Lithuania", "Malta", "Cyprus",
                "Luxembourg", "Monaco", "Liechtenstein", "Andorra", "San Marino",
                "Vatican City", "Russia", "Ukraine", "Belarus", "Moldova"]),
    ("Asia", ["Japan", "South Korea", "China", "India", "Thailand", "Malaysia",
              "Singapore", "Indonesia", "Philippines", "Vietnam", "Taiwan", "Hong Kong",
              "Mongolia", "Kazakhstan", "Kyrgyzstan", "Tajikistan", "Turkmenistan",
              "Uzbekistan", "Afghanistan", "Pakistan", "Bangladesh", "Sri Lanka", "Nepal",
              "Bhutan", "Myanmar", "Cambodia", "Laos", "Brunei", "Maldives"]),
    ("Oceania", ["Australia", "New Zealand", "Papua New Guinea", "Fiji", "Solomon Islands",
                 "Vanuatu", "Samoa", "Tonga", "Kiribati", "Tuvalu", "Nauru", "Palau",
                 "Marshall Islands", "Micronesia"]),
    ("Africa", ["Egypt", "South Africa", "Nigeria", "Kenya", "Morocco", "Algeria",
                "Tunisia", "Libya", "Ghana", "Ethiopia", "Tanzania", "Uganda", "Madagascar",
                "Cameroon", "Angola", "Mozambique", "Zambia", "Zimbabwe", "Botswana",
                "Namibia", "Mauritius", "Seychelles"]),
]
CONTINENT_ELSE = "Other/Unknown"
CONTINENT_VALUES = [name for name, _ in CONTINENTS] + [CONTINENT_ELSE]

# ---- FIXED VALUES: subgenre keywords (case-blind "contains") --------------
SUBGENRE_KEYWORDS = [
    (["brutal"], "Brutal Death Metal"),
    (["technical", "tech"], "Technical Death Metal"),
    (["melodic"], "Melodic Death Metal"),
    (["progressive"], "Progressive Death Metal"),
    (["blackened", "black"], "Blackened Death Metal"),
    (["doom"], "Death/Doom Metal"),
    (["grind"], "Deathgrind"),
]
SUBGENRE_EXACT = ("Death Metal", "Traditional Death Metal")
SUBGENRE_ELSE = "Other Death Metal"

# ---- FIXED VALUES: album title themes (lower-cased "contains") ------------
TITLE_THEMES = [
    (["death"], "Death-themed"),
    (["dark", "black"], "Dark-themed"),
    (["blood", "gore"], "Gore-themed"),
    (["evil", "hell", "demon"], "Evil-themed"),
    (["war", "battle"], "War-themed"),
    (["ritual", "cult"], "Occult-themed"),
]
TITLE_THEME_ELSE = "Other-themed"

# ---- FIXED VALUES: album title length (characters, <=) --------------------
TITLE_LENGTH = [
    (10, "Short (≤10 chars)"),
    (20, "Medium (11-20 chars)"),
    (30, "Long (21-30 chars)"),
]
TITLE_LENGTH_ELSE = "Very Long (30+ chars)"

# ---- FIXED VALUES: career phase (album year minus formed year) ------------
CAREER_PHASE_DEBUT = "Debut Year"
CAREER_PHASE_MAX = [
    (2, "Early Career (0-2 years)"),
    (5, "Establishing Phase (3-5 years)"),
    (10, "Mature Phase (6-10 years)"),
    (20, "Veteran Phase (11-20 years)"),
]
CAREER_PHASE_LEGACY = (20, "Legacy Phase (20+ years)")
CAREER_PHASE_ELSE = "Unknown Phase"

# ---- FIXED VALUES: review score categories (>=) ---------------------------
SCORE_CATEGORY = [
    (95, "Masterpiece (95-100)"),
    (90, "Excellent (90-94)"),
    (80, "Very Good (80-89)"),
    (70, "Good (70-79)"),
    (60, "Average (60-69)"),
    (50, "Below Average (50-59)"),
    (40, "Poor (40-49)"),
]
SCORE_CATEGORY_ELSE = "Very Poor (0-39)"
SCORE_CATEGORY_VALUES = [label for _, label in SCORE_CATEGORY] + [SCORE_CATEGORY_ELSE]

SCORE_RANGE = [(80, "High (80+)"), (60, "Medium (60-79)")]
SCORE_RANGE_ELSE = "Low (<60)"
SCORE_RANGE_VALUES = [label for _, label in SCORE_RANGE] + [SCORE_RANGE_ELSE]

# ---- FIXED VALUES: score thresholds of flags ------------------------------
EXCELLENT_SCORE = 90
HIGH_SCORE = 80
GOOD_SCORE = 70
POOR_SCORE_BELOW = 50
SCORE_THRESHOLD = 75
SCORE_CENTER = 70

# ---- FIXED VALUES: review title / content length (<=) ---------------------
REVIEW_TITLE_EMPTY = "No Title"
REVIEW_TITLE = [(20, "Short Title"), (50, "Medium Title")]
REVIEW_TITLE_ELSE = "Long Title"

REVIEW_CONTENT_EMPTY = "No Content"
REVIEW_CONTENT = [
    (100, "Brief Review"),
    (500, "Short Review"),
    (1000, "Medium Review"),
    (2000, "Long Review"),
]
REVIEW_CONTENT_ELSE = "Very Long Review"
SUBSTANTIAL_REVIEW_CHARS = 100

# ---- FIXED VALUES: career position (album number) and timing --------------
CAREER_POSITION_EXACT = [(1, "Debut"), (2, "Sophomore"), (3, "Third")]
CAREER_POSITION_MAX = [(5, "Early Career")]
CAREER_POSITION_ELSE = "Mature Career"

CAREER_TIMING = [(2, "Immediate"), (5, "Early"), (10, "Mid")]
CAREER_TIMING_ELSE = "Late"

# ---- FIXED VALUES: band status labels and flags ---------------------------
STATUS_ACTIVE = "Active"
STATUS_SPLIT = "Split-up"
STATUS_UNKNOWN = "Unknown"
STATUS_VALUES = [STATUS_ACTIVE, STATUS_SPLIT, STATUS_UNKNOWN]
UNKNOWN_MARKER = "N/A"
GOLDEN_AGE = (1990, 1999)
VETERAN_FLAG_YEARS = 20
MODERN_RELEASE_FROM = 2020
EARLY_CAREER_MAX_YEARS = 2
LEGACY_MIN_YEARS = 20
DATA_QUALITY_NA = "Insufficient Data"
DATA_QUALITY_OK = "Has Data"

# ---- FIXED VALUES: band-metric thresholds ---------------------------------
SUBSTANTIAL_CATALOG_REVIEWS = 5
CONSISTENT_STDDEV_MAX = 10

# ---- FIXED VALUES: yearly analysis window ---------------------------------
TEMPORAL_FROM, TEMPORAL_TO = 1980, 2024
