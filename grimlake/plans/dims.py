"""Dimension models: ``dim_bands`` (M3) and ``dim_albums`` (M4).

``dim_bands`` is row-local over the parsed bands. ``dim_albums`` joins staged
albums to bands (J1) and numbers albums five ways (W1-W3). Ties in album
order are broken by ``album_id`` (ascending; descending for the reverse
number), so every number is deterministic. The reverse number is derived
as ``band album count - number + 1`` (same total order reversed), so the
band ordering is computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.functions import exprs as X
from grimlake.functions import rules as R
from grimlake.operators import ranks
from grimlake.sources.stage import stored_table

AUDIT_COLUMNS = ["created_at", "updated_at", "is_current_record"]

DIM_BANDS_COLUMNS = [
    "band_id", "band_name", "country", "continent", "status", "current_status",
    "formed_year", "start_year", "end_year", "years_active", "total_career_span",
    "genre", "death_metal_subgenre", "theme", "has_name_change", "has_name_change_flag",
    "previous_name", "name_change_year", "periods_count", "formation_era",
    "formation_decade", "band_maturity", "is_active_flag", "is_golden_age_band",
    "is_veteran_band", "is_pure_death_metal", "data_quality", "is_na_case",
    "original_active",
]

DIM_ALBUMS_COLUMNS = [
    "album_id", "band_id", "album_title", "album_year", "title_length",
    "title_length_category", "title_theme_category", "band_name", "country", "continent",
    "genre", "death_metal_subgenre", "band_status", "formed_year", "release_decade",
    "release_era", "formation_era", "formation_decade", "band_maturity",
    "band_career_phase", "years_since_formation", "album_number_in_discography",
    "reverse_album_number", "album_number_in_decade", "album_number_in_era",
    "album_number_in_country_decade", "is_debut_album", "is_first_album",
    "is_latest_album", "is_early_discography", "is_golden_age_release",
    "is_modern_release", "is_early_career_album", "is_legacy_album",
]


AUDIT = ["created_at", "updated_at", "is_current_record"]


def with_audit(df: DataFrame, current_record: bool = True) -> DataFrame:
    """Audit stamps added by the sink step."""
    now = F.current_timestamp()
    cols = {"created_at": now, "updated_at": now}
    if current_record:
        cols["is_current_record"] = F.lit(True)
    return df.withColumns(cols)


def band_classes(parsed: DataFrame, current_year: int = R.CURRENT_YEAR) -> DataFrame:
    """Maturity, era, decade, continent, flags, quality, span, subgenre."""
    fy, ya = F.col("formed_year"), F.col("years_active")
    active = F.col("current_status") == R.STATUS_ACTIVE
    return parsed.withColumns({
        "band_maturity": X.band_maturity(ya),
        "formation_era": X.era(fy),
        "formation_decade": X.decade(fy),
        "continent": X.continent(F.col("country")),
        "is_active_flag": X.flag(active),
        "has_name_change_flag": X.flag(F.col("has_name_change")),
        "is_golden_age_band": X.flag(fy.between(*R.GOLDEN_AGE)),
        "is_veteran_band": X.flag(ya >= R.VETERAN_FLAG_YEARS),
        "is_pure_death_metal": X.flag(F.col("genre").like("%Death Metal%")),
        "data_quality": F.when(F.col("is_na_case"), R.DATA_QUALITY_NA)
                         .otherwise(R.DATA_QUALITY_OK),
        "total_career_span": X.first_match([
            (active, F.lit(current_year) - fy),
            (F.col("end_year").isNotNull(), F.col("end_year") - fy),
        ], F.lit(None).cast("int")),
        "death_metal_subgenre": X.subgenre(F.col("genre")),
    })


def dim_bands(parsed: DataFrame, current_year: int = R.CURRENT_YEAR,
              audit: bool = False) -> DataFrame:
    out = band_classes(parsed, current_year).select(*DIM_BANDS_COLUMNS)
    return with_audit(out) if audit else out


BAND_COLUMNS_FOR_ALBUMS = [
    "band_id", "band_name", "country", "continent", "genre", "death_metal_subgenre",
    "formed_year", "current_status", "formation_era", "formation_decade", "band_maturity",
]


def album_classes(df: DataFrame) -> DataFrame:
    """C9-C16 on an album joined to its band."""
    y, f = F.col("album_year"), F.col("formed_year")
    since = y - f
    return df.withColumns({
        "release_decade": X.decade(y),
        "release_era": X.era(y),
        "band_career_phase": X.career_phase(y, f),
        "years_since_formation": since,
        "is_debut_album": X.flag(y == f),
        "is_golden_age_release": X.flag(y.between(*R.GOLDEN_AGE)),
        "is_modern_release": X.flag(y >= R.MODERN_RELEASE_FROM),
        "is_early_career_album": X.flag(since <= R.EARLY_CAREER_MAX_YEARS),
        "is_legacy_album": X.flag(since > R.LEGACY_MIN_YEARS),
        "title_theme_category": X.title_theme(F.col("album_title")),
        "title_length": F.length("album_title").cast("bigint"),
        "title_length_category": X.title_length_category(F.length("album_title")),
    })


def bands_for_albums(dim_bands_df: DataFrame) -> DataFrame:
    """Band attributes of an album, and ``_band``, which tells rows of one id apart."""
    marks = [x for c in BAND_COLUMNS_FOR_ALBUMS for x in (F.col(c), F.col(c).isNull())]
    return (dim_bands_df.select(*BAND_COLUMNS_FOR_ALBUMS).withColumn("_band", F.xxhash64(*marks))
            .withColumnRenamed("current_status", "band_status"))


def albums_to_number(stg_albums: DataFrame, dim_bands_df: DataFrame) -> DataFrame:
    """Albums of known bands, as many rows as the join with the bands has, with
    what the numbers need of a band. The year filter reaches the scan."""
    albums = stg_albums.where(F.col("album_year").isNotNull())
    bands = bands_for_albums(dim_bands_df).select("band_id", "country", "_band")
    y = F.col("album_year")
    return albums.join(bands, "band_id", "inner").withColumns({"release_decade": X.decade(y), "release_era": X.era(y)})


def with_bands(albums: DataFrame, dim_bands_df: DataFrame) -> DataFrame:
    """J1 + C9-C16: the numbered albums with their band's attributes, which no
    numbering shuffles. Bands repeated in full are so in the albums already."""
    bands = bands_for_albums(dim_bands_df).drop("country").withColumnsRenamed({"band_id": "_id", "_band": "_same"}).distinct()
    same = (F.col("band_id") == F.col("_id")) & (F.col("_band").bitwiseXOR(F.col("_same")) == 0)  # one key: as dealt by band
    return album_classes(albums.join(bands, same))


def album_numbers(enriched: DataFrame) -> DataFrame:
    """W1-W3 added to the album rows (``NUMBERING_OUTPUT``).
    The band number and the band's album count share one partitioning
    (``ranks.partition_columns`` picks their form from measured group sizes).
    The others have a handful of groups and order by the year, which fixes decade
    and era: they are ranked in one exchange by year, not one each."""
    def rank(part, name):
        return ranks.RankSpec.of(part, "album_year", False, "album_id", name)

    works = [
        ranks.Work("band_id", "album_year", rank("band_id", "album_number_in_discography"),
                   {"_band_albums": F.count(F.lit(1))}),
        ranks.Work("release_decade", "album_year",
                   rank("release_decade", "album_number_in_decade"), shared=True),
        ranks.Work("release_era", "album_year", rank("release_era", "album_number_in_era"), shared=True),
        ranks.Work(["country", "release_decade"], "album_year",
                   rank(["country", "release_decade"], "album_number_in_country_decade"), shared=True),
    ]
    out = ranks.partition_columns(enriched, works)
    n = F.col("album_number_in_discography")
    out = out.withColumns({
        "reverse_album_number": (F.col("_band_albums") - n + 1).cast("bigint"),
        "is_first_album": X.flag(n == 1),
        "is_early_discography": X.flag(n <= 3),
    })
    return out.withColumn("is_latest_album", X.flag(F.col("reverse_album_number") == 1)
                          ).drop("_band_albums")


NUMBERING_OUTPUT = ["album_number_in_discography", "reverse_album_number",
                    "album_number_in_decade", "album_number_in_era",
                    "album_number_in_country_decade", "is_first_album",
                    "is_latest_album", "is_early_discography"]


def dim_albums_stored(stg_albums: DataFrame, dim_bands_df: DataFrame) -> DataFrame:
    """Albums with band attributes, classes and discography numbers, written
    once to the scratch folder."""
    return stored_table(dim_albums(stg_albums, dim_bands_df), "dim_albums")


def dim_albums(stg_albums: DataFrame, dim_bands_df: DataFrame, audit: bool = False) -> DataFrame:
    # Stored: the numbers read these rows several times, and would join the bands each time.
    numbered = album_numbers(stored_table(albums_to_number(stg_albums, dim_bands_df), "albums_to_number"))
    out = with_bands(numbered, dim_bands_df).select(*DIM_ALBUMS_COLUMNS)
    return with_audit(out) if audit else out
