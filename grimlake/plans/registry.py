"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the adapter, so its work grows
with them. Results are normalised for comparison only: decimals become
doubles and doubles are rounded to 6 places (the oracle does the same).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.operators import quality
from grimlake.plans import aggregates, analyst, marts, periods, staging
from grimlake.plans.catalog import Catalog
from grimlake.sources import raw as raw_io
from grimlake.sources import versions
from grimlake.sources.schemas import RAW_SCHEMAS
from grimlake.sources.stage import scratch_dir, stored_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

_CATALOGS: dict[tuple, Catalog] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and time of the tables' files, as Hadoop lists them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for table in ("customer", "orders", "lineitem"):
        p = path(f"{sf_dir.rstrip('/')}/{table}.parquet")
        fs = p.getFileSystem(conf)
        out.append((int(fs.getContentSummary(p).getLength()), int(fs.getFileStatus(p).getModificationTime())))
    return tuple(out)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """One model build per application and state of the input files, reused by
    later queries; files that change are built anew."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir))
    if key not in _CATALOGS:
        for old in [k for k in _CATALOGS if k[:2] == key[:2]]:
            del _CATALOGS[old]
        _CATALOGS[key] = Catalog.from_driver_tables(spark, sf_dir)
    return _CATALOGS[key]


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalise(fn(catalog(spark, sf_dir)))
        run.__name__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# ---- staging (M1, P1-P3) ----------------------------------------------------
@register("stg_bands")
def _stg_bands(c: Catalog) -> DataFrame:
    return c.stg_bands


@register("stg_albums")
def _stg_albums(c: Catalog) -> DataFrame:
    return c.stg_albums


@register("stg_reviews")
def _stg_reviews(c: Catalog) -> DataFrame:
    return c.stg_reviews


# ---- period parsing (M2, A1-A12) ---------------------------------------------
@register("period_split")
def _period_split(c: Catalog) -> DataFrame:
    return periods.split_periods(c.stg_bands).select(
        "band_id", "clean_active", "period_1", "period_2", "period_3", "periods_count",
        "has_name_change", "last_period")


@register("period_years")
def _period_years(c: Catalog) -> DataFrame:
    return c.parsed.select("band_id", "start_year", "end_year", "years_active")


@register("period_status")
def _period_status(c: Catalog) -> DataFrame:
    return c.parsed.select("band_id", "current_status", "is_na_case")


@register("name_change")
def _name_change(c: Catalog) -> DataFrame:
    return c.parsed.select("band_id", "has_name_change", "previous_name", "name_change_year")


@register("int_bands_parsed")
def _parsed(c: Catalog) -> DataFrame:
    return c.parsed


@register("parsed_by_name")
def _parsed_by_name(c: Catalog) -> DataFrame:
    """The parsed bands in export order (range-partitioned sort by
    band name, band id as tie-break; no single partition)."""
    return periods.export_order(c.parsed)


# ---- dims and fact (M3-M5) ---------------------------------------------------
@register("dim_bands")
def _dim_bands(c: Catalog) -> DataFrame:
    return c.dim_bands


@register("dim_albums")
def _dim_albums(c: Catalog) -> DataFrame:
    return c.dim_albums


@register("fct_reviews")
def _fct_reviews(c: Catalog) -> DataFrame:
    return c.fct_reviews


# ---- marts (M6-M10) ----------------------------------------------------------
@register("band_metrics")
def _band_metrics(c: Catalog) -> DataFrame:
    return c.band_metrics


@register("geographic_analysis")
def _geographic(c: Catalog) -> DataFrame:
    return c.geographic_analysis


@register("career_analysis")
def _career(c: Catalog) -> DataFrame:
    return c.career_analysis


@register("temporal_analysis")
def _temporal(c: Catalog) -> DataFrame:
    return c.temporal_analysis


@register("subgenre_analysis")
def _subgenre(c: Catalog) -> DataFrame:
    return c.subgenre_analysis


# ---- classifiers (C1-C24) -------------------------------------------------------
@register("band_maturity_era")
def _band_maturity_era(c: Catalog) -> DataFrame:
    """Maturity from years active, era and decade of formation."""
    return c.dim_bands.select("band_id", "years_active", "formed_year", "band_maturity",
                              "formation_era", "formation_decade")


@register("continent_map")
def _continent_map(c: Catalog) -> DataFrame:
    """C4: country -> continent, null and unlisted -> Other/Unknown."""
    return c.dim_bands.select("band_id", "country", "continent")


@register("subgenre_rules")
def _subgenre_rules(c: Catalog) -> DataFrame:
    """Ordered case-blind keyword rules on the genre text."""
    return c.dim_bands.select("band_id", "genre", "death_metal_subgenre")


@register("band_flags")
def _band_flags(c: Catalog) -> DataFrame:
    """0/1 flags, data-quality label, career span."""
    return c.dim_bands.select("band_id", "is_active_flag", "has_name_change_flag",
                              "is_golden_age_band", "is_veteran_band", "is_pure_death_metal",
                              "data_quality", "total_career_span")


@register("album_phase")
def _album_phase(c: Catalog) -> DataFrame:
    """Release decade/era, career phase, years since formation, flags."""
    return c.dim_albums.select("album_id", "album_year", "formed_year", "release_decade",
                               "release_era", "band_career_phase", "years_since_formation",
                               "is_debut_album", "is_golden_age_release", "is_modern_release",
                               "is_early_career_album", "is_legacy_album")


@register("album_theme")
def _album_theme(c: Catalog) -> DataFrame:
    """C14: keyword theme of the album title."""
    return c.dim_albums.select("album_id", "album_title", "title_theme_category")


@register("title_length_bucket")
def _title_length_bucket(c: Catalog) -> DataFrame:
    """Title length in characters and its bucket."""
    return c.dim_albums.select("album_id", "title_length", "title_length_category")


@register("score_bands")
def _score_bands(c: Catalog) -> DataFrame:
    """Score category, range and threshold flags per review."""
    return c.fct_base.select("review_id", "album_id", "score_album", "score_category",
                             "score_range", "is_excellent_score", "is_high_score",
                             "is_good_score", "is_poor_score")


@register("text_length_bands")
def _text_length_bands(c: Catalog) -> DataFrame:
    """Review title/content lengths, buckets and presence flags."""
    return c.fct_base.select("review_id", "album_id", "review_title_length",
                             "review_title_category", "review_content_length",
                             "review_content_category", "has_review_title",
                             "has_review_content", "is_substantial_review")


@register("score_deviation")
def _score_deviation(c: Catalog) -> DataFrame:
    """Excess over 75 (floor 0) and distance from 70."""
    return c.fct_base.select("review_id", "album_id", "score_above_threshold",
                             "score_deviation_from_average")


# ---- window operators (W1-W16) ---------------------------------------------------
@register("album_numbering")
def _album_numbering(c: Catalog) -> DataFrame:
    """Album numbers per band (both ways), decade, era, country+decade."""
    return c.dim_albums.select("album_id", "band_id", "album_year",
                               "album_number_in_discography", "reverse_album_number",
                               "album_number_in_decade", "album_number_in_era",
                               "album_number_in_country_decade", "is_first_album",
                               "is_latest_album", "is_early_discography")


def _fw(c: Catalog, *cols: str) -> DataFrame:
    return c.fct_windows.select("review_id", "album_id", *cols)


@register("score_ranks")
def _score_ranks(c: Catalog) -> DataFrame:
    """Score rank per band, country, decade, subgenre."""
    return _fw(c, "band_score_rank", "country_score_rank", "decade_score_rank",
               "subgenre_score_rank")


@register("global_rank")
def _global_rank(c: Catalog) -> DataFrame:
    """Exact global score rank without a single-partition exchange."""
    return _fw(c, F.col("score_d").alias("score_album"), "overall_score_rank")


@register("percent_ranks")
def _percent_ranks(c: Catalog) -> DataFrame:
    """Global, per-decade and per-subgenre percent rank of the score."""
    return _fw(c, "score_percentile", "decade_score_percentile", "subgenre_score_percentile")


@register("score_vs_avg")
def _score_vs_avg(c: Catalog) -> DataFrame:
    """Score minus the global, band, country and decade average."""
    return _fw(c, "score_vs_overall_avg", "score_vs_band_avg", "score_vs_country_avg",
               "score_vs_decade_avg")


@register("above_avg_flags")
def _above_avg_flags(c: Catalog) -> DataFrame:
    """Above the global, band and subgenre average."""
    return _fw(c, "is_above_overall_avg", "is_above_band_avg", "is_above_subgenre_avg")


@register("partition_counts")
def _partition_counts(c: Catalog) -> DataFrame:
    """Reviews per band and per album on every review row."""
    return _fw(c, "band_total_reviews", "album_total_reviews")


@register("lag_change")
def _lag_change(c: Catalog) -> DataFrame:
    """Previous score by band, change, band average."""
    return c.career_analysis.select("band_id", "album_year", "album_title", "score_album",
                                    "previous_album_score", "score_change", "band_avg_score",
                                    "score_vs_band_avg", "album_career_position",
                                    "career_timing")


@register("sophomore_slump")
def _sophomore_slump(c: Catalog) -> DataFrame:
    """Second album scored below the row before it."""
    return c.career_analysis.select("band_id", "album_number_in_discography", "score_album",
                                    "previous_album_score", "has_sophomore_slump")


@register("band_best")
def _band_best(c: Catalog) -> DataFrame:
    """Review score equal to the band's best."""
    return c.career_analysis.select("band_id", "album_title", "score_album",
                                    "is_band_best_album")


# ---- aggregates (G6-G24) ---------------------------------------------------------
def _tbase(c: Catalog) -> DataFrame:
    return marts.temporal_base(c.dim_bands, c.dim_albums, c.fct_base)


@register("median_by_year")
def _median_by_year(c: Catalog) -> DataFrame:
    return aggregates.median_by_year(_tbase(c))


@register("dominant_subgenre_by_year")
def _dominant_subgenre_by_year(c: Catalog) -> DataFrame:
    return aggregates.dominant_subgenre_by_year(_tbase(c))


@register("dominant_era_by_country")
def _dominant_era_by_country(c: Catalog) -> DataFrame:
    return aggregates.dominant_era_by_country(marts.geographic_base(c.dim_bands, c.dim_albums))


@register("conditional_distinct")
def _conditional_distinct(c: Catalog) -> DataFrame:
    return aggregates.conditional_distinct(_tbase(c))


@register("safe_percent")
def _safe_percent(c: Catalog) -> DataFrame:
    return aggregates.safe_percent(c.band_metrics)


@register("mode_value")
def _mode_value(c: Catalog) -> DataFrame:
    return aggregates.mode_value(c.dim_albums)


@register("stddev_by_band")
def _stddev_by_band(c: Catalog) -> DataFrame:
    return aggregates.stddev_by_band(c.fct_base)


@register("safe_ratio")
def _safe_ratio(c: Catalog) -> DataFrame:
    return aggregates.safe_ratio(c.band_metrics)


@register("percentile_any")
def _percentile_any(c: Catalog) -> DataFrame:
    return aggregates.percentile_any(c.fct_base)


@register("approx_top_value")
def _approx_top_value(c: Catalog) -> DataFrame:
    return aggregates.approx_top_value(c.fct_base)


@register("approx_top_merged")
def _approx_top_merged(c: Catalog) -> DataFrame:
    """Sketches stored per load, here two, and combined."""
    loads = c.fct_base.withColumn("_load", F.pmod("_rk", F.lit(2)))
    states = [stored_table(aggregates.top_value_state(loads.where(F.col("_load") == i)), "top_state") for i in (0, 1)]
    return aggregates.top_value_of_states(states[0].unionByName(states[1]))


# ---- analyst queries (M11) --------------------------------------------------------
@register("top_bands")
def _top_bands(c: Catalog) -> DataFrame:
    return analyst.top_bands(c.band_metrics)


@register("country_list")
def _country_list(c: Catalog) -> DataFrame:
    return analyst.country_list(c.geographic_analysis)


@register("career_pattern")
def _career_pattern(c: Catalog) -> DataFrame:
    return analyst.career_pattern(c.career_analysis)


@register("yearly_trend")
def _yearly_trend(c: Catalog) -> DataFrame:
    return analyst.yearly_trend(c.temporal_analysis)


@register("score_evolution")
def _score_evolution(c: Catalog) -> DataFrame:
    return analyst.score_evolution(c.fct_base, c.dim_bands)


# ---- data-quality checks (Q1-Q4, J11) ---------------------------------------------
def _checks(c: Catalog, kind: str) -> DataFrame:
    return quality.summary(c.models(), kinds=[kind])


@register("check_not_null")
def _check_not_null(c: Catalog) -> DataFrame:
    return _checks(c, "not_null")


@register("check_unique")
def _check_unique(c: Catalog) -> DataFrame:
    return _checks(c, "unique")


@register("check_accepted_values")
def _check_accepted_values(c: Catalog) -> DataFrame:
    return _checks(c, "accepted_values")


@register("check_relationships")
def _check_relationships(c: Catalog) -> DataFrame:
    return _checks(c, "relationships")


@register("failing_rows")
def _failing_rows(c: Catalog) -> DataFrame:
    """Every check's rejected values and their rows."""
    return quality.failing_values(c.models())


@register("check_severity")
def _check_severity(c: Catalog) -> DataFrame:
    """Failing rows written by check, counted from there, with the
    severity of the development target."""
    base = f"{scratch_dir(c.spark)}/failures_{uuid.uuid4().hex}"
    checks = quality.declared_checks(quality.severity_for("dev"))
    quality.store_failures(c.models(), base, checks)
    return quality.stored_summary(c.spark, base, checks)


# ---- sources and sinks (S1-S10, S13) ------------------------------------------------
@register("csv_roundtrip")
def _csv_roundtrip(c: Catalog) -> DataFrame:
    """Write the raw reviews as CSV into the shared scratch folder,
    scan them back with the declared schema, and stage them."""
    import uuid

    from grimlake.session import checkpoint_dir
    from grimlake.sources import raw as raw_io
    from grimlake.sources.schemas import RAW_REVIEWS

    base = f"{checkpoint_dir(c.spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    raw_io.write_csv(c.raw["reviews"], f"{base}/reviews", compression="gzip")
    scanned = raw_io.read_csv_table(c.spark, base, "reviews", RAW_REVIEWS,
                                    null_value=raw_io.NULL_MARKER)
    return staging.stg_reviews(scanned)


def _split_roundtrip(c: Catalog, table: str) -> DataFrame:
    base = f"{scratch_dir(c.spark)}/csv-split-{uuid.uuid4().hex}"
    raw_io.write_csv(c.raw[table], f"{base}/{table}", compression="bzip2")
    return raw_io.read_csv_table(c.spark, base, table, RAW_SCHEMAS[table], null_value=raw_io.NULL_MARKER, split=True)


@register("csv_split_bands")
def _csv_split_bands(c: Catalog) -> DataFrame:
    """The bands through CSV, read by byte range."""
    return staging.stg_bands(_split_roundtrip(c, "bands"))


@register("csv_split_albums")
def _csv_split_albums(c: Catalog) -> DataFrame:
    """The albums through CSV, read by byte range."""
    return staging.stg_albums(_split_roundtrip(c, "albums"))


@register("csv_split_reviews")
def _csv_split_reviews(c: Catalog) -> DataFrame:
    """S3: the reviews, whose texts span lines, through CSV, read by byte range."""
    return staging.stg_reviews(_split_roundtrip(c, "reviews"))


@register("published_build")
def _published_build(c: Catalog) -> DataFrame:
    """A whole build as a version, published, and its
    country mart as any session opens it."""
    from grimlake.plans import jobs
    base = f"{scratch_dir(c.spark)}/published-{uuid.uuid4().hex}"
    folder = versions.begin(c.spark, base)
    landed = {t: stored_table(df, t, f"{folder}/raw/{t}") for t, df in c.raw.items()}
    jobs.build(c.spark, landed, f"{folder}/models")
    versions.publish(c.spark, folder)
    return Catalog.opened(c.spark, f"{versions.current(c.spark, base)}/models").geographic_analysis


@register("preview")
def _preview(c: Catalog) -> DataFrame:
    """First rows of a loaded table (the limit is the feature)."""
    from grimlake.sources.raw import preview
    return preview(c.stg_bands, 5, "band_id")
