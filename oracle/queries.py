"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from oracle.models import top, with_ctes

Q: dict[str, str] = {}
FINAL: dict[str, str] = {}  # un-rendered final SELECTs (to swap raw sources in tests)


def q(name: str, sql: str) -> None:
    FINAL[name] = sql
    Q[name] = with_ctes(sql)


# ---- staging ---------------------------------------------------------------
q("stg_bands", "SELECT * FROM stg_bands")
q("stg_albums", "SELECT * FROM stg_albums")
q("stg_reviews", "SELECT review_id, album_id, review_title, CAST(score_album AS DOUBLE) AS score_album, "
                 "content_review FROM stg_reviews")

# ---- period parsing --------------------------------------------------------
q("period_split", "SELECT band_id, clean_active, period_1, period_2, period_3, periods_count, "
                  "has_name_change, last_period FROM periods")
q("period_years", "SELECT band_id, start_year, end_year, years_active FROM parsed")
q("period_status", "SELECT band_id, current_status, is_na_case FROM parsed")
q("name_change", "SELECT band_id, has_name_change, previous_name, name_change_year FROM parsed")
q("int_bands_parsed", "SELECT * FROM parsed")
q("parsed_by_name", "SELECT * FROM parsed ORDER BY band_name NULLS LAST, band_id NULLS LAST")

# ---- dims / fact -----------------------------------------------------------
q("dim_bands", "SELECT * FROM dim_bands")
q("dim_albums", "SELECT * FROM dim_albums")
q("fct_reviews", """SELECT * REPLACE (round(score_percentile, 6) AS score_percentile,
  round(decade_score_percentile, 6) AS decade_score_percentile,
  round(subgenre_score_percentile, 6) AS subgenre_score_percentile,
  round(score_vs_overall_avg, 6) AS score_vs_overall_avg,
  round(score_vs_band_avg, 6) AS score_vs_band_avg,
  round(score_vs_country_avg, 6) AS score_vs_country_avg,
  round(score_vs_decade_avg, 6) AS score_vs_decade_avg) FROM fct_reviews""")

# ---- marts -------------------------------------------------------------------
q("band_metrics", """SELECT * REPLACE (round(avg_score, 6) AS avg_score, round(min_score, 6) AS min_score,
  round(max_score, 6) AS max_score, round(score_consistency, 6) AS score_consistency,
  round(pct_high_quality, 6) AS pct_high_quality, round(pct_excellent, 6) AS pct_excellent)
FROM band_metrics_m""")
q("geographic_analysis", "SELECT * REPLACE (round(albums_per_band, 6) AS albums_per_band) FROM geo_m")
q("career_analysis", """SELECT * REPLACE (round(band_avg_score, 6) AS band_avg_score,
  round(score_vs_band_avg, 6) AS score_vs_band_avg) FROM career_m""")
q("temporal_analysis", """SELECT * REPLACE (round(avg_debut_score, 6) AS avg_debut_score,
  round(avg_score, 6) AS avg_score, round(score_variance, 6) AS score_variance,
  round(median_score, 6) AS median_score) FROM temporal ORDER BY album_year""")
q("subgenre_analysis", """SELECT * REPLACE (round(avg_score, 6) AS avg_score,
  round(score_variance, 6) AS score_variance, round(pct_excellent, 6) AS pct_excellent,
  round(pct_high_quality, 6) AS pct_high_quality, round(median_score, 6) AS median_score)
FROM subgenre""")

# ---- classifiers -----------------------------------------------------------------
q("band_maturity_era", "SELECT band_id, years_active, formed_year, band_maturity, formation_era, "
                       "formation_decade FROM dim_bands")
q("continent_map", "SELECT band_id, country, continent FROM dim_bands")
q("subgenre_rules", "SELECT band_id, genre, death_metal_subgenre FROM dim_bands")
q("band_flags", "SELECT band_id, is_active_flag, has_name_change_flag, is_golden_age_band, "
                "is_veteran_band, is_pure_death_metal, data_quality, total_career_span FROM dim_bands")
q("album_phase", "SELECT album_id, album_year, formed_year, release_decade, release_era, "
                 "band_career_phase, years_since_formation, is_debut_album, is_golden_age_release, "
                 "is_modern_release, is_early_career_album, is_legacy_album FROM albums_enriched")
q("album_theme", "SELECT album_id, album_title, title_theme_category FROM albums_enriched")
q("title_length_bucket", "SELECT album_id, title_length, title_length_category FROM albums_enriched")
q("score_bands", "SELECT review_id, album_id, score_d AS score_album, score_category, score_range, "
                 "is_excellent_score, is_high_score, is_good_score, is_poor_score FROM reviews_base")
q("text_length_bands", "SELECT review_id, album_id, review_title_length, review_title_category, "
                       "review_content_length, review_content_category, has_review_title, "
                       "has_review_content, is_substantial_review FROM reviews_base")
q("score_deviation", "SELECT review_id, album_id, round(score_above_threshold, 6) AS score_above_threshold, "
                     "round(score_deviation_from_average, 6) AS score_deviation_from_average "
                     "FROM reviews_base")

# ---- window operators ----------------------------------------------------------------
q("album_numbering", "SELECT album_id, band_id, album_year, album_number_in_discography, "
                     "reverse_album_number, album_number_in_decade, album_number_in_era, "
                     "album_number_in_country_decade, is_first_album, is_latest_album, "
                     "is_early_discography FROM dim_albums")
q("score_ranks", "SELECT review_id, album_id, band_score_rank, country_score_rank, decade_score_rank, "
                 "subgenre_score_rank FROM fct_reviews")
q("global_rank", "SELECT review_id, album_id, score_album, overall_score_rank FROM fct_reviews")
q("percent_ranks", "SELECT review_id, album_id, round(score_percentile, 6) AS score_percentile, "
                   "round(decade_score_percentile, 6) AS decade_score_percentile, "
                   "round(subgenre_score_percentile, 6) AS subgenre_score_percentile FROM fct_reviews")
q("score_vs_avg", "SELECT review_id, album_id, round(score_vs_overall_avg, 6) AS score_vs_overall_avg, "
                  "round(score_vs_band_avg, 6) AS score_vs_band_avg, "
                  "round(score_vs_country_avg, 6) AS score_vs_country_avg, "
                  "round(score_vs_decade_avg, 6) AS score_vs_decade_avg FROM fct_reviews")
q("above_avg_flags", "SELECT review_id, album_id, is_above_overall_avg, is_above_band_avg, "
                     "is_above_subgenre_avg FROM fct_reviews")
q("partition_counts", "SELECT review_id, album_id, band_total_reviews, album_total_reviews FROM fct_reviews")
q("lag_change", "SELECT band_id, album_year, album_title, score_album, previous_album_score, score_change, "
                "round(band_avg_score, 6) AS band_avg_score, round(score_vs_band_avg, 6) AS score_vs_band_avg, "
                "album_career_position, career_timing FROM career_m")
q("sophomore_slump", "SELECT band_id, album_number_in_discography, score_album, previous_album_score, "
                     "has_sophomore_slump FROM career_m")
q("band_best", "SELECT band_id, album_title, score_album, is_band_best_album FROM career_m")

# ---- aggregates ---------------------------------------------------------------------
q("median_by_year", "SELECT album_year, round(median_score, 6) AS median_score FROM t_med")
q("dominant_subgenre_by_year", "SELECT * FROM t_dom")
q("dominant_era_by_country", "SELECT * FROM geo_era")
q("conditional_distinct", """SELECT album_year,
  count(DISTINCT band_id) FILTER (review_id IS NOT NULL) AS active_bands,
  count(DISTINCT album_id) FILTER (is_debut_album = 1) AS debut_albums,
  round(avg(score) FILTER (is_debut_album = 1), 6) AS avg_debut_score
FROM t_base GROUP BY album_year""")
q("safe_percent", "SELECT band_id, total_reviews, round(pct_high_quality, 6) AS pct_high_quality, "
                  "round(pct_excellent, 6) AS pct_excellent FROM band_metrics_m")
q("safe_ratio", """SELECT band_id, round(CASE WHEN total_albums = 0 OR total_albums IS NULL THEN NULL
  ELSE CAST(total_reviews AS DOUBLE) / total_albums END, 6) AS reviews_per_album FROM band_metrics_m""")
q("mode_value", top("dim_albums", "band_id", "album_year", "mode_album_year"))
q("stddev_by_band", "SELECT band_id, count(score_album) AS n_scores, "
                    "round(stddev_samp(score_album), 6) AS score_stddev FROM fct_reviews GROUP BY band_id")
q("percentile_any", """SELECT release_decade,
  round(quantile_cont(score_album, 0.25), 6) AS p25_score, round(quantile_cont(score_album, 0.5), 6) AS p50_score,
  round(quantile_cont(score_album, 0.75), 6) AS p75_score, round(quantile_cont(score_album, 0.9), 6) AS p90_score
FROM fct_reviews GROUP BY release_decade""")

# ---- analyst queries -----------------------------------------------------------------
q("top_bands", """SELECT band_name, total_albums, round(avg_score, 6) AS avg_score,
  round(pct_excellent, 6) AS pct_excellent
FROM band_metrics_m WHERE has_substantial_catalog = 1
ORDER BY avg_score DESC NULLS LAST, band_id LIMIT 10""")
q("country_list", """SELECT country, total_bands, dominant_subgenre FROM geo_m
WHERE total_bands >= 10 ORDER BY total_bands DESC, country NULLS LAST""")
q("career_pattern", """SELECT album_career_position, round(avg(score_album), 6) AS avg_score,
  count(*) AS total_albums FROM career_m GROUP BY album_career_position ORDER BY avg_score DESC""")
q("yearly_trend", """SELECT release_decade, albums_released, round(avg_score, 6) AS avg_score,
  dominant_subgenre FROM temporal ORDER BY release_decade, album_year""")
q("score_evolution", """
SELECT band_name, count(*) FILTER (step > 0) AS improvements, count(*) FILTER (step < 0) AS declines
FROM (SELECT band_id, score_album - lag(score_album) OVER (
        PARTITION BY band_id ORDER BY album_year, album_id, review_id, score_album) AS step FROM fct_reviews)
JOIN dim_bands USING (band_id) GROUP BY band_name HAVING count(*) >= 5""")


# ---- data-quality checks: plain SQL counts generated from the declared list ----------
def _check_sql(kind: str) -> str:
    from grimlake.operators.quality import DECLARED_CHECKS
    cte_of = {"stg_metal_bands": "stg_bands", "stg_metal_albums": "stg_albums",
              "stg_metal_reviews": "stg_reviews", "int_metal_bands_parsed": "parsed",
              "dim_bands": "dim_bands", "dim_albums": "dim_albums", "fct_reviews": "fct_reviews"}
    parts = []
    for ch in DECLARED_CHECKS:
        if ch.kind != kind:
            continue
        m, col = cte_of[ch.model], ch.column
        meta = (f"'{ch.check_id}' AS check_id, '{ch.model}' AS model, '{col}' AS column_name, "
                f"'{ch.kind}' AS test, '{ch.severity}' AS severity")
        if kind == "not_null":
            n = f"(SELECT count(*) FROM {m} WHERE {col} IS NULL)"
        elif kind == "unique":
            n = (f"(SELECT count(*) FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1))")
        elif kind == "accepted_values":
            vals = ", ".join("'" + v.replace("'", "''") + "'" for v in ch.values)
            n = f"(SELECT count(DISTINCT {col}) FROM {m} WHERE {col} NOT IN ({vals}))"
        else:
            p, pc = cte_of[ch.to_model], ch.to_column
            n = (f"(SELECT count(*) FROM {m} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {p} p WHERE p.{pc} = c.{col}))")
        parts.append(f"SELECT {meta}, CAST({n} AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(parts)


for _kind, _name in [("not_null", "check_not_null"), ("unique", "check_unique"),
                     ("accepted_values", "check_accepted_values"),
                     ("relationships", "check_relationships")]:
    q(_name, _check_sql(_kind))
q("check_severity", "SELECT * REPLACE ('warn' AS severity) FROM (" + "\nUNION ALL\n".join(
    _check_sql(k) for k in ("not_null", "unique", "accepted_values", "relationships")) + ")")



def _failing_sql() -> str:
    from grimlake.operators.quality import DECLARED_CHECKS
    cte_of = {"stg_metal_bands": "stg_bands", "stg_metal_albums": "stg_albums",
              "stg_metal_reviews": "stg_reviews", "int_metal_bands_parsed": "parsed"}
    parts = []
    for ch in DECLARED_CHECKS:
        m, col = cte_of.get(ch.model, ch.model), ch.column
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in ch.values)
        bad = {"not_null": f"{col} IS NULL", "unique": f"{col} IS NOT NULL", "accepted_values": f"{col} NOT IN ({vals})",
               "relationships": f"{col} IS NOT NULL AND {col} NOT IN (SELECT {ch.to_column} FROM "
                                f"{cte_of.get(ch.to_model, ch.to_model)} WHERE {ch.to_column} IS NOT NULL)"}[ch.kind]
        more = "HAVING count(*) > 1" if ch.kind == "unique" else ""
        parts.append(f"SELECT '{ch.check_id}' AS check_id, CAST({col} AS VARCHAR) AS value, count(*) AS n FROM {m} "
                     f"WHERE {bad} GROUP BY {col} {more}")
    return "\nUNION ALL\n".join(parts)


q("failing_rows", _failing_sql())

# ---- sources -------------------------------------------------------------------------
q("csv_roundtrip", "SELECT review_id, album_id, review_title, CAST(score_album AS DOUBLE) AS score_album, "
                   "content_review FROM stg_reviews")
for _t in ("bands", "albums", "reviews"):
    q(f"csv_split_{_t}", FINAL[f"stg_{_t}"])
q("published_build", FINAL["geographic_analysis"])
q("preview", "SELECT * FROM stg_bands ORDER BY band_id LIMIT 5")
# The sketch holds every label of these tables, so its counts are exact.
q("approx_top_value", """SELECT release_decade, first(label ORDER BY n DESC, label) AS top_subgenre, max(n) AS top_count
FROM (SELECT release_decade, death_metal_subgenre AS label, count(*) AS n FROM reviews_base
      WHERE death_metal_subgenre IS NOT NULL GROUP BY ALL) GROUP BY release_decade""")
q("approx_top_merged", FINAL["approx_top_value"])
