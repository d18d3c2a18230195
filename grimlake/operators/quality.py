"""Declarative data-quality checks (Q1-Q6) run as Spark jobs.

A check names a model, a column and a kind. ``failing_rows`` returns the
rows a check rejects (kept on request, like stored test failures);
``summary`` returns one row per check with its failure count, built
entirely as DataFrames (the driver only ever sees the per-check counts).

Failure counts follow the usual column-test semantics:

* ``not_null``        rows whose value is null
* ``unique``          distinct non-null values that occur more than once
* ``accepted_values`` distinct non-null values outside the list (null passes)
* ``relationships``   non-null child rows without a parent key (null passes)

All checks of one model but ``unique`` are decided in one scan of it: a row
yields the ids of the checks that it fails, and only failing rows go on.
Relationships come to this scan as the child keys without a parent, found among
the distinct keys before it, so that rows are not shuffled to their parents. A
model of several tables (``Parts``) is checked a table at a time, and only its
failing rows are joined.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grimlake.functions import rules as R
from grimlake.operators.joins import few, not_broadcast, sized_join
from grimlake.sources.stage import stored_table

SUMMARY_COLUMNS = ["check_id", "model", "column_name", "test", "severity", "failures"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple = field(default=())
    to_model: str | None = None
    to_column: str | None = None
    severity: str = "error"

    @property
    def check_id(self) -> str:
        suffix = f"__{self.to_model}" if self.kind == "relationships" else ""
        return f"{self.kind}__{self.model}__{self.column}{suffix}"


@dataclass(frozen=True)
class Parts:
    """A model whose columns are in several tables that meet on ``key``."""
    key: str
    frames: tuple[DataFrame, ...]
    columns: tuple[str, ...]

    def whole(self) -> DataFrame:
        return functools.reduce(lambda a, b: sized_join(a, b, self.key), self.frames).select(*self.columns)

    def having(self, column: str) -> DataFrame:
        return next(df for df in self.frames if column in df.columns)


Models = Mapping[str, DataFrame | Parts]


def whole(model: DataFrame | Parts) -> DataFrame:
    return model.whole() if isinstance(model, Parts) else model


def values_of(model: DataFrame | Parts, column: str, name: str) -> DataFrame:
    """The distinct non-null values of a column."""
    df = model.having(column) if isinstance(model, Parts) else model
    return df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in cols]


# FIXED VALUES: the declared column tests of the catalogue models.
DECLARED_CHECKS: list[Check] = [
    *_nn("stg_metal_bands", "band_id"),
    Check("stg_metal_albums", "band_id", "relationships", to_model="stg_metal_albums",
          to_column="band_id"),
    *_nn("stg_metal_reviews", "album_id"),
    Check("stg_metal_reviews", "album_id", "relationships", to_model="stg_metal_albums",
          to_column="album_id"),
    *_nn("int_metal_bands_parsed", "band_id"),
    Check("int_metal_bands_parsed", "band_id", "relationships", to_model="stg_metal_bands",
          to_column="band_id"),
    *_nn("int_metal_bands_parsed", "band_name", "current_status"),
    Check("int_metal_bands_parsed", "current_status", "accepted_values",
          values=tuple(R.STATUS_VALUES)),
    *_nn("int_metal_bands_parsed", "has_name_change", "periods_count", "is_na_case"),
    *_nn("dim_bands", "band_id"),
    Check("dim_bands", "band_id", "unique"),
    *_nn("dim_bands", "band_name", "country", "continent"),
    Check("dim_bands", "continent", "accepted_values", values=tuple(R.CONTINENT_VALUES)),
    *_nn("dim_bands", "current_status"),
    Check("dim_bands", "current_status", "accepted_values", values=tuple(R.STATUS_VALUES)),
    *_nn("dim_bands", "formation_era", "band_maturity", "death_metal_subgenre",
         "is_active_flag"),
    *_nn("dim_albums", "album_id"),
    Check("dim_albums", "album_id", "unique"),
    *_nn("dim_albums", "band_id"),
    Check("dim_albums", "band_id", "relationships", to_model="dim_bands", to_column="band_id"),
    *_nn("dim_albums", "album_title", "album_year", "release_era", "band_career_phase",
         "album_number_in_discography", "is_debut_album"),
    *_nn("fct_reviews", "review_id", "album_id"),
    Check("fct_reviews", "album_id", "relationships", to_model="dim_albums",
          to_column="album_id"),
    *_nn("fct_reviews", "band_id"),
    Check("fct_reviews", "band_id", "relationships", to_model="dim_bands", to_column="band_id"),
    *_nn("fct_reviews", "score_album", "score_category"),
    Check("fct_reviews", "score_category", "accepted_values",
          values=tuple(R.SCORE_CATEGORY_VALUES)),
    Check("fct_reviews", "score_range", "accepted_values", values=tuple(R.SCORE_RANGE_VALUES)),
    *_nn("fct_reviews", "overall_score_rank", "score_percentile", "is_excellent_score",
         "band_total_reviews"),
]


def declared_checks(severity: str = "error") -> list[Check]:
    """The declared checks with one severity. The source sets it per target:
    ``error`` in production, ``warn`` elsewhere (a ``warn`` failure is
    reported and the job goes on)."""
    return [replace(c, severity=severity) for c in DECLARED_CHECKS]


def severity_for(target: str) -> str:
    return "error" if target == "prod" else "warn"


def failing_rows(check: Check, models: Models) -> DataFrame:
    """The rows (or values) a check rejects."""
    df = whole(models[check.model])
    c = F.col(check.column)
    if check.kind == "not_null":
        return df.where(c.isNull())
    if check.kind == "unique":
        return (df.where(c.isNotNull()).groupBy(check.column)
                .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))
    if check.kind == "accepted_values":
        return (df.groupBy(F.col(check.column).alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records"))
                .where(~F.col("value_field").isin(*check.values)))
    if check.kind == "relationships":
        parent = not_broadcast(values_of(models[check.to_model], check.to_column, "_parent_key"))
        child = df.where(c.isNotNull()).select(c.alias("from_field"))
        return child.join(parent, F.col("from_field") == F.col("_parent_key"), "left_anti")
    raise ValueError(f"unknown check kind {check.kind!r}")


FAILED = "_failed"
#: Row checks are decided by a row alone (and the parents' keys); a unique check by all rows of a value.
ROW_KINDS = ("not_null", "accepted_values", "relationships")


def by_model(checks: Iterable[Check]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for ch in checks:
        out.setdefault(ch.model, []).append(ch)
    return out


def orphans(check: Check, models: Models, name: str) -> DataFrame:
    """Stored: the child keys of a relationship that no parent has, each once."""
    child = values_of(models[check.model], check.column, name)
    parent = not_broadcast(values_of(models[check.to_model], check.to_column, "_parent_key"))  # both are dealt by the key
    return stored_table(child.join(parent, F.col(name) == F.col("_parent_key"), "left_anti"), "orphans")


def small(df: DataFrame) -> DataFrame:
    """A stored table, broadcast where its rows are few enough, and only there."""
    return F.broadcast(df) if few(df) else not_broadcast(df)


def judged(df: DataFrame, checks: Iterable[Check], models: Models) -> DataFrame:
    """``df`` with the array ``_failed`` of (check_id, value) of the row checks that
    a row fails: all checks of a model in one scan. A relationship is a left
    join with the keys that have no parent, none where there is no such key."""
    marks, out = [F.lit(None).cast("struct<check_id:string,value:string>")], df
    for i, ch in enumerate(checks):
        c = F.col(f"`{ch.column}`")
        if ch.kind == "not_null":
            fails = c.isNull()
        elif ch.kind == "accepted_values":
            fails = ~c.isin(*ch.values)
        else:
            key = f"_orphan_{i}"
            lost = orphans(ch, models, key)
            if lost.isEmpty():
                continue
            out = out.join(small(lost), c == F.col(key), "left")
            fails = F.col(key).isNotNull()
        marks.append(F.when(fails, F.struct(F.lit(ch.check_id).alias("check_id"), c.cast("string").alias("value"))))
    every = F.filter(F.array(*marks), lambda x: x.isNotNull())
    return out.withColumn(FAILED, every).select(*df.columns, FAILED)


def marked(model: DataFrame | Parts, checks: Iterable[Check], models: Models) -> DataFrame:
    """The rows of a model that fail row checks, with ``_failed`` (``judged``). Of a
    model in parts, each part is judged by itself; the parts meet for the keys of
    failing rows alone."""
    failing = F.size(FAILED) > 0
    if not isinstance(model, Parts):
        return judged(model, checks, models).where(failing)
    by_part: dict[int, list[Check]] = {}
    for ch in checks:
        by_part.setdefault(next(i for i, df in enumerate(model.frames) if ch.column in df.columns), []).append(ch)
    parts = [judged(df, by_part.get(i, []), models).withColumnRenamed(FAILED, f"{FAILED}_{i}")
             for i, df in enumerate(model.frames)]
    found = [df.where(F.size(f"{FAILED}_{i}") > 0).select(model.key) for i, df in enumerate(parts) if i in by_part]
    keys = small(stored_table(functools.reduce(DataFrame.unionByName, found).distinct(), "failing_keys"))
    rows = functools.reduce(lambda a, b: a.join(b, model.key), [df.join(keys, model.key, "left_semi") for df in parts])
    every = F.concat(*[f"{FAILED}_{i}" for i in range(len(parts))])
    return rows.withColumn(FAILED, every).select(*model.columns, FAILED).where(failing)


def repeated(check: Check, models: Models) -> DataFrame:
    """(check_id, value, n) of the values that a unique check rejects."""
    return failing_rows(check, models).select(
        F.lit(check.check_id).alias("check_id"), F.col(check.column).cast("string").alias("value"),
        F.col("n_records").alias("n"))


def failing_values(models: Models, checks: Iterable[Check] = DECLARED_CHECKS) -> DataFrame:
    """(check_id, value, n): each rejected value as text (null for not_null checks)
    and its number of rows; one scan of a model for all its row checks."""
    parts: list[DataFrame] = []
    for model, group in by_model(checks).items():
        own = [ch for ch in group if ch.kind in ROW_KINDS]
        if own:
            found = marked(models[model], own, models).select(F.explode(FAILED).alias("_f"))
            parts.append(found.groupBy("_f.check_id", "_f.value").agg(F.count(F.lit(1)).alias("n")))
        parts += [repeated(ch, models) for ch in group if ch.kind == "unique"]
    return functools.reduce(DataFrame.unionByName, parts)


def counted(values: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from the rejected values: for unique and accepted-values
    checks the number of values, for the others of rows."""
    totals = values.groupBy("check_id").agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    meta = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(
        SUMMARY_COLUMNS, (c.check_id, c.model, c.column, c.kind, c.severity))]) for c in checks])
    declared = values.sparkSession.range(1).select(F.explode(meta).alias("_c")).select("_c.*")
    of_values = F.col("test").isin("unique", "accepted_values")
    return declared.join(totals, "check_id", "left").select(
        *SUMMARY_COLUMNS[:-1], F.coalesce(F.when(of_values, F.col("_values")).otherwise(F.col("_rows")), F.lit(0))
        .cast("bigint").alias("failures"))


def summary(models: Models, checks: Iterable[Check] = DECLARED_CHECKS,
            kinds: Iterable[str] | None = None) -> DataFrame:
    """One row per check: id, model, column, test, severity, failures."""
    checks = [c for c in checks if kinds is None or c.kind in set(kinds)]
    return counted(failing_values(models, checks), checks)


UNIQUE = "unique_values"


def store_failures(models: Models, base_path: str,
                   checks: Iterable[Check] = DECLARED_CHECKS) -> dict[str, str]:
    """Q5: write the failing rows (replace mode) under ``base_path``: a table per
    model, partitioned by check, from one scan of the model (a row that fails
    several checks is in several partitions); the repeated values of the unique
    checks are a table of their own. Returns each check's folder, which is
    missing where nothing failed."""
    base, paths, checks = base_path.rstrip("/"), {}, list(checks)
    for model, group in by_model([c for c in checks if c.kind in ROW_KINDS]).items():
        rows = marked(models[model], group, models).withColumn("_f", F.explode(FAILED)).select(
            *[f"`{c}`" for c in models[model].columns], F.col("_f.value").alias("failed_value"), F.col("_f.check_id"))
        rows.write.mode("overwrite").partitionBy("check_id").parquet(f"{base}/{model}")
        paths |= {c.check_id: f"{base}/{model}/check_id={c.check_id}" for c in group}
    unique = [c for c in checks if c.kind == "unique"]
    if unique:
        values = functools.reduce(DataFrame.unionByName, [repeated(c, models) for c in unique])
        values.write.mode("overwrite").partitionBy("check_id").parquet(f"{base}/{UNIQUE}")
        paths |= {c.check_id: f"{base}/{UNIQUE}/check_id={c.check_id}" for c in unique}
    return paths


def stored_summary(spark: SparkSession, base_path: str, checks: Iterable[Check] = DECLARED_CHECKS) -> DataFrame:
    """The summary, counted from stored failing rows: no model is read again."""
    base, checks, parts = base_path.rstrip("/"), list(checks), []
    for model in by_model([c for c in checks if c.kind in ROW_KINDS]):
        rows = spark.read.schema("failed_value string, check_id string").parquet(f"{base}/{model}")
        parts.append(rows.groupBy("check_id", F.col("failed_value").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    if any(c.kind == "unique" for c in checks):
        parts.append(spark.read.schema("value string, n long, check_id string").parquet(f"{base}/{UNIQUE}").select(
            "check_id", "value", "n"))
    return counted(functools.reduce(DataFrame.unionByName, parts), checks)


class QualityError(RuntimeError):
    pass


def enforce(summary_df: DataFrame) -> list[dict]:
    """Q6: collect the per-check counts (one row per check, bounded) and
    raise on a failed ``error`` check; ``warn`` checks are only reported."""
    rows = [r.asDict() for r in summary_df.collect()]
    errors = [r for r in rows if r["failures"] and r["severity"] == "error"]
    if errors:
        raise QualityError(", ".join(f"{r['check_id']}={r['failures']}" for r in errors))
    return rows
