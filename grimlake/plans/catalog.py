"""The model graph: raw -> staging -> parsed -> dims -> fact -> marts.

``Catalog`` builds each model on first use and keeps the DataFrame, the
way the warehouse materialises a model once per build and lets downstream
models read it. ``dim_bands``, ``dim_albums``, the fact base and the fact's
window table are written once as Parquet under the checkpoint folder; the
others are lazy plans over them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from grimlake.functions import rules as R
from grimlake.operators.joins import unless_many
from grimlake.operators.quality import Parts
from grimlake.plans import dims, facts, marts, periods, staging
from grimlake.session import checkpoint_dir
from grimlake.sources.adapter import raw_from_driver
from grimlake.sources.stage import stored_table


#: Attribute -> folder of what a build with ``out_base`` writes.
STORED = {"stg_bands": "stg_metal_bands", "stg_albums": "stg_metal_albums", "stg_reviews": "stg_metal_reviews",
          "parsed": "int_metal_bands_parsed", "dim_bands": "dim_bands", "dim_albums": "dim_albums",
          "review_texts": "review_texts", "fct_base": "fct_base", "fct_windows": "fct_windows",
          "subgenre_analysis": "subgenre_analysis"}


class Catalog:
    """``out_base`` names a folder where the table models are written, each once,
    and read back by every model after them; without it the dimensions and the
    fact are stored in the scratch folder and the rest are lazy."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 current_year: int = R.CURRENT_YEAR, out_base: str | None = None):
        self.spark = spark
        self.raw = raw
        self.current_year = current_year
        self.out_base = out_base.rstrip("/") if out_base else None
        checkpoint_dir(spark)

    def _table(self, name: str, df: DataFrame) -> DataFrame:
        return stored_table(df, name, f"{self.out_base}/{name}") if self.out_base else df

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> "Catalog":
        return cls(spark, raw_from_driver(spark, sf_dir))

    @classmethod
    def opened(cls, spark: SparkSession, out_base: str, current_year: int = R.CURRENT_YEAR) -> "Catalog":
        """The models of a finished build in ``out_base``: stored ones are read, the
        others are plans over them. Nothing is written."""
        cat = cls(spark, {}, current_year, out_base)
        for attr, name in STORED.items():
            df = unless_many(spark.read.parquet(f"{cat.out_base}/{name}"))
            cat.__dict__[attr] = df.drop(*dims.AUDIT) if attr.startswith("dim_") else df
        return cat

    @cached_property
    def stg_bands(self) -> DataFrame:
        return self._table("stg_metal_bands", staging.stg_bands(self.raw["bands"]))

    @cached_property
    def stg_albums(self) -> DataFrame:
        return self._table("stg_metal_albums", staging.stg_albums(self.raw["albums"]))

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return self._table("stg_metal_reviews", staging.stg_reviews(self.raw["reviews"]))

    @cached_property
    def parsed(self) -> DataFrame:
        return self._table("int_metal_bands_parsed", periods.parse(self.stg_bands, self.current_year))

    @cached_property
    def dim_bands(self) -> DataFrame:
        # Stored once: every album, fact and mart plan reads it.
        bands = dims.dim_bands(self.parsed, self.current_year)
        if self.out_base:
            return self._table("dim_bands", dims.with_audit(bands)).select(*bands.columns)
        return stored_table(bands, "dim_bands")

    @cached_property
    def dim_albums(self) -> DataFrame:
        if self.out_base:
            albums = dims.dim_albums(self.stg_albums, self.dim_bands)
            return self._table("dim_albums", dims.with_audit(albums)).select(*albums.columns)
        return dims.dim_albums_stored(self.stg_albums, self.dim_bands)

    def _path(self, name: str) -> str | None:
        return f"{self.out_base}/{name}" if self.out_base else None

    @cached_property
    def review_texts(self) -> DataFrame:
        """Stored reviews with texts, row classes and ``_rk``."""
        return facts.review_texts(self.stg_reviews, self._path("review_texts"))

    @cached_property
    def fct_base(self) -> DataFrame:
        """Stored fact rows (all but texts and window columns, + ``_rk``)."""
        return facts.fct_base(self.review_texts, self.dim_albums, self._path("fct_base"))

    @cached_property
    def fct_windows(self) -> DataFrame:
        """The seventeen window columns per fact row, stored once (small:
        numbers keyed by ``_rk``, plus the row's ids)."""
        return facts.stored_windows(self.fct_base, self._path("fct_windows"))

    @cached_property
    def fct_reviews_keyed(self) -> DataFrame:
        return facts.fct_reviews_keyed(self.review_texts, self.fct_base, self.fct_windows)

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return self.fct_reviews_keyed.select(*facts.FCT_COLUMNS)

    def models(self) -> dict[str, DataFrame | Parts]:
        """Model name -> DataFrame, for the data-quality checks; the fact as its parts,
        without its texts, which no check reads (``_rk`` finds them)."""
        return {"stg_metal_bands": self.stg_bands, "stg_metal_albums": self.stg_albums,
                "stg_metal_reviews": self.stg_reviews, "int_metal_bands_parsed": self.parsed,
                "dim_bands": self.dim_bands, "dim_albums": self.dim_albums,
                "fct_reviews": facts.fct_parts(self.fct_base, self.fct_windows)}

    # ---- marts: lazy views over the stored dims and the stored fact rows.
    # They use only fact columns that exist before the window step (ids and
    # score), so they read ``fct_base``: same rows as ``fct_reviews``.
    @cached_property
    def band_metrics(self) -> DataFrame:
        return marts.band_metrics(self.dim_bands, self.dim_albums, self.fct_base)

    @cached_property
    def geographic_analysis(self) -> DataFrame:
        return marts.geographic_analysis(self.dim_bands, self.dim_albums)

    @cached_property
    def career_analysis(self) -> DataFrame:
        return marts.career_analysis(self.dim_albums, self.fct_base)

    @cached_property
    def temporal_analysis(self) -> DataFrame:
        return marts.temporal_analysis(self.dim_bands, self.dim_albums, self.fct_base)

    @cached_property
    def subgenre_analysis(self) -> DataFrame:
        return self._table("subgenre_analysis",
                           marts.subgenre_analysis(self.dim_bands, self.dim_albums, self.fct_base))
