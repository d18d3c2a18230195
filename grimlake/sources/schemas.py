"""Declared raw schemas (S4). Number-like text that can hold junk ('N/A')
is read as string and cast with ``try_cast`` in staging; ids are 64-bit."""

from pyspark.sql import types as T

RAW_BANDS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("formed_in", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("theme", T.StringType()),
    T.StructField("active", T.StringType()),
])

RAW_ALBUMS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("band", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.StringType()),
])

RAW_REVIEWS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("album", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("content", T.StringType()),
])

RAW_SCHEMAS = {"bands": RAW_BANDS, "albums": RAW_ALBUMS, "reviews": RAW_REVIEWS}
