"""Driver test tables -> the three raw catalogue tables.

bands <- customer, albums <- orders, reviews <- lineitem. The SELECT text is
valid in both Spark SQL and DuckDB, so the SQL oracle pastes the very same
text in as CTEs. Spark runs it with DataFrame parameters (``{customer}``),
so no global temp view is registered. It injects null keys, orphans, junk
years, ties and a null country on purpose.

FIXED VALUES: the adapter text is the shared test-data contract; its
constants (nation-to-country names, genre strings, period templates, album
titles, modulus choices) must stay exactly as written for the oracle to agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_BANDS_SQL = """
SELECT c_custkey AS id,
       concat('  ', c_name, ' ') AS name,
       CASE c_nationkey
         WHEN 0 THEN 'United States' WHEN 1 THEN 'Canada' WHEN 2 THEN 'Mexico' WHEN 3 THEN 'Brazil'
         WHEN 4 THEN 'Chile' WHEN 5 THEN 'Colombia' WHEN 6 THEN 'Germany' WHEN 7 THEN 'Sweden'
         WHEN 8 THEN 'Finland' WHEN 9 THEN 'Poland' WHEN 10 THEN 'France' WHEN 11 THEN 'Norway'
         WHEN 12 THEN 'Japan' WHEN 13 THEN 'Indonesia' WHEN 14 THEN 'India' WHEN 15 THEN 'Nepal'
         WHEN 16 THEN 'Australia' WHEN 17 THEN 'New Zealand' WHEN 18 THEN 'Fiji' WHEN 19 THEN 'Egypt'
         WHEN 20 THEN 'South Africa' WHEN 21 THEN 'Kenya' WHEN 22 THEN 'Czechia' WHEN 23 THEN 'Greenland'
         ELSE NULL END AS country,
       CASE c_custkey % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'Split-up' WHEN 2 THEN 'On hold'
         WHEN 3 THEN 'Changed name' ELSE 'Unknown' END AS status,
       CASE WHEN c_custkey % 17 = 0 THEN 'N/A'
         ELSE CAST(1958 + (c_custkey * 7) % 66 AS STRING) END AS formed_in,
       CASE c_custkey % 13 WHEN 0 THEN 'Brutal Death Metal' WHEN 1 THEN 'technical Death Metal'
         WHEN 2 THEN 'TECH Death Metal' WHEN 3 THEN 'Melodic Death Metal' WHEN 4 THEN 'Progressive Death Metal'
         WHEN 5 THEN 'Blackened Death Metal' WHEN 6 THEN 'Black/Death Metal' WHEN 7 THEN 'Death/Doom Metal'
         WHEN 8 THEN 'Deathgrind' WHEN 9 THEN 'Death Metal' WHEN 10 THEN 'Death Metal/Thrash Metal'
         WHEN 11 THEN 'Thrash Metal' ELSE NULL END AS genre,
       c_mktsegment AS theme,
       CASE c_custkey % 14
         WHEN 0 THEN 'N/A'
         WHEN 1 THEN NULL
         WHEN 2 THEN concat(CAST(1980 + c_custkey % 30 AS STRING), '-', CAST(1981 + c_custkey % 30 + c_custkey % 11 AS STRING))
         WHEN 3 THEN concat(CAST(1980 + c_custkey % 44 AS STRING), '-present')
         WHEN 4 THEN concat('?-', CAST(1985 + c_custkey % 30 AS STRING))
         WHEN 5 THEN concat('?-1995|', CAST(1996 + c_custkey % 20 AS STRING), '-present')
         WHEN 6 THEN concat(CAST(1985 + c_custkey % 30 AS STRING), '-?')
         WHEN 7 THEN concat(CAST(1985 + c_custkey % 9 AS STRING), '-1994 (as Old', CAST(c_custkey AS STRING), ') | 1994-present')
         WHEN 8 THEN concat(CAST(1985 + c_custkey % 9 AS STRING), '-1994 (as Old', CAST(c_custkey AS STRING), ')')
         WHEN 9 THEN concat(CAST(1980 + c_custkey % 9 AS STRING), '-1989|1990-2000|2001-2003|2005-present')
         WHEN 10 THEN CAST(1980 + c_custkey % 40 AS STRING)
         WHEN 11 THEN '199?-2000'
         WHEN 12 THEN concat(CAST(1970 + c_custkey % 50 AS STRING), '-present')
         ELSE concat(CAST(1980 + c_custkey % 9 AS STRING), '-1989|1990-', CAST(1991 + c_custkey % 30 AS STRING)) END AS active
FROM {customer}
"""

RAW_ALBUMS_SQL = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN o_custkey + 100000000
            ELSE o_custkey END AS band,
       CASE o_orderkey % 12 WHEN 0 THEN 'Death March' WHEN 1 THEN 'In Dark' WHEN 2 THEN 'Black Harvest Moon'
         WHEN 3 THEN 'Blood over the Northern Sea' WHEN 4 THEN 'Gore' WHEN 5 THEN 'An Evil Bargain Struck at Midnight'
         WHEN 6 THEN '  Hellgate  ' WHEN 7 THEN 'Demonology' WHEN 8 THEN 'Toward the Light' WHEN 9 THEN 'Battlements'
         WHEN 10 THEN 'Ritual of Ash' ELSE concat('Échoes ', CAST(o_orderkey AS STRING), ' of a Silent Shore') END AS title,
       CASE WHEN o_orderkey % 41 = 0 THEN 'N/A'
            ELSE CAST(year(o_orderdate) - 29 + o_orderkey % 53 AS STRING) END AS year
FROM {orders}
"""

RAW_REVIEWS_SQL = """
SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id,
       CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE l_orderkey END AS album,
       CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN 'Solid'
         WHEN 3 THEN ' Exactly twenty char ' WHEN 4 THEN 'A record that takes its time to open up'
         ELSE 'A very long headline which goes on well past the fifty mark' END AS title,
       CASE WHEN (l_partkey + l_linenumber) % 37 = 0 THEN NULL
            ELSE CAST(CAST(l_quantity * 2 AS INT) AS STRING) END AS score,
       CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '  '
            ELSE repeat('x', CAST((l_partkey * 37 + l_linenumber) % 2500 AS INT)) END AS content
FROM {lineitem}
"""

ADAPTER_SQL = {
    "bands": (RAW_BANDS_SQL, "customer"),
    "albums": (RAW_ALBUMS_SQL, "orders"),
    "reviews": (RAW_REVIEWS_SQL, "lineitem"),
}


def raw_sql_for_duckdb(table: str) -> str:
    """The adapter SELECT with plain table names, for the SQL oracle."""
    text, src = ADAPTER_SQL[table]
    return text.replace("{" + src + "}", src)


SPREAD_MIN_BYTES = 1 << 20


def _input_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def spread_scan(df: DataFrame, path: str) -> DataFrame:
    """A scan with fewer splits than the cluster has cores (one Parquet row
    group cannot be split) is round-robin spread before the per-row work,
    when the input is large enough for that to pay (at least 1 MiB). Only
    the few source columns move; many-file inputs are left as scanned."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores and _input_bytes(spark, path) >= SPREAD_MIN_BYTES:
        return df.repartition(cores)
    return df


def raw_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Build the three raw tables from the driver's Parquet tables."""
    out = {}
    for table, (text, src) in ADAPTER_SQL.items():
        path = f"{sf_dir.rstrip('/')}/{src}.parquet"
        out[table] = spark.sql(text, **{src: spread_scan(spark.read.parquet(path), path)})
    return out
