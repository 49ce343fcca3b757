"""Storage laid out for the reports' reads: clustered by date (FLT-5, FLT-6) and bucketed by key (JON-2, JON-10).

A clustered folder is range-partitioned and sorted by one column, and keeps a table of each file's
bounds beside it (``_bounds``, one row a file). A date range picks the files that may hold it from that
table before the scan is planned, so a month-to-date report over years of rows opens one month's files.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, column: str, files: int) -> None:
    """Write ``df`` as about ``files`` Parquet files that follow each other in ``column`` (NULLs first), with bounds."""
    spark = df.sparkSession
    order = F.col(column).asc_nulls_first()
    df.repartitionByRange(files, order).sortWithinPartitions(order).write.parquet(path)
    name = F.col("_metadata.file_name")
    bounds = spark.read.schema(df.schema).parquet(path).groupBy(name.alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count_if(F.col(column).isNull()).alias("nulls"),
        F.count(F.lit(1)).alias("rows"))
    bounds.coalesce(1).write.parquet(f"{path}/_bounds/all")  # one row a file


def files_between(spark: SparkSession, path: str, low, high) -> list[str]:
    """Files that may hold a value in ``[low, high]``; rows with NULL are in no range."""
    bounds = spark.read.parquet(f"{path}/_bounds/all")
    picked = bounds.filter((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))).select("file")
    return sorted(f"{path}/{r['file']}" for r in picked.collect())  # the files that the read opens


def read_between(spark: SparkSession, path: str, column: str, low, high, closed: bool = True) -> DataFrame:
    """Rows of a clustered folder with ``low <= column <= high`` (``< high`` unless ``closed``), from the files
    that may hold them."""
    schema = spark.read.parquet(path).schema
    files = files_between(spark, path, low, high)
    if not files:
        return spark.createDataFrame([], schema)
    upper: Column = F.col(column) <= F.lit(high) if closed else F.col(column) < F.lit(high)
    return spark.read.schema(schema).parquet(*files).filter((F.col(column) >= F.lit(low)) & upper)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, table: str | None = None) -> DataFrame:
    """Write ``df`` hashed and sorted by ``keys`` into ``buckets`` files and return it as a table of that layout.

    Tables of one key and number of buckets are joined, ranked and aggregated by the key without an
    exchange. Without a ``table`` name the catalog forgets it again (the files stay).
    """
    spark = df.sparkSession
    name = table or f"bucketed_{uuid4().hex}"
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    out = spark.table(name)
    out.schema  # resolved now, so that it outlives the name
    if table is None:
        spark.sql(f"DROP TABLE {name}")
    return out
