"""Table sources (SRC-1..SRC-4)."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A base table: ``{base}/{name}.parquet`` when ``base`` is given, else a catalog table.

    Either way the scan is lazy, so column pruning and filter pushdown come from Catalyst.
    """
    if base is None:
        return spark.table(name)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, names: Iterable[str], base: str | None = None) -> dict[str, DataFrame]:
    return {n: read_table(spark, n, base) for n in names}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames to ``spark.sql`` under their names (session-scoped temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None,
            **frames: DataFrame) -> DataFrame:
    """SQL text to a relation (SRC-2).

    Named parameters (``:name``) are bound as literals from ``args``; ``{name}`` placeholders
    refer to the DataFrames passed as keyword arguments, so no session-wide view is needed.
    """
    return spark.sql(text, args=dict(args) if args else None, **frames)


# Read limits of the original jobs (fixed values): 5 s to connect, 15 min per statement.
CONNECT_TIMEOUT_S = 5
STATEMENT_TIMEOUT_S = 900


def jdbc_options(url: str, table: str, user_env: str, password_env: str,
                 connect_timeout_s: int = CONNECT_TIMEOUT_S,
                 statement_timeout_s: int | None = STATEMENT_TIMEOUT_S,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")`` (SRC-4).

    Credentials come from environment variables named by the caller, never from code.
    ``connectTimeout`` is the PostgreSQL driver property (seconds); ``queryTimeout`` is Spark's
    per-statement limit (seconds, 0 = none).
    """
    opts = {
        "url": url,
        "dbtable": table,
        "user": os.environ.get(user_env, ""),
        "password": os.environ.get(password_env, ""),
        "connectTimeout": str(connect_timeout_s),
        "fetchsize": str(fetch_size),
    }
    if statement_timeout_s is not None:
        opts["queryTimeout"] = str(statement_timeout_s)
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC scan: with a numeric ``partition_column`` the read splits into
    ``num_partitions`` range queries instead of one single-threaded fetch."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
