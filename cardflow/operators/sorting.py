"""Report ordering with PostgreSQL NULL order (SRT-1, SRT-2, SRT-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardflow.operators.ranking import pg_asc


def sort_report(df: DataFrame, keys: Sequence[Column | str], output: Sequence[Column | str] | None = None) -> DataFrame:
    """Global ascending sort, NULLS LAST, optionally followed by the output projection.

    Sorting before the projection lets a key that is not in the output order the rows (SRT-2).
    The sort is a range-partitioned shuffle; part files of a write come out in global order.
    """
    out = df.orderBy(*[pg_asc(k) for k in keys])
    return out.select(*output) if output is not None else out


def exported_positions(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The rows of a Parquet export with their place, from 1, in the order of its part files.

    Places come from the files themselves: a row's index in its file plus the row counts of the files
    before it. The counts are one row a file, so their running sum is small whatever the export.
    """
    rows = spark.read.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    counts = placed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("__file", F.coalesce(before, F.lit(0)).alias("__before")))
    return placed.join(offsets, "__file").select(*rows.columns, (F.col("__before") + F.col("__index") + 1).alias(name))
