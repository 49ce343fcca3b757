"""Set operations and duplicate removal (SET-1, AGG-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION``: positional union, then duplicate removal (NULLs compare equal).

    Positional like SQL, so columns of different names line up by place. The distinct is a
    partial + final hash aggregate: duplicates collapse map-side before the shuffle.
    """
    return a.union(b).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT`` over every column."""
    return df.distinct()
