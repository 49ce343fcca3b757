"""Validity-dated ("type 2") tables: rows valid at one date (CMP-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def effective_on(df: DataFrame, d: dt.date, from_col: str = "efftv_from_dt",
                 to_col: str = "efftv_to_dt") -> DataFrame:
    """Rows whose inclusive validity interval ``[from, to]`` contains ``d``.

    A NULL bound makes the row invalid (the comparison is NULL). ``d`` is a literal, so both
    bounds reach the parquet scan as pushed filters and no range join is needed.
    """
    lit = F.lit(d)
    return df.filter((F.col(from_col) <= lit) & (F.col(to_col) >= lit))
