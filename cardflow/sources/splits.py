"""Planned parallel reads (SRC-4): disjoint predicates that split a table evenly by a key.

Equal steps between a least and a largest key make very uneven reads where keys are clustered, and
lose rows without a key. Here the split points are quantiles of the key, from a sketch of a table that
has the same keys (the last load, an export, a statistics table), one predicate a read, and a last one
for NULL. Every row satisfies exactly one of them, also rows that came after the sketch: the outer
ranges are open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_points(df: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list:
    """At most ``parts - 1`` distinct keys, in order, that cut the rows into even parts (a key with more than a
    part's share stays whole). One aggregate; its sketch is bounded by ``accuracy``."""
    shares = [k / parts for k in range(1, parts)]
    if not shares:
        return []
    row = df.agg(F.percentile_approx(key, shares, accuracy).alias("points")).first()
    return sorted(set(row["points"] or []))


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def split_predicates(key: str, points: Sequence) -> list[str]:
    """SQL predicates, one a read: below the first point, between neighbours, from the last on, and NULL."""
    marks = [_literal(p) for p in points]
    if not marks:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{key} < {marks[0]}", *inner, f"{key} >= {marks[-1]}", f"{key} IS NULL"]


def read_jdbc_planned(spark: SparkSession, options: Mapping[str, str], key: str, like: DataFrame, parts: int) -> DataFrame:
    """A JDBC read in ``parts`` even queries (and one for NULL keys); ``like`` holds the same keys, roughly."""
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=split_predicates(key, split_points(like, key, parts)),
                           properties=rest)
