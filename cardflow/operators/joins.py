"""Joins used by the reports (JON-1..JON-10).

No join here forces a broadcast of a side that can grow: Spark broadcasts a side only when its
size statistics are under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks the
measured shuffle size at run time. Only ``broadcast_fixed`` hints, for tables built from a
Python literal whose size is known when the job is written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.operators.ranking import latest_per_key
from cardflow.operators.temporal import effective_on

On = str | Sequence[str] | Column


def broadcast_fixed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table (e.g. a decode table) with a broadcast hint.

    Its size is fixed by the code that builds it, so the hint cannot outgrow memory.
    """
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def inner_join(a: DataFrame, b: DataFrame, on: On) -> DataFrame:
    """Inner equi join (JON-1). Pass a ``Column`` condition for keys that need a cast."""
    return a.join(b, on, "inner")


def left_join(a: DataFrame, b: DataFrame, on: On, many: bool = False) -> DataFrame:
    """Left outer equi join on one or more keys (JON-2). Restrict ``b`` first for ``ON``
    predicates on the right side (JON-3); Catalyst pushes them into ``b``'s scan.

    ``many=True`` when ``b`` can hold many rows per key (a fact table on the right): the join
    is then planned so that a hot key on ``b`` can be split (see ``left_join_many``). Needs
    ``on`` as column names.
    """
    if many:
        return left_join_many(a, b, [on] if isinstance(on, str) else list(on))
    return a.join(b, on, "left")


def left_join_many_parts(left: DataFrame, right: DataFrame, on: Sequence[str],
                         right_keys: DataFrame | None = None, hot: DataFrame | None | str = "auto",
                         salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The two disjoint halves of ``left_join_many``: (matched rows, unmatched left rows with
    the right side's columns NULL). Their key sets are disjoint, so per-key work after the
    join (such as a ``DISTINCT``) can run on each half separately.

    Keys holding very many ``right`` rows (``skew.hot_keys``; ``hot="auto"`` detects them with
    one small aggregate, a DataFrame gives them, ``None`` skips salting) are salted in the
    matched half: adaptive execution splits a skewed join only when both inputs come straight
    from a shuffle, which a join in a chain of joins does not.
    """
    from cardflow.operators.skew import hot_keys, salted_join

    keys = list(on)
    matched = left.join(right, keys, "inner")
    if isinstance(hot, str):
        hot = hot_keys(right.select(*keys), keys)
    if hot is not None:
        matched = salted_join(right, left, keys, "inner", hot, salts).select(*matched.columns)
    probe = (right if right_keys is None else right_keys).select(*keys).distinct()
    unmatched = left.join(probe, keys, "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in keys]
    return matched, unmatched.select("*", *nulls).select(*matched.columns)


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str],
                   right_keys: DataFrame | None = None, hot: DataFrame | None | str = "auto") -> DataFrame:
    """Left outer join for a right side that may hold many rows per key, hot keys included.

    Adaptive execution splits an oversized partition of a sort-merge join only on a side it
    may duplicate: either side of an inner join, but only the preserved side of an outer one.
    So where a key is hot (one aggregate over the key columns of ``right`` tells; ``hot=None``
    skips it), the join is written as the inner join (a hot key on ``right`` is split into several
    tasks) plus the left rows without a match (an anti join, which never builds the key's
    rows), with the right side's columns NULL. Same rows as ``left.join(right, on, "left")``.

    ``right_keys`` may give a cheaper relation with the same keys as ``right`` (for instance
    the driving table of ``right``'s own left joins) so the anti join does not recompute it.
    Where the plan leaves the join unsplittable, hot keys are salted (see
    ``left_join_many_parts``).
    """
    from cardflow.operators.skew import hot_keys

    if isinstance(hot, str):
        hot = hot_keys(right.select(*on), on)
    if hot is None:  # nothing is hot: one plain join, each side read once
        return left.join(right, list(on), "left")
    matched, unmatched = left_join_many_parts(left, right, on, right_keys, hot)
    return matched.unionByName(unmatched)


def left_join_effective(a: DataFrame, b: DataFrame, on: On, d: dt.date,
                        from_col: str = "efftv_from_dt", to_col: str = "efftv_to_dt", many: bool = False) -> DataFrame:
    """Point-in-time left join (JON-4): key equality and ``from <= d <= to`` on ``b``.

    ``d`` is one date for the whole job, so ``b`` is filtered to the rows valid at ``d`` and
    joined on the keys alone: an equi join, not a per-row range join.
    """
    return left_join(a, effective_on(b, d, from_col, to_col), on, many)


def left_join_latest(a: DataFrame, b: DataFrame, on: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join to the rank-1 row of ``b`` per key (JON-9)."""
    return left_join(a, latest_per_key(b, on, order), list(on))


def overlay(spine: DataFrame, primary: DataFrame, secondary: DataFrame, on: Sequence[str],
            many: bool = False) -> DataFrame:
    """A key spine left-joined to two sources on the same key (JON-10).

    Both joins share the key, so the spine's hash partitioning is reused by the second join.
    Give the two sources distinct column names (apart from ``on``) before calling. With
    ``many=True`` the secondary may hold many rows per key (hot keys included).
    """
    keys = list(on)
    return left_join(spine.join(primary, keys, "left"), secondary, keys, many)


def anti_join(a: DataFrame, b: DataFrame, on: On) -> DataFrame:
    """Correlated ``NOT EXISTS`` on keys (JON-7). NULL keys on either side never match.

    With key names, only ``b``'s distinct keys are shuffled: the partial aggregate collapses a
    key repeated many times in ``b`` before the exchange, which the join then reuses.
    """
    if isinstance(on, Column):
        return a.join(b, on, "left_anti")
    keys = [on] if isinstance(on, str) else list(on)
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def exclude_listed(df: DataFrame, key: str, listing: DataFrame, listing_key: str | None = None) -> DataFrame:
    """Null-aware ``key NOT IN (SELECT listing_key FROM listing)`` (JON-8, CMP-11).

    SQL semantics: an empty listing keeps every row (NULL keys too); a listing holding one NULL
    keeps no row; otherwise rows with a NULL key drop and the rest are an anti join.

    Spark would plan a single-column ``NOT IN`` as a null-aware *broadcast* anti join whatever
    the listing's size. Here the two NULL cases are scalar subqueries (two numbers) of the same plan that
    filter ``df`` before a plain anti join, which Spark broadcasts only when the listing is measured
    small and otherwise shuffles, so the listing may grow without bound. Nothing runs while the frame is
    built, so it follows what the listing holds when it runs.
    """
    lk = listing_key or key
    listed = listing.agg(F.count(F.lit(1)).alias("n")).scalar()
    non_null = listing.agg(F.count(F.col(lk)).alias("k")).scalar()
    keys = listing.select(F.col(lk).alias("__listed_key")).distinct()
    probe = df.filter((listed == 0) | ((listed == non_null) & F.col(key).isNotNull()))
    return probe.join(keys, probe[key] == keys["__listed_key"], "left_anti")


def decode_join(df: DataFrame, key: str, mapping: Mapping[str, str], out: str, default=None) -> DataFrame:
    """Decode ``key`` to ``out`` by a left join to a broadcast mapping table (PRJ-6).

    The mapping is a Python literal (fixed size), so the broadcast is bounded. A NULL or unknown
    key gets ``default``.
    """
    spark = df.sparkSession
    table = broadcast_fixed(spark, list(mapping.items()), f"__decode_key string, {out} string")
    joined = df.join(table, df[key] == table["__decode_key"], "left").drop("__decode_key")
    if default is None:
        return joined
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
