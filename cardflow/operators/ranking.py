"""Row numbering and top-1 per key (WIN-1, WIN-2, CMP-9).

PostgreSQL orders NULL as larger than any value: ``DESC`` puts NULL first and ``ASC`` puts it
last. Spark's defaults are the opposite, so every sort key here states its NULL order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.session import checkpoint_dir

_PID, _LOCAL, _OFFSET, _COUNT = "__range_pid", "__local_rn", "__rn_offset", "__rows"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_desc(c: Column | str) -> Column:
    """``c DESC`` with PostgreSQL NULL order (NULLS FIRST)."""
    return _c(c).desc_nulls_first()


def pg_asc(c: Column | str) -> Column:
    """``c ASC`` with PostgreSQL NULL order (NULLS LAST)."""
    return _c(c).asc_nulls_last()


def row_number(partition: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """``ROW_NUMBER() OVER (PARTITION BY ... ORDER BY ...)``. End ``order`` with a unique key
    when the number must be reproducible."""
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the rank-1 row per key (top-1).

    Written as ``row_number() = 1`` so Catalyst inserts a partial ``WindowGroupLimit`` before
    the shuffle: each map task forwards at most one row per key, so a key holding a large share
    of the rows does not reach one reducer whole.
    """
    rn = "__rank_num"
    return df.withColumn(rn, row_number(keys, order)).filter(F.col(rn) == 1).drop(rn)


def with_row_number(df: DataFrame, partition: Sequence[str], order: Sequence[Column], name: str = "rn",
                    num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition ORDER BY order)`` without sending any key's
    rows to one task.

    A plain window puts every row of a key in one task, so a key holding a third of the table
    is sorted by one core. Here the rows are range-partitioned on (partition keys, order keys),
    which spreads a hot key over several partitions; rows are numbered inside each
    (range partition, key) group, and each group gets the row count of the same key in earlier
    range partitions added. Within a range partition the keys are contiguous, so only its first
    key can continue from an earlier partition: the offset table has at most one row per range
    partition, which bounds its broadcast. The ranged rows are written to the checkpoint folder once with their
    partition id, and both branches read them there, so the ids agree whatever the plan; this runs
    when the frame is built. End ``order`` with a
    unique key for a reproducible numbering; give ``order`` columns an explicit NULL ordering
    (``pg_asc``/``pg_desc``).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(k).asc_nulls_first() for k in partition]
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    local = ranged.withColumn(_LOCAL, F.row_number().over(Window.partitionBy(_PID, *partition).orderBy(*order)))
    counts = ranged.groupBy(*partition, _PID).agg(F.count(F.lit(1)).alias(_COUNT))
    before = Window.partitionBy(*partition).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn(_OFFSET, F.sum(_COUNT).over(before))
               .filter(F.col(_OFFSET) > 0).drop(_COUNT))
    cond = [local[c].eqNullSafe(offsets[c]) for c in [*partition, _PID]]
    joined = local.join(F.broadcast(offsets), cond, "left")
    out = joined.select(local["*"], F.col(_OFFSET))
    return (out.withColumn(name, (F.col(_LOCAL) + F.coalesce(F.col(_OFFSET), F.lit(0))).cast("long"))
            .drop(_PID, _LOCAL, _OFFSET))
