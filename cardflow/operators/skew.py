"""Hot-key detection and salted joins.

Adaptive execution splits a skewed join only when both of its inputs come straight from a
shuffle. When a join reuses the partitioning of an earlier join or aggregate (the cheaper plan,
which Catalyst picks), a key holding a large share of the rows ends up in one task. A salted
join spreads such keys explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.session import checkpoint_dir

_SALT, _ROWS, _ROW = "__salt", "__rows", "__row"


#: Hash buckets whose counts find heavy keys; rows of a hot key that one task of a salted join takes.
BUCKETS, ROWS_PER_SALT, LEAST_SALTS = 65_536, 100_000, 8


def hot_keys(df: DataFrame, keys: Sequence[str], max_keys: int = 1000,
             min_rows: int | None = None) -> DataFrame | None:
    """Keys of ``df`` holding more than ``max(min_rows, rows / max_keys)`` rows, or ``None``
    when there is none. ``min_rows`` defaults to a task's even share of the rows (and 10,000 at
    least): a smaller key can't make a task much longer than the others.

    Two steps, both exact. Rows are counted by 65,536 hash buckets of their key: at most that many numbers
    leave a task and reach the driver, however many keys there are. A hot key makes its bucket heavy,
    so if no bucket is, none is hot and that is all. Else the rows of heavy buckets alone (fewer than
    ``max_keys`` buckets can be heavy) are counted by key. Fewer than ``max_keys`` keys can each hold more than
    ``rows / max_keys`` rows, so the result has a proven size bound and may be broadcast.
    """
    present = df.dropna(subset=list(keys))  # a NULL key matches nothing: never a reason to salt
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    counts = present.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias(_ROWS)).collect()  # BUCKETS rows at most
    total = sum(r[_ROWS] for r in counts)
    if min_rows is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        min_rows = max(10_000, -(-total // tasks))
    threshold = max(min_rows, -(-total // max_keys))
    heavy = sorted(r["bucket"] for r in counts if r[_ROWS] > threshold)
    if not heavy:
        return None
    hot = (present.filter(bucket.isin(heavy)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
           .filter(F.col(_ROWS) > threshold).select(*keys))
    return None if hot.isEmpty() else hot


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
                hot: DataFrame | None = None, salts: int | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` (``how`` is ``inner`` or ``left``) with hot keys spread.

    The rows of ``big`` are dealt with in three parts, told apart by a broadcast of the hot keys without a
    shuffle. Rows of a hot key get a salt in ``[0, salts)`` from their row id, so identical rows get
    different ones too, and rows of ``small`` with a hot key are copied once per salt: the join on (keys, salt)
    spreads a hot key over ``salts`` tasks. Rows with a NULL key match nothing and meet no join. All others
    are joined plainly. Only the hot rows are written: to the checkpoint folder with their row ids when
    the frame is built, so a retried task reads the ids that the lost one had (numbered anew, rows out
    of a shuffle could change places and salts, and be lost or doubled).

    ``hot`` defaults to ``hot_keys(big, keys)`` and has fewer than its ``max_keys`` rows; pass it when several
    joins share the same hot keys. ``salts`` defaults to one per ``ROWS_PER_SALT`` hot rows, 8 at least and four times the shuffle
    partitions at most. When no key is hot this is the plain join and nothing is written.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins with the big side on the left")
    keys = list(keys)
    hot = hot_keys(big, keys) if hot is None else hot
    if hot is None:  # nothing is hot: the plain join keeps the cheaper co-partitioned plan
        return big.join(small, keys, how)
    spark = big.sparkSession
    checkpoint_dir(spark)
    marks = F.broadcast(hot.select(*keys).distinct().checkpoint(eager=True))
    placed = big.join(marks, keys, "left_semi").withColumn(_ROW, F.monotonically_increasing_id()).checkpoint(eager=True)
    if salts is None:
        most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        salts = max(LEAST_SALTS, min(most, -(-placed.count() // ROWS_PER_SALT)))
    salt = F.pmod(F.xxhash64(_ROW), F.lit(salts)).cast("long")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    spread = (placed.withColumn(_SALT, salt).drop(_ROW)
              .join(small.join(marks, keys, "left_semi").withColumn(_SALT, copies), [*keys, _SALT], how).drop(_SALT))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    plain = big.filter(known).join(marks, keys, "left_anti").join(small.join(marks, keys, "left_anti"), keys, how)
    out = spread.unionByName(plain.select(*spread.columns))
    if how == "left":
        taken = [f for f in small.schema.fields if f.name not in keys]
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in taken]
        out = out.unionByName(big.filter(~known).select("*", *nulls).select(*spread.columns))
    return out
