"""Membership filters of fixed size before joins (JON-7, RPT-1).

A day's batch is small and the history or master table it is compared with is not. A bitmap of the
batch's hashed keys has a fixed size whatever the batch, is broadcast, and drops most of the big side's
rows where they are scanned, so that only rows which may match are shuffled. A bit can be set by
another key, so the filter only ever keeps too much: the join behind it stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType,
                               TimestampType)

#: Bits in a block of Spark's bitmap functions, and blocks in a filter: 256 of 4 KB, 8 million bits.
BLOCK_BITS, BLOCKS = 32768, 256


def _place(keys: Sequence[str | Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks * BLOCK_BITS))


def filterable(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both sides have equal hashes: the same types, and none that has several
    forms of one value (floating point, collated text)."""
    plain = (ByteType, ShortType, IntegerType, LongType, DateType, TimestampType, DecimalType, BooleanType)

    def simple(t) -> bool:
        return isinstance(t, plain) or t == StringType()

    return all(a.schema[k].dataType == b.schema[k].dataType and simple(a.schema[k].dataType) for k in keys)


def key_bitmap(df: DataFrame, keys: Sequence[str], blocks: int = BLOCKS) -> DataFrame:
    """(block, bits): at most ``blocks`` rows of 4 KB that hold the hashed keys of ``df``. NULL keys are left out."""
    place = _place(keys, blocks)
    return df.dropna(subset=list(keys)).select(
        F.bitmap_bucket_number(place).alias("block"), F.bitmap_bit_position(place).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One bitmap of several: (block, bits) rows of the same block are combined."""
    return bitmaps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_membership(df: DataFrame, keys: Sequence[str], bitmap: DataFrame, name: str = "maybe",
                    blocks: int = BLOCKS) -> DataFrame:
    """``df`` with a flag: false where no key of the bitmap equals the row's, true where one may."""
    place = _place(keys, blocks)
    bits = F.broadcast(bitmap.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    joined = df.join(bits, F.bitmap_bucket_number(place) == F.col("__block"), "left")
    flag = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False)) & known
    return joined.withColumn(name, flag).drop("__block", "__bits")


def may_match(big: DataFrame, small: DataFrame, keys: Sequence[str], blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``big`` that may have a key of ``small``: tested in the scan, before any shuffle. Keys
    whose types differ, or have several forms of a value, are not tested: all rows stay."""
    flag = "__may_match"
    if not filterable(big, small, keys):
        return big
    return with_membership(big, keys, key_bitmap(small.select(*keys), keys, blocks), flag, blocks).filter(flag).drop(flag)


def unseen_rows(batch: DataFrame, history: DataFrame, match_on: Sequence[str], members: DataFrame | None = None,
                blocks: int = BLOCKS) -> DataFrame:
    """Rows of ``batch`` without a row of the same key in ``history`` (``NOT EXISTS``), duplicates kept.

    The history is filtered by the batch's bitmap as it is scanned; only keys that may be in the batch are
    made distinct, shuffled and anti joined. ``members``, a stored bitmap of the history's keys (of the same
    number of blocks), tells batch rows that are surely new; only the others are then joined at all.
    """
    keys = list(match_on)
    if members is None or not filterable(batch, history, keys):
        seen = may_match(history.select(*keys), batch, keys, blocks).distinct()
        return batch.join(seen, keys, "left_anti")
    flag = "__maybe_seen"
    tested = with_membership(batch, keys, members, flag, blocks)
    doubtful = tested.filter(flag).drop(flag)
    seen = may_match(history.select(*keys), doubtful, keys, blocks).distinct()
    return tested.filter(~F.col(flag)).drop(flag).unionByName(doubtful.join(seen, keys, "left_anti"))
