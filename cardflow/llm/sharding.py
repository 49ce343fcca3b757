"""Shard placement by a permutation-filled lookup table, in DataFrame functions alone.

Each shard orders the slots of a prime-sized table by its own permutation (offset and skip from
hashes of its name). The shards take turns: a turn claims the first slot of that order that is still free.
The table is as large as it is whatever the number of rows, so it is broadcast, and placing a row is
one hash and one look-up. Shards get equal parts up to one slot (times their weight: turns a
round), and when a shard is added or removed nearly all other keys stay where they are.

A null key is placed by the hash of the ``spread`` columns, so that many rows without a key don't
meet in one shard; equal keys always share a shard, repeated rows too. Columns of the input that are named
like the two new ones are replaced by them, the key included; all others are kept whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import unused

#: Slots of the table: a prime, and the bound of what is broadcast.
SLOTS = 65_537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Mapping[str, int] | Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. ``shards``: names, or names with the turns each has in a round."""
    turns = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    names = [n for n in sorted(turns) if turns[n] > 0]
    if not names:
        raise ValueError("no shard with a positive weight")
    if not is_prime(slots) or slots < len(names):
        raise ValueError("the number of slots must be a prime, and at least that of the shards")
    at = {n: _number(f"{n}/offset") % slots for n in names}
    skip = {n: _number(f"{n}/skip") % (slots - 1) + 1 for n in names}
    table: list[str | None] = [None] * slots
    left = slots
    while left:
        for name in names:
            for _ in range(turns[name]):
                if not left:
                    return table
                while table[at[name]] is not None:
                    at[name] = (at[name] + skip[name]) % slots
                table[at[name]] = name
                left -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the number of slots."""
    digest = F.md5(key.cast("string").cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(df: DataFrame, key: str, shards: Mapping[str, int] | Sequence[str], spread: Sequence[str] = (),
          slots: int = SLOTS, name: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with the columns ``slot`` and ``name``; no shuffle."""
    table = lookup_table(shards, slots)
    spark = df.sparkSession
    at, own = unused(df, "__slot"), unused(df, "__shard")
    entries = F.broadcast(spark.createDataFrame(list(enumerate(table)), f"{at} long, {own} string"))
    other = F.concat_ws("\x1f", *[F.coalesce(F.md5(F.col(c).cast("string").cast("binary")), F.lit("")) for c in spread]) \
        if spread else F.lit("")
    placed = df.withColumn(at, slot_of(F.coalesce(F.col(key).cast("string"), other), slots)).join(entries, at)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (slot.lower(), name.lower())]
    return placed.select(*kept, F.col(at).alias(slot), F.col(own).alias(name))
