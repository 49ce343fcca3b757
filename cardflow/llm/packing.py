"""Packing by minimum bin slack.

A document of n ids gives n // capacity full windows and a remainder. Remainders of equal length are
interchangeable, so the packing problem is the histogram of their lengths: at most capacity - 1
numbers, counted by Spark. The plan is made from it: the longest length left opens a window, a
bitset subset-sum over the multiset of lengths left finds the fill closest to capacity, backtracking
gives the counts of each length, and the pattern is repeated as often as the counts allow. Each
pattern uses up a length, so there are fewer patterns than lengths whatever the number of documents.

Each remainder then gets a rank among those of its length (two steps: within a salted part, plus
the parts before), and rank and plan give its window and offset by arithmetic.

A null text is an empty one: one piece that holds the end id alone. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardflow.llm.common import arrow_rows, give_back, ship_code, written
from cardflow.llm.tokens import CACHE_CHUNKS, SLICE_BYTES, encoder

CAPACITY = 2048
#: Parts of each length for ranking: at least SALTS, and one for each SALT_ROWS pieces.
SALTS, SALT_ROWS = 64, 100_000


@dataclass(frozen=True)
class Pattern:
    """A window filled with ``counts[length]`` remainders of each length, ``times`` times."""

    counts: dict[int, int]
    times: int


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths within ``counts`` whose sum is closest to ``room`` from below."""
    reach = 1
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # (length, copies, sums reachable before)
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up the histogram of lengths."""
    left = {k: n for k, n in histogram.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        fill = closest_fill(left, capacity - longest)
        left[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        times = min(left[k] // m for k, m in fill.items())
        plan.append(Pattern(fill, times))
        for k, m in fill.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
    return plan


def plan_rows(plan: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies a window, first window, offset) of each part of a plan."""
    used: dict[int, int] = {}
    rows, window = [], 0
    for pattern in plan:
        offset = 0
        for length in sorted(pattern.counts, reverse=True):
            copies = pattern.counts[length]
            first = used.get(length, 0)
            used[length] = first + copies * pattern.times
            rows.append((length, first, used[length], copies, window, offset))
            offset += length * copies
        window += pattern.times
    return rows


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1,
           capacity: int = CAPACITY, cache_chunks: int = CACHE_CHUNKS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row for each piece: full windows and the remainder of each document. ``row`` is unique."""
    tail = end_id.to_bytes(4, "little")

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[list[int | None]] = [[] for _ in range(6)]
            ids = batch.column(0).to_pylist()
            for key, data in zip(ids, encoder(tokenizer, cache_chunks, slice_bytes).encode(batch.column(1))):
                data += tail
                n = len(data) // 4
                for start in range(0, n, capacity):
                    part = data[4 * start:4 * (start + capacity)]
                    for column, value in zip(out, (key, start, len(part) // 4, zlib.crc32(part), n, row)):
                        column.append(value)
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=[f.split()[0] for f in PIECES.split(", ")])
        give_back()

    ship_code(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, PIECES)


def ranked(parts: DataFrame, total: int) -> DataFrame:
    """``parts`` with ``rank`` (from 0) among the pieces of equal length, without gaps."""
    salts = max(SALTS, total // SALT_ROWS)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    within = Window.partitionBy("length", "salt").orderBy("row")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    local = salted.withColumn("rank", F.row_number().over(within) - 1)
    return local.join(firsts, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("first")).drop("first", "salt")


def plan_table(spark: SparkSession, rows: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """The rows of a plan. From an Arrow table, as a list would start Python workers of its own on the executors."""
    names = ["length", "first_rank", "end_rank", "copies", "window", "at"]
    columns = zip(*rows) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=names))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1,
         capacity: int = CAPACITY, cache_chunks: int = CACHE_CHUNKS, slice_bytes: int = SLICE_BYTES,
         batch_rows: int | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row a piece. ``batch_rows``: documents
    that a worker is handed at a time at most."""
    spark: SparkSession = docs.sparkSession
    with arrow_rows(spark, batch_rows):
        parts = written(pieces(docs, tokenizer, doc_id, text, end_id, capacity, cache_chunks, slice_bytes), "packing-pieces")
    histogram = {int(r[0]): int(r[1]) for r in parts.groupBy("length").count().collect()}  # <= capacity rows
    rows = plan_rows(minimum_bin_slack(histogram, capacity))
    # at most capacity patterns of at most sqrt(2 * capacity) distinct lengths: a bounded table
    plan = F.broadcast(plan_table(spark, rows))
    placed = ranked(parts, sum(histogram.values())).join(
        plan, "length").filter("rank >= first_rank and rank < end_rank")
    relative = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("window") + F.floor(relative / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(relative, F.col("copies")) * F.col("length")).cast("long").alias("offset"))
