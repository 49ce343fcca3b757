"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sizes. Every text's words are counted in one pass. Sources, in code-point order with null last,
   weigh 5, 2, 1, 5, 2, 1, ... and share ``percent`` of all words; a target over ``EPOCHS`` times its
   source's size stops there and the excess goes to the others by weight, round by round, until none is
   above. A round is one aggregate of the sources; three numbers go to the driver.
2. Blocks. The words of a source, its documents in the order of (id, size, digest), are one stream.
   Its block length is a 1024th of the stream, 256 words at most (more where the corpus or its number of
   sources would make more than ``MAX_BLOCKS`` blocks, the range of the sampler). A target is a quota of blocks; a quota over the
   stream's blocks takes every block once and the rest of it in a second pass.
3. Splitting tree. The drawn blocks of all sources fill ``shards`` output shards of equal size (a block
   more or less). A node of a binary tree over the shards holds an exact count of blocks of each source
   and deals them to its halves by a multivariate hypergeometric draw, as a shuffle of all blocks would.
   That is done twice with the same tree: on the driver for ``GROUPS`` groups of sources (at most that many
   numbers, however many sources there are), then in tasks for the sources of each group, with the
   group's count in every shard as the room to fill. Counts are exact at each step.
4. Drawing. A keyed permutation (a Feistel network walked until it lands in the range) numbers the
   blocks of a source and pass: the first quota numbers are drawn, and a shard takes consecutive
   numbers, so its blocks are disjoint from any other's and random. Everything is computed from a
   document's place in its stream, row by row: no list of blocks is made and nothing is sorted by it.
5. Local shuffle. A span's ``shuffle_key`` orders it in its shard; ``write_mix`` sorts each shard by it.

The taken words of a source miss its target by less than two of its blocks. Places in streams are
exact sums over range partitions of the order above, so reruns and other cluster sizes agree.

Odd rows: a null text has no words; a null source is a source of its own; a null id comes first in its
stream; repeated rows are documents of their own. A source without words has the target 0. An empty
table gives no rows. Columns beyond the three named are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardflow.llm.common import give_back, parallelism, per_group, ship_code, short_batches, written
from cardflow.llm.textstats import mix64, utf8
from cardflow.llm.transducer import text_counts

WEIGHTS = (5, 2, 1)
PERCENT, EPOCHS = 150, 2
SHARDS = 64
#: A block has a stream's size / STREAM_BLOCKS words, BLOCK_WORDS at most. The sampler counts below 10^9, so
#: blocks get longer where a corpus would have more than MAX_BLOCKS of full length, or its sources as many.
STREAM_BLOCKS, BLOCK_WORDS, MAX_BLOCKS = 1024, 256, 1 << 27
GROUPS = 1024
SEED = 20250601
BATCH_ROWS = 500
_KEYS = np.random.default_rng(SEED).integers(1, 2**63, 4, dtype=np.uint64)


# ---------------------------------------------------------------- 1. sizes and targets
def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, digest) of every row: its words, and a digest that settles its place among equal ids."""

    def run(batches):
        for batch in short_batches(batches, BATCH_ROWS):
            texts = utf8(batch.column(2).to_pylist())
            digest = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text_counts(texts, distinct=False)[:, 0], pa.int64()),
                 pa.array(digest, pa.binary())], names=["doc_id", "source", "size", "digest"])
        give_back()

    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.col(text).cast("string"))
    return rows.mapInArrow(run, "doc_id long, source string, size long, digest binary")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, weight): sources numbered from 0 in code-point order, null last."""
    spark = sizes.sparkSession
    by_name = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    placed = written(by_name.repartitionByRange(parallelism(spark), *order).withColumn("part", F.spark_partition_id()),
                     "mix-names")
    within = placed.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    # one row a range partition
    before = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "offset")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("rank", F.lit(len(WEIGHTS))) + 1).cast("int"))
    return within.join(F.broadcast(before), "part").withColumn("rank", (F.col("place") + F.col("offset")).cast("long")).select(
        "source", "rank", "source_size", weight.cast("long").alias("weight"))


def with_targets(sources: DataFrame, percent: float = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` with ``target``: shares by weight of ``percent`` of all words, none above ``epochs`` times
    its source's size. The share of a unit of weight rises as sources reach their limit."""
    limit = F.col("source_size") * epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = total * percent / 100
    unit = 0.0
    while True:  # each round sees at least one more source at its limit
        below = limit > F.lit(unit) * F.col("weight")
        row = sources.agg(F.sum(F.when(below, F.col("weight"))).alias("weight"),
                          F.sum(F.when(~below, limit)).alias("full")).first()
        rest = budget - (row["full"] or 0)
        again = rest / row["weight"] if row["weight"] else unit
        if again <= unit:
            break
        unit = again
    target = F.least(limit.cast("double"), F.lit(float(unit)) * F.col("weight"))
    return sources.withColumn("target", target)


def with_quotas(targets: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``targets`` with block, blocks (of the stream) and quota (blocks to draw, repeats counted)."""
    row = targets.agg(F.sum("source_size").alias("words"), F.count(F.lit(1)).alias("sources")).first()
    longest = max(BLOCK_WORDS, -(-(row["words"] or 0) // MAX_BLOCKS))
    most = min(STREAM_BLOCKS, max(1, MAX_BLOCKS // max(1, row["sources"])))
    block = F.greatest(F.lit(1), F.least(F.lit(longest), F.floor(F.col("source_size") / most))).cast("long")
    with_blocks = targets.withColumn("block", block).withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")))
    quota = F.least(F.round(F.col("target") / F.col("block")).cast("long"), F.col("blocks") * epochs)
    return with_blocks.withColumn("quota", quota)


# ---------------------------------------------------------------- 3. the splitting tree
def split_tree(counts: np.ndarray, room: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A matrix (kinds, shards) with row sums ``counts`` and column sums ``room``, drawn as a shuffle of
    all blocks over the shards would give it: the shards are halved and halved again, and the blocks of
    a half are a multivariate hypergeometric draw from those of the whole."""
    out = np.zeros((len(counts), len(room)), dtype=np.int64)
    todo = [(0, len(room), np.asarray(counts, dtype=np.int64))]
    while todo:
        low, high, held = todo.pop()
        if high - low == 1:
            out[:, low] = held
            continue
        middle = (low + high) // 2
        left = rng.multivariate_hypergeometric(held, int(room[low:middle].sum()), method="marginals")
        todo += [(low, middle, left), (middle, high, held - left)]
    return out


def shard_quotas(sources: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, ends): for every source the running count of its drawn blocks after each shard."""
    spark = sources.sparkSession
    grouped = sources.select("rank", "quota", F.pmod("rank", F.lit(GROUPS)).alias("group"))
    totals = sorted(grouped.groupBy("group").agg(F.sum("quota")).collect())  # GROUPS rows at most
    everything = sum(n for _, n in totals)
    room = np.array([everything * (k + 1) // shards - everything * k // shards for k in range(shards)], dtype=np.int64)
    matrix = split_tree(np.array([n for _, n in totals], dtype=np.int64), room, np.random.default_rng(seed))
    rooms = spark.createDataFrame([(g, row.tolist()) for (g, _), row in zip(totals, matrix)], "group long, room array<long>")

    def deal(group: pa.Table) -> pa.RecordBatch:
        group = group.sort_by("rank")
        number = group.column("group")[0].as_py()
        dealt = split_tree(group.column("quota").to_numpy(), np.array(group.column("room")[0].as_py(), dtype=np.int64),
                           np.random.default_rng([seed, number]))
        ends = np.cumsum(dealt, axis=1)
        flat = pa.array(ends.reshape(-1))
        starts = pa.array(np.arange(0, ends.size + 1, shards, dtype=np.int32))
        return pa.RecordBatch.from_arrays([group.column("rank").combine_chunks(), pa.ListArray.from_arrays(starts, flat)],
                                          names=["rank", "ends"])

    return per_group(grouped.join(F.broadcast(rooms), "group").select("rank", "quota", "group", "room"), "group", deal,
                     "rank long, ends array<long>")


# ---------------------------------------------------------------- 2. streams
def streams(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``start``: the words before a document in its source's stream."""
    spark = sizes.sparkSession
    order = [F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("digest")]
    ranged = (sizes.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id()))

    def place(batches):
        name, total, started = None, 0, False
        for batch in batches:
            names = batch.column("source").to_pylist()
            size = batch.column("size").to_numpy()
            start = np.empty(len(size), dtype=np.int64)
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if not started or names[a] != name:
                    name, total, started = names[a], 0, True
                ends = np.cumsum(size[a:b]) + total
                start[a:b] = ends - size[a:b]
                total = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "size", "part")), pa.array(start)],
                                             names=["doc_id", "source", "size", "part", "local"])

    local = written(ranged.select("doc_id", "source", "size", "part").mapInArrow(
        place, "doc_id long, source string, size long, part int, local long"), "mix-streams")
    sums = local.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only the first source of a part can go on from an earlier part: at most one row a range partition
    offsets = F.broadcast(sums.withColumn("offset", F.sum("words").over(before)).filter("offset > 0").select(
        F.col("source").alias("name"), F.col("part").alias("at"), "offset"))
    return local.join(offsets, (local["part"] == offsets["at"]) & local["source"].eqNullSafe(offsets["name"]), "left").select(
        "doc_id", "source", "size", (F.col("local") + F.coalesce("offset", F.lit(0))).alias("start"))


# ---------------------------------------------------------------- 4. drawing
def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0 .. n - 1, one for each ``key``, applied to ``x`` (arrays of one length)."""
    x, n, key = (np.asarray(a).astype(np.uint64) for a in (x, n, key))
    bits = np.ceil(np.log2(np.maximum(n, np.uint64(2)).astype(np.float64)) / 2).astype(np.uint64)
    bits = np.maximum(bits, np.uint64(1))
    mask = (np.uint64(1) << bits) - np.uint64(1)

    def network(v: np.ndarray, at: np.ndarray) -> np.ndarray:
        left, right = v >> bits[at], v & mask[at]
        for k in _KEYS:
            left, right = right, left ^ (mix64(right + mix64(key[at] ^ k)) & mask[at])
        return (left << bits[at]) | right

    out = x.copy()
    todo = np.arange(len(x))
    while len(todo):  # the network permutes a range of at most 4 n; walk on until the value is below n
        out[todo] = network(out[todo], todo)
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _drawn(batch: pa.RecordBatch, epochs: int) -> pa.Array:
    """The drawn spans of each document: pass, block, draw (number among the source's draws), from, to."""
    start, size, block, blocks, quota, rank = (batch.column(c).to_numpy() for c in ("start", "size", "block", "blocks", "quota", "rank"))
    first = start // block
    n = np.where(size > 0, (start + size - 1) // block - first + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    number = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    low = np.maximum(number * block[row], start[row]) - start[row]
    high = np.minimum((number + 1) * block[row], (start + size)[row]) - start[row]
    parts = []
    for epoch in range(epochs):
        draw = permuted(number, blocks[row], rank[row] * epochs + epoch) + epoch * blocks[row]
        taken = np.flatnonzero(draw < quota[row])
        parts.append((row[taken], np.full(len(taken), epoch, np.int32), number[taken], draw[taken], low[taken], high[taken]))
    row, epoch, number, draw, low, high = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[order], np.arange(len(n) + 1)).astype(np.int32)
    columns = [pa.array(x[order]) for x in (epoch, number, draw, low, high)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=["pass", "block", "draw", "from", "to"]))


SPAN = "array<struct<pass:int,block:long,draw:long,from:long,to:long>>"


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", percent: float = PERCENT,
          epochs: int = EPOCHS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, spans): one row for each row of ``docs``.

    ``spans`` are the word ranges that the mix takes of the document: pass, block, from, to (exclusive),
    the shard that gets them and their shuffle_key there; ``taken`` counts their words.
    """
    sizes = written(sized(docs, doc_id, text, source), "mix-sizes")
    sources = written(with_quotas(with_targets(written(ranked_sources(sizes), "mix-sources"), percent, epochs), epochs), "mix-targets")
    ends = written(shard_quotas(sources, shards, seed), "mix-shards")
    info = sources.withColumnRenamed("source", "name")
    placed = streams(sizes)
    known = placed.join(info, placed["source"].eqNullSafe(info["name"])).drop("name", "weight")

    def draw(batches):
        for batch in short_batches(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, _drawn(batch, epochs)], names=[*batch.schema.names, "drawn"])
        give_back()

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.schema.fields)
    drawn = known.mapInArrow(draw, f"{columns}, drawn {SPAN}").join(ends, "rank")
    spans = F.expr(f"""transform(drawn, s -> struct(
        s.pass as pass, s.block as block, s.from as from, s.to as to,
        cast(size(filter(ends, e -> e <= s.draw)) as int) as shard,
        xxhash64({seed}L, rank, s.pass, s.block, doc_id, s.from) as shuffle_key))""")
    taken = F.expr("aggregate(drawn, 0L, (a, s) -> a + s.to - s.from)")
    return drawn.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), spans.alias("spans"))


def write_mix(mix: DataFrame, folder: str, shards: int = SHARDS) -> None:
    """The spans as ``shards`` folders of Parquet (``shard=k``), each in its shuffled order."""
    spans = mix.select("doc_id", "source", F.explode("spans").alias("span")).select("doc_id", "source", "span.*")
    spans.repartition(shards, "shard").sortWithinPartitions("shard", "shuffle_key").write.partitionBy("shard").parquet(folder)


def read_mix(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)
