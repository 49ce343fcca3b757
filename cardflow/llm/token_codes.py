"""Token files of directly addressable codes.

The ids of a segment are split into chunks of 8 bits. Level 0 holds the low chunk of every id, level k
the k-th chunk of the ids that have one. A bitmap of each level says which ids go on, and a rank
directory holds the set bits before every 512th position, so the place of a token's next chunk is
a directory entry plus a count over at most 64 bytes: any token can be read without decoding others.

A file holds segments of whole documents in ascending id order: Parquet rows of the codes with
their documents' ids and lengths, stored uncompressed so that a segment's bytes stay addressable.
Documents with a null id come first, equal ids are ordered by text. A null text is an empty one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm.common import parallelism, ship_code
from cardflow.llm.tokens import encoder

_MAGIC = b"DAC1"
_BLOCK = 64  # bytes of bitmap for each entry of the rank directory
SEGMENT_TOKENS = 1 << 19
_POPULATION = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def encode_codes(ids: np.ndarray) -> bytes:
    """Ids (unsigned 32-bit) as directly addressable codes."""
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(_POPULATION[bitmap], np.arange(0, len(bitmap), _BLOCK), dtype=np.int64) \
            if len(bitmap) else np.empty(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        levels.append(struct.pack("<I", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes()
                      + bitmap.tobytes() + ranks.tobytes())
        if not more.any():
            return _MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more] >> np.uint32(8)


class Codes:
    """Random access to the ids of a segment."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        (n_levels,) = struct.unpack_from("<I", data, 4)
        at, self.levels = 8, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<I", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            at += 4 + n
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(bitmap)
            ranks = np.frombuffer(data, "<u4", -(-len(bitmap) // _BLOCK) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            byte, bit = divmod(i, 8)
            if not bitmap[byte] >> bit & 1:
                break
            block = byte // _BLOCK
            i = int(ranks[block]) + int(_POPULATION[bitmap[block * _BLOCK:byte]].sum()) \
                + int(_POPULATION[bitmap[byte] & ((1 << bit) - 1)])
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        values = None
        for chunks, bitmap, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if values is not None:
                own[np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)] |= values << np.uint32(8)
            values = own
        return values


SEGMENTS = "part long, first long, doc_ids array<long>, n_tokens array<long>, codes binary"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 0) -> None:
    """Write the ids of all documents, each with ``end_id`` appended, in ascending id order.

    ``part`` is the range of ids a file belongs to, ``first`` the ids of that range before the segment.
    """
    tail = end_id.to_bytes(4, "little")

    def segments(batches) -> Iterator[pa.RecordBatch]:
        part, first, size = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            codes = encode_codes(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([first], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())), pa.array([codes], pa.binary())],
                names=["part", "first", "doc_ids", "n_tokens", "codes"])

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1))):
                keys.append(key)
                held.append(data + tail)
                size += len(held[-1]) // 4
                if size >= SEGMENT_TOKENS:
                    yield flush()
                    first, size, keys, held = first + size, 0, [], []
        if held:
            yield flush()

    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(parallelism(docs.sparkSession), "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"))
    ordered.select("doc_id", "text").mapInArrow(segments, SEGMENTS).write.option("compression", "uncompressed").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files."""

    def documents(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, keys, lengths, codes in zip(*(c.to_pylist() for c in batch.columns)):
                ids = Codes(codes).all().astype("<u4")
                ends = np.cumsum([0, *lengths])
                checks = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(keys), pa.int64()), pa.array(keys, pa.int64()),
                     pa.array(first + ends[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(checks, pa.int64())],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    ship_code(spark)
    files = spark.read.schema(SEGMENTS).parquet(folder)
    # one row for each range of ids: as many as the files were written with
    sizes = files.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    starts, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes.collect()):
        starts.append((part, total))
        total += n
    bases = F.broadcast(spark.createDataFrame(starts, "part long, base long"))
    rows = files.mapInArrow(documents, "part long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(bases, "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
