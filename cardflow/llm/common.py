"""Helpers shared by the operators: scratch tables, table access, grouping of sorted Arrow rows."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.session import scratch_path


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``), so that Python
    tasks can import it however the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="cardflow-code-"), "cardflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; it is removed when the application ends."""
    folder = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: the lineage ends there, and
    the rows survive the loss of any executor."""
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.parquet(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    back.scratch_folder = folder
    return back


def discard(table: DataFrame) -> None:
    """Remove a ``written`` table whose readers have all been written themselves."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of 4 KB in a bitmap of hashed keys.
BITMAP_ROWS = 256


def _marked(df: DataFrame, key: str, wanted: DataFrame, rows: int) -> tuple[DataFrame, str]:
    """``df`` with a column, and its name: whether the hash of its long ``key`` is that of a key of ``wanted``.

    The hashed keys of ``wanted`` are a bitmap of fixed size (``rows`` times 4 KB, broadcast), however
    many there are. It never misses a key; the fuller it is, the more others it lets through.
    """
    hashed = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(rows * 32768))  # shorter integers hash otherwise
    bucket, place = F.bitmap_bucket_number(hashed), F.bitmap_bit_position(hashed)
    number, bitmap, mark = (unused(df, name) for name in ("__bucket", "__bits", "__likely"))
    bits = F.broadcast(wanted.select(bucket.alias(number), place.alias("__place")).groupBy(number).agg(
        F.bitmap_construct_agg("__place").alias(bitmap)))
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False)) & F.col(key).isNotNull()
    return df.join(bits, bucket == F.col(number), "left").withColumn(mark, likely).drop(number, bitmap), mark


def likely_in(df: DataFrame, key: str, wanted: DataFrame, rows: int = BITMAP_ROWS) -> DataFrame:
    """``df`` without most of the rows whose long ``key`` is not among those of ``wanted``: tested before a
    join shuffles ``df``."""
    marked, mark = _marked(df, key, wanted, rows)
    return marked.filter(F.col(mark)).drop(mark)


def unlikely_in(df: DataFrame, key: str, wanted: DataFrame, rows: int = BITMAP_ROWS) -> DataFrame:
    """The other rows of ``df``: none has a ``key`` (null included) of ``wanted``."""
    marked, mark = _marked(df, key, wanted, rows)
    return marked.filter(~F.col(mark)).drop(mark)


def give_back() -> None:
    """Hand the memory that a finished task no longer uses back to the system: Python workers live on
    and go over to other stages, where what earlier ones have left adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """What is run within it hands rows to Python workers at most ``rows`` at a time (``None``: as the session has it).

    A batch is held whole by the executor's JVM, outside its heap, and by the worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows is not None and not 0 < int(before) <= rows:  # none or a negative number: no bound
        spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def short_batches(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``rows`` and none empty: little is held, and sent, at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def consecutive_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key as one table, from batches that are sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def per_group(df: DataFrame, key: str, fn: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each ``key`` (a non-null long). Callers bound the group size."""

    def run(batches):
        for group in consecutive_groups(batches, key):
            out = fn(group)
            if out is not None and out.num_rows:
                yield out
        give_back()

    ship_code(df.sparkSession)
    n = parallelism(df.sparkSession)
    return df.repartition(n, key).sortWithinPartitions(key).mapInArrow(run, schema)
