"""Exactly-once incremental loads (SNK-1, SNK-2, CMP-5): a log of loads kept in the target.

A load has an id. Its rows are written to a hidden folder of the target first; then its log entry
(state, row count, file names) appears by one rename; then its files are renamed into the target
under names fixed by the entry; then the entry becomes final by another rename:

    _loads/<id>/...             rows being written: worth nothing until the entry exists
    _load_log/<id>.staged       rows complete, files may be half moved: rolled forward by whoever loads next
    _load_log/<id>.done         every file in place

A load that crashes before its entry is computed anew; one that crashes after it is finished from the
staged files, never computed again. Every file is published by one rename to a fixed name, so doing
it twice, or by two jobs at once, changes nothing. A load whose id is done only reports.

Rows are handed on from a load's own files, so a report has the rows which that load inserted, not those of
other loads of the same date. Data files lie in the target as any append leaves them, so
plain readers see them; ``committed`` leaves out those of loads that aren't done yet. Loads of one
target are meant to run one at a time (two that read the same history could both take a key as new).
A target without rows or folder is an empty history. The batch's columns that aren't named are dropped.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardflow.operators.membership import filterable, key_bitmap, merged_bitmaps, unseen_rows
from cardflow.sinks.files import Folder
from cardflow.sinks.tables import is_path, read_target, stamp_rows

STAGED, DONE = "staged", "done"


@dataclass(frozen=True)
class Load:
    load_id: str
    state: str
    rows: int
    load_date: str | None
    files: tuple[str, ...]


def table_folder(spark: SparkSession, target: str) -> str:
    """The folder of a target: itself, or where a catalog table of files lies."""
    if is_path(target):
        return target
    rows = spark.sql(f"DESCRIBE FORMATTED {target}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


class LoadLog:
    """The loads of one target (a folder or a catalog table of Parquet files)."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target
        self.folder = Folder(spark, table_folder(spark, target))

    def loads(self) -> dict[str, Load]:
        """Every logged load by id; a final entry stands before the staged one that it came from."""
        found: dict[str, Load] = {}
        for name in self.folder.names("_load_log"):
            load_id, _, state = name.rpartition(".")
            if state == DONE or state == STAGED and load_id not in found:
                entry = self.folder.read_json(f"_load_log/{name}")
                found[load_id] = Load(load_id, state, entry["rows"], entry["load_date"], tuple(entry["files"]))
        return found

    def stage(self, df: DataFrame, load_id: str, load_date: dt.date | None = None,
              partition_by: Sequence[str] = ()) -> None:
        """Write the rows of a load aside and log them. The row count comes from the write itself."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", load_id):
            raise ValueError(f"not a load id: {load_id!r}")
        place = f"_loads/{load_id}"
        seen = Observation(f"load_{load_id}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*partition_by).parquet(
            self.folder.path(place).toString())
        files = sorted(self.folder.files(place))
        self.folder.write_json(f"_load_log/{load_id}.{STAGED}", {
            "rows": int(seen.get["rows"]), "load_date": load_date.isoformat() if load_date else None, "files": files})

    def _published(self, load_id: str, file: str) -> str:
        before, _, leaf = file.rpartition("/")
        return f"{before}/load-{load_id}-{leaf}".lstrip("/")

    def publish(self, load_id: str, most: int | None = None) -> None:
        """Move the files of a staged load into the target and make its entry final. ``most`` stops
        after that many files, as a crash would."""
        load = self.loads()[load_id]
        if load.state == DONE:
            return
        for k, file in enumerate(load.files):
            if k == most:
                return
            new = self._published(load_id, file)
            if not self.folder.rename(f"_loads/{load_id}/{file}", new) and not self.folder.exists(new):
                raise OSError(f"load {load_id}: {file} is neither staged nor published")
        entry = {"rows": load.rows, "load_date": load.load_date, "files": list(load.files)}
        if self.folder.write_json(f"_load_log/{load_id}.{DONE}", entry):
            self.folder.delete(f"_load_log/{load_id}.{STAGED}")
            self.folder.delete(f"_loads/{load_id}")
        if not is_path(self.target):
            if any(c.isPartition for c in self.spark.catalog.listColumns(self.target)):
                self.spark.sql(f"MSCK REPAIR TABLE {self.target}")
            self.spark.catalog.refreshTable(self.target)

    def recover(self) -> list[str]:
        """Finish the loads that were logged but not completed; returns their ids."""
        open_loads = [load.load_id for load in self.loads().values() if load.state == STAGED]
        for load_id in open_loads:
            self.publish(load_id)
        return open_loads

    def rows_of(self, load_id: str, schema: StructType) -> DataFrame:
        """The rows that a finished load inserted, read from its own files."""
        files = [f"{self.folder}/{self._published(load_id, f)}" for f in self.loads()[load_id].files]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", str(self.folder)).parquet(*files)

    def committed(self) -> DataFrame:
        """The target without files of loads that aren't done."""
        whole = read_target(self.spark, self.target)
        half = [load.load_id for load in self.loads().values() if load.state == STAGED]
        name = F.col("_metadata.file_name")
        for load_id in half:
            whole = whole.filter(~name.startswith(f"load-{load_id}-"))
        return whole


class StoredMembers:
    """A bitmap of the keys of every row of a target, stored beside its rows after each load.

    It is merged with the keys of the next load instead of being built from the whole history again, and
    counts as valid only while the target's data files (their number and bytes) are those that it saw: rows that
    came by another way than the log make the next load build it anew.
    """

    def __init__(self, log: LoadLog, keys: Sequence[str]):
        self.log, self.keys = log, list(keys)
        self.place = "_members/" + "-".join(self.keys)

    def _seen(self) -> dict[str, int]:
        folder = self.log.folder
        sizes = [folder.fs.getFileStatus(folder.path(f)).getLen() for f in folder.files()] if folder.exists() else []
        return {"files": len(sizes), "bytes": sum(sizes)}

    def read(self) -> DataFrame | None:
        """(block, bits) of all keys, or ``None`` where the stored bitmap isn't that of the present rows."""
        folder, now = self.log.folder, self._seen()
        for name in reversed(folder.names(self.place)):
            if name.endswith(".json") and folder.read_json(f"{self.place}/{name}") == now:
                return self.log.spark.read.schema("block long, bits binary").parquet(
                    folder.path(f"{self.place}/{name.removesuffix('.json')}").toString())
        return None

    def store(self, before: DataFrame | None, loaded: DataFrame) -> None:
        """Merge the keys of a load with those before it (``None``: with all rows of the target)."""
        folder = self.log.folder
        if before is None:
            bitmap = key_bitmap(read_target(self.log.spark, self.log.target), self.keys)
        else:
            bitmap = merged_bitmaps(before.union(key_bitmap(loaded, self.keys)))
        old = folder.names(self.place)
        mark = f"{len(self.log.loads()):08d}-{self.log.spark._jvm.java.util.UUID.randomUUID()}"
        bitmap.coalesce(1).write.parquet(folder.path(f"{self.place}/{mark}").toString())  # BLOCKS rows at most
        folder.write_json(f"{self.place}/{mark}.json", self._seen())
        for name in old:
            folder.delete(f"{self.place}/{name}")


def batch_id(batch: DataFrame, load_date: dt.date) -> str:
    """An id of a batch on a date: the same rows, in whatever order, have the same id, so a retry is one."""
    h = F.xxhash64(*batch.columns)
    row = batch.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                    F.sum(F.pmod(h, F.lit((1 << 31) - 1))).alias("s")).first()
    return f"{load_date.isoformat()}-{row['n']}-{(row['x'] or 0) & (2**64 - 1):016x}-{row['s'] or 0:x}"


def load_once(batch: DataFrame, target: str, match_on: Sequence[str], columns: Sequence[str], load_date: dt.date,
              load_id: str | None = None, load_col: str = "data_load_dt") -> DataFrame:
    """Insert the batch rows whose keys the target doesn't hold, once per load id, and return the inserted rows.

    Replaying a load, after a crash or by mistake, inserts nothing more and returns the same rows. A
    load of another id returns only what it inserted itself, also on the same date. ``load_id``
    defaults to the date and a digest of the batch.
    """
    spark = batch.sparkSession
    log = LoadLog(spark, target)
    load_id = load_id or batch_id(batch, load_date)
    log.recover()
    stamped = stamp_rows(batch, load_date, load_col).select(*columns)
    if load_id not in log.loads():
        empty = not any(True for _ in log.folder.files()) if log.folder.exists() else True
        stored = StoredMembers(log, match_on)
        members = None if empty else stored.read()
        delta = batch if empty else unseen_rows(batch, log.committed(), match_on, members)
        partitions = [] if is_path(target) else [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
        log.stage(stamp_rows(delta, load_date, load_col).select(*columns), load_id, load_date, partitions)
        log.publish(load_id)
        if filterable(batch, batch, match_on):
            stored.store(members, log.rows_of(load_id, stamped.schema))
    return log.rows_of(load_id, stamped.schema)
