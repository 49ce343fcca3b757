"""Replacing a table without a moment in which it is missing (SNK-3, CMP-10).

A versioned folder keeps each replace in a folder of its own and names the current one by a small
numbered file, the pointer, which appears whole by one rename:

    _version-<unique>/              the rows of one replace
    _pointers/00000007.json         {"folder": "_version-...", ...}: the highest number is current

Readers resolve the pointer once and read that version's folder. A version stays for those that are still
running until it is neither among the ``keep`` before the current one nor replaced less than ``grace_s``
seconds ago, so a reader may take that long however often the table is replaced. A replace that fails leaves no pointer, so nothing
changes. Two replaces at once can't take the same number: the later one retries with the next.
A catalog table switches its location to the new version's folder in one catalog step.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardflow.sinks.files import Folder

#: Versions kept beside the current one, and seconds that any version outlives its replacement.
KEPT_VERSIONS, GRACE_S = 2, 6 * 3600


class Versions:
    """The versions of a table in one folder; a version may hold several parts, committed together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def pointers(self) -> list[str]:
        return [n for n in self.folder.names("_pointers") if n.endswith(".json")]

    def current(self) -> dict | None:
        """What the newest pointer says, or ``None`` before the first replace."""
        names = self.pointers()
        return self.folder.read_json(f"_pointers/{names[-1]}") if names else None

    def new_folder(self) -> str:
        return f"_version-{self.spark._jvm.java.util.UUID.randomUUID()}"

    def part_path(self, folder: str, part: str = "rows") -> str:
        return f"{self.folder}/{folder}/{part}"

    def read(self, part: str = "rows") -> DataFrame:
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"{self.folder} has no version")
        schema = StructType.fromJson(now["schemas"][part])
        return self.spark.read.schema(schema).parquet(self.part_path(now["folder"], part))

    def replace(self, parts: dict[str, DataFrame], notes: dict | None = None, keep: int = KEPT_VERSIONS,
                grace_s: float = GRACE_S) -> str:
        """Write a new version and make it current; returns its folder. ``notes`` go into the pointer."""
        folder = self.new_folder()
        for part, df in parts.items():
            df.write.parquet(self.part_path(folder, part))
        entry = {"folder": folder, "schemas": {p: df.schema.jsonValue() for p, df in parts.items()}, "notes": notes or {}}
        while True:
            names = self.pointers()
            number = int(names[-1].removesuffix(".json")) + 1 if names else 1
            if self.folder.write_json(f"_pointers/{number:08d}.json", entry):
                break
        names = self.pointers()
        for name, after in list(zip(names, names[1:]))[:max(0, len(names) - 1 - keep)]:
            if time.time() - self.folder.modified(f"_pointers/{after}") < grace_s:
                break
            old = self.folder.read_json(f"_pointers/{name}")["folder"]
            self.folder.delete(f"_pointers/{name}")
            self.folder.delete(old)
        return folder


def is_versioned(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).exists("_pointers")


def replace_version(df: DataFrame, target: str, keep: int = KEPT_VERSIONS, grace_s: float = GRACE_S) -> None:
    """Replace a versioned folder (``read_target`` reads its current version)."""
    Versions(df.sparkSession, target).replace({"rows": df}, keep=keep, grace_s=grace_s)


def replace_table_version(df: DataFrame, table: str, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Replace a catalog table by switching its location to a new version under ``path``.

    Readers that planned before the switch go on with the version they found. A table whose columns
    change is registered anew: a catalog can't switch both in one step.
    """
    spark = df.sparkSession
    versions = Versions(spark, path)
    place = versions.part_path(versions.replace({"rows": df}, keep=keep))
    if spark.catalog.tableExists(table):
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
        if same:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=place, source="parquet", schema=df.schema)
