"""Small file-system steps of the sinks, on whatever file system a path names."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession


class Folder:
    """A folder and the few operations that commits need: list, rename, write a small file, delete."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.root = self._new(path.rstrip("/"))
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._new(self.root, name) if name else self.root

    def __str__(self) -> str:
        return self.root.toString()

    def exists(self, name: str = "") -> bool:
        return bool(self.fs.exists(self.path(name)))

    def names(self, name: str = "") -> list[str]:
        """Names of the entries of a folder, in order; none if it isn't there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name)))

    def files(self, name: str = "", under: str = "") -> Iterator[str]:
        """Paths, relative to ``name``, of the data files below it (hidden ones are left out)."""
        for status in self.fs.listStatus(self.path(f"{name}/{under}".strip("/"))):
            leaf = status.getPath().getName()
            if leaf.startswith(("_", ".")):
                continue
            inner = f"{under}/{leaf}".lstrip("/")
            if status.isDirectory():
                yield from self.files(name, inner)
            else:
                yield inner

    def rename(self, old: str, new: str) -> bool:
        """Whether ``old`` became ``new``. A ``new`` that exists is never replaced or moved into."""
        self.fs.mkdirs(self.path(new).getParent())
        if self.exists(new) or not self.exists(old):
            return False
        return bool(self.fs.rename(self.path(old), self.path(new)))

    def write_json(self, name: str, value: dict) -> bool:
        """A small file that appears whole: written under another name, then renamed. False if it is there already."""
        hidden = f"_writing-{self.spark._jvm.java.util.UUID.randomUUID()}"
        stream = self.fs.create(self.path(hidden), False)
        stream.write(bytearray(json.dumps(value, sort_keys=True), "utf-8"))
        stream.close()
        if self.rename(hidden, name):
            return True
        self.delete(hidden)
        return False

    def read_json(self, name: str) -> dict:
        stream = self.fs.open(self.path(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def modified(self, name: str) -> float:
        """When a file was last written, in seconds since 1970."""
        return self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def delete(self, name: str = "") -> None:
        self.fs.delete(self.path(name), True)
