"""Commit records: numbered JSON files that publish a set of immutable folders.

A writer puts its data into folders of new names and then publishes a record that
lists them; a reader resolves what it reads through the newest record.  Records
are written to a temporary name and renamed, which fails if the number is taken,
so a reader never sees half a record and two writers never share a number.  The
newest number is found by probing upward from a hint file, not by listing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """The few file operations that Spark's readers and writers don't offer, by the
    file system that Spark itself uses for a path."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a new file in one step; raises if there is one of that name."""
        part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
        self.write(part, text)
        if self.exists(path):
            self.delete(part)
            raise FileExistsError(path)
        source = self._jvm.org.apache.hadoop.fs.Path(part)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.getFileSystem(self._conf).getUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(source, self._jvm.org.apache.hadoop.fs.Path(path), options)
        except Exception as fault:
            self.delete(part)
            if self.exists(path):
                raise FileExistsError(path) from fault
            raise


class CommitLog:
    """The records of one store, numbered from 1."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = Files(spark)
        self.root = root.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.root}/{version:012d}.json"

    def latest(self) -> dict | None:
        """The newest record, or None."""
        hint = f"{self.root}/_hint"
        try:
            version = int(self.files.read(hint)) if self.files.exists(hint) else 0
        except ValueError:  # the hint was being written
            version = 0
        if version and not self.files.exists(self._path(version)):
            version = 0
        if not version:  # no usable hint: look once
            version = max((int(n[:-5]) for n in self.files.names(self.root) if n.endswith(".json")), default=0)
        if not version:
            return None
        while self.files.exists(self._path(version + 1)):
            version += 1
        return self.read(version)

    def read(self, version: int) -> dict:
        return json.loads(self.files.read(self._path(version)))

    def publish(self, record: dict) -> None:
        """Publish ``record`` under its ``version``; FileExistsError if another writer was first."""
        self.files.publish(self._path(record["version"]), json.dumps(record))
        self.files.write(f"{self.root}/_hint", str(record["version"]))

    def forget_before(self, version: int) -> None:
        for n in self.files.names(self.root):
            if n.endswith(".json") and int(n[:-5]) < version:
                self.files.delete(f"{self.root}/{n}")
