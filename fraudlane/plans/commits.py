"""The commit log of a warehouse: numbered files, each created by one writer only.

A commit is the file with the next number, one short line of JSON. Whoever creates it has made the commit. A writer that saw
the same log and comes later gets a Conflict, as what it read is out of date. A claim is a numbered file as well, one more each time a
load is started: a writer whose load has been started again since is fenced off (Fenced) and may not commit.

Both need a file system that creates a file only where there is none: HDFS does so atomically, an object store needs conditional
writes, and a local folder is for tests. A writer that dies while it writes a line leaves a file without a whole one; it
counts as a number without a commit.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed since the log was read."""


class Fenced(RuntimeError):
    """Another writer has started the same load since."""


class CommitLog:
    """Commits under ``path``, claims under ``path/_claims`` (which readers of the commits pass over)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _create(self, path: str, line: str) -> bool:
        """Whether this call has created the file."""
        fs, where = self._at(path)
        try:
            out = fs.create(where, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception.getMessage()):
                return False
            raise
        out.write(bytearray(line.encode()))
        out.close()
        return True

    def _numbers(self, path: str) -> list[int]:
        fs, where = self._at(path)
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isFile()] if fs.exists(where) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def last(self) -> int:
        """The number of the latest commit; 0 without any."""
        return max(self._numbers(self.path), default=0)

    def entries(self, upto: int | None = None) -> list[dict]:
        """The commits in order, up to a number."""
        if not self.last():
            return []
        lines = self.spark.read.text(self.path, pathGlobFilter="*.json").where("value LIKE '{%}'").collect()  # one short line a commit
        found = sorted((json.loads(r.value) for r in lines), key=lambda e: e["number"])
        return [e for e in found if upto is None or e["number"] <= upto]

    def append(self, entry: dict, expected: int) -> int:
        """Commit ``entry`` as the one after ``expected``, the last that the writer has seen. Returns its number."""
        number = expected + 1
        if self.last() != expected or not self._create(f"{self.path}/{number:010d}.json", json.dumps({**entry, "number": number}) + "\n"):
            raise Conflict(f"commit {number} of {self.path} has been made by another writer")
        return number

    def claim(self, load_id: int) -> int:
        """Start a load: the number of this run of it."""
        folder = f"{self.path}/_claims/load_id={load_id}"
        run = max(self._numbers(folder), default=0) + 1
        while not self._create(f"{folder}/{run}.json", ""):
            run += 1
        return run

    def check(self, load_id: int, run: int) -> None:
        if (latest := max(self._numbers(f"{self.path}/_claims/load_id={load_id}"), default=0)) != run:
            raise Fenced(f"run {run} of load {load_id} has been followed by run {latest}")
