"""Moves and removals in the table's file system, for file metadata only."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


class Files:
    """The file system that holds `root`, through the session's Hadoop settings."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def modified(self, path: str) -> float:
        """When a path was changed last, in seconds."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        """A missing path is no error."""
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """A source that is gone counts as moved, so that a broken run can be taken up."""
        if not self.exists(source):
            return
        parent = self._path(target).getParent()
        if not self._fs.exists(parent):
            self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def qualified(self, path: str) -> str:
        """The full path, local ones with one slash, as the file system itself names them."""
        return re.sub("^file:/+", "file:/", self._fs.makeQualified(self._path(path)).toString())

    @staticmethod
    def each(action, items: Iterable, threads: int = 16) -> None:
        """Apply to every item, some at a time; items are read as they are needed."""
        with ThreadPoolExecutor(threads) as pool:
            pending = []
            for item in items:
                pending.append(pool.submit(action, item))
                if len(pending) >= threads * 8:
                    pending.pop(0).result()
            for future in pending:
                future.result()
