"""Listing and dropping partition folders through the Hadoop file system of the session."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


class Tree:
    """A folder of ``key=value`` partition folders on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = str(root).rstrip("/")
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _list(self, path: str) -> list:
        at = self._path(path)
        return list(self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self) -> bool:
        return self._fs.exists(self._path(self.root))

    def folders(self) -> list[str]:
        """Full paths of the immediate child folders."""
        return sorted(s.getPath().toString() for s in self._list(self.root) if s.isDirectory())

    def parts(self, column: str) -> dict[str, str]:
        """Partition value (unescaped) to folder for the folders named ``column=value``."""
        prefix = f"{column}="
        found = {}
        for folder in self.folders():
            name = folder.rsplit("/", 1)[-1]
            if name.startswith(prefix):
                found[unquote(name[len(prefix):])] = folder
        return found

    def files(self, folder: str) -> frozenset[str]:
        return frozenset(
            s.getPath().getName()
            for s in self._list(folder)
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))
        )

    def has_parquet(self) -> bool:
        """True when some data file exists anywhere below the root."""
        if not self.exists():
            return False
        files = self._fs.listFiles(self._path(self.root), True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)
