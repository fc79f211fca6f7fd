"""Small acts on the shared file system, through Spark's own connectors: lists, renames, one-piece text files."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


class SharedFiles:
    """Folders and small files below any path that Spark can write."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """The names in a folder; none if it isn't there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """Rename a folder in one act, in place of ``target``."""
        fs, p = self._at(source)
        to = self._at(target)[1]
        fs.mkdirs(to.getParent())
        fs.delete(to, True)
        if not fs.rename(p, to):
            raise OSError(f"{source} could not be renamed to {target}")

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A text file that appears whole: written beside its place, then renamed."""
        folder, name = os.path.split(path)
        fs, draft = self._at(os.path.join(folder, f"_{name}.draft"))
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(os.path.join(folder, f"_{name}.draft"), path)
