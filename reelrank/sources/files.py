"""Small files beside the tables (manifests), through Spark's own file systems: any path that Spark can write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Lists, reads, writes and deletes below any path of the session's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def list(self, path: str) -> dict[str, int]:
        """Names of the children of a folder, with their modification times in ms; none if it does not exist."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """A new file that is there as a whole or not at all: written aside, then renamed."""
        fs, p = self._at(path)
        aside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
        stream = fs.create(aside)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not fs.rename(aside, p):
            fs.delete(aside, False)
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
