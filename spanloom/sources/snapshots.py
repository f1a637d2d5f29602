"""Versioned tables: a version is seen whole or not at all, and the last good one stays readable.

A version's rows are written to a folder of their own by Spark's committers; it
becomes visible by a pointer, a file named after the version, that is renamed
into place.  A write that fails or is given up leaves a folder without a
pointer.  Files and renames go through Hadoop's file systems, wherever the table is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Snapshots:
    """The versions of one table under ``path``; the newest ``keep`` stay readable."""

    path: str
    keep: int = 2

    def _fs(self, spark: SparkSession):
        make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return make(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make

    def versions(self, spark: SparkSession) -> list[int]:
        """The committed versions, ascending."""
        fs, make = self._fs(spark)
        if not fs.exists(make(f"{self.path}/committed")):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(make(f"{self.path}/committed")) if f.getPath().getName().isdigit())

    def _rows(self, spark: SparkSession, version: int) -> str:
        fs, make = self._fs(spark)
        stream = fs.open(make(f"{self.path}/committed/{version:012d}"))
        try:
            return f"{self.path}/rows/{stream.readUTF()}"
        finally:
            stream.close()

    def read(self, spark: SparkSession, below: int | None = None) -> DataFrame | None:
        """The newest version (below ``below``, if given); None where there is none."""
        found = [v for v in self.versions(spark) if below is None or v < below]
        return spark.read.parquet(self._rows(spark, found[-1])) if found else None

    def commit(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as the next version, or as ``version``; gives its number.

        A version that is there already stays as it is: who commits it again has made
        the same rows, or, where the number was not given, has lost a race and gets an error.
        """
        spark = df.sparkSession
        fs, make = self._fs(spark)
        number = (self.versions(spark) or [-1])[-1] + 1 if version is None else version
        pointer = make(f"{self.path}/committed/{number:012d}")
        if fs.exists(pointer):
            return number
        folder = f"{number:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/rows/{folder}")
        waiting = make(f"{self.path}/waiting/{folder}")
        fs.mkdirs(pointer.getParent())
        out = fs.create(waiting, True)
        try:
            out.writeUTF(folder)
        finally:
            out.close()
        if fs.exists(pointer) or not fs.rename(waiting, pointer):
            fs.delete(make(f"{self.path}/rows/{folder}"), True)
            if version is None:
                raise RuntimeError(f"version {number} of {self.path} was committed by another writer")
            return number
        self._tidy(spark)
        return number

    def _tidy(self, spark: SparkSession) -> None:
        fs, make = self._fs(spark)
        for old in self.versions(spark)[: -self.keep]:
            rows = self._rows(spark, old)
            fs.delete(make(f"{self.path}/committed/{old:012d}"), False)
            fs.delete(make(rows), True)

    def update(self, spark: SparkSession, change) -> int:
        """Commit ``change(newest version or None)``: a rewrite in place that readers see at once or not at all."""
        return self.commit(change(self.read(spark)))
