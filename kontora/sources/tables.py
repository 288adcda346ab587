"""Parquet tables and versioned snapshots."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kontora.schema import TARGETS, conform


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that plans which read it
    twice make it once.  The folder is the session's ``spark.checkpoint.dir``; only a
    session on one machine may do without."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="kontora-"))
    return df.checkpoint(eager=True)


class Snapshots:
    """A table as numbered immutable versions; the newest complete one is current.

    A version is never written over, so a plan may read one and write the next.
    Only Spark's own file system is used: any store Spark reads will do.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType = TARGETS):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that were written completely, in order."""
        root = self._path(self.folder)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        done = [int(n[2:]) for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS"))]
        return sorted(done)

    def read(self, version: int | None = None) -> DataFrame:
        """The current (or given) version in the canonical shape; empty if none."""
        have = self.versions()
        if not have:
            return self.spark.createDataFrame([], self.schema)
        return conform(self.spark.read.parquet(f"{self.folder}/v={have[-1] if version is None else version}"), self.schema)

    def write(self, df: DataFrame) -> int:
        have = self.versions()
        version = have[-1] + 1 if have else 0
        conform(df, self.schema).write.mode("overwrite").parquet(f"{self.folder}/v={version}")
        return version

    def prune(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions."""
        for v in self.versions()[: -keep or None]:
            self._fs.delete(self._path(f"{self.folder}/v={v}"), True)
