"""Stage tables in a folder that all executors share.

A stage table cuts a long lineage at a place where its rows are read more than once. It is
a plain Parquet folder, so it outlives lost executors, and later reads still prune columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or else by ``setCheckpointDir``, or else one below
    the warehouse, which all executors share as well. Off a local session, a warehouse that was
    left at its default on the driver's disk is refused."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/callweave-stages"
        if named.startswith("file:") and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _qualified(spark, named.rstrip("/")) if hasattr(spark, "_jsc") else named.rstrip("/")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, so that Spark and whoever opens files itself mean the same one. A folder
    without a scheme lies on the session's default file system; one behind a view is named by where it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    return files.resolvePath(path).toString()


class Stages:
    """Names for the stage tables of one run, all under one folder of their own."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/callweave-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows once and return them read back. Stages are written once and read a few
        times, so they are compressed for size."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def remove(self) -> None:
        """Delete the stage tables. Only results that were stored elsewhere remain readable."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
