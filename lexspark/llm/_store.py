"""Tables written to the shared folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


class Store:
    """Parquet tables of one run. A saved table has no lineage, so a lost executor costs no recomputation."""

    def __init__(self, spark: SparkSession):
        self.spark, self.top, self.paths = spark, f"{shared_dir(spark)}/lex-{uuid.uuid4().hex}", {}
        atexit.register(self._delete, self.top)  # results read the tables lazily, so they stay until the driver ends

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.top}/{name}-{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that nothing reads any more."""
        for t in tables:
            self._delete(self.paths[id(t)][0])

    def _delete(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is not None:  # a stopped session has nothing to delete with
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
