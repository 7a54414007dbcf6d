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


def delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None:  # a stopped session has nothing to delete with
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is written there goes when the driver ends, as results read it lazily."""
    path = f"{shared_dir(spark)}/lex-{name}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: no lineage, so a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
