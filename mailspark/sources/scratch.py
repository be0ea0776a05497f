"""Shared scratch tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: For large scratch tables that are read once or twice.
DENSE = "zstd"
_TO_CLEAR: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; one of our own only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mailspark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place of its own in the application's folder, which goes when it ends."""
    folder = application_folder(spark)
    if folder not in _TO_CLEAR:
        _TO_CLEAR.add(folder)
        atexit.register(clear_scratch, spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/mailspark/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application.

    Runs when the driver ends; a long-lived one may call it between jobs, once their
    results are written elsewhere.
    """
    if spark.sparkContext._jsc is None:  # already stopped
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(
    df: DataFrame, name: str, schema: T.StructType | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back; ``compression`` is the session's unless given.

    The result survives the loss of any executor, is column-pruned by later
    readers, and has a known size, so Spark itself decides what to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(schema or df.schema).parquet(path)
