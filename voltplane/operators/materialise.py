"""Intermediate rows that are read more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: that of spark.checkpoint.dir. Where that is unset, a local session takes a temporary one; a cluster must set it."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read from there: it cuts the lineage, and lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def files_folder(spark: SparkSession) -> str:
    """A new folder for files in the shared one; it goes when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/files-{uuid.uuid4().hex}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return str(path.toString())
