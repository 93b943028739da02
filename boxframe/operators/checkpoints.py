"""Cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only where none is set (tests)."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if named:
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        # Executors of a local cluster are processes of their own, with temporary folders of their own.
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {_SETTING} to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and go on from there.

    A table, unlike an RDD checkpoint, has a known size and prunes columns, so later joins are
    planned well. It outlives any executor.
    """
    folder = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
