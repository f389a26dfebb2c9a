"""The folder that all executors share, and checkpoints in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a local session gets a new temporary folder, and a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(frame: DataFrame) -> DataFrame:
    """The frame, computed now and kept in the shared folder; its lineage ends there."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def saved(frame: DataFrame) -> DataFrame:
    """Like checkpoint, as columnar Parquet in a new folder of the shared folder."""
    path = f"{shared_dir(frame.sparkSession)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
