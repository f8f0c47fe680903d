"""Shared scratch space for tables that cut a plan or feed a file-based operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint folder.

    A path without a file system lies in the session's default one, as for Spark's own checkpoints. Where none is
    configured (single-machine tests) a new local folder is set as the checkpoint folder, so later calls find it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    single = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    if not single:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def through_storage(frame: DataFrame, name: str, rows_a_file: int | None = None) -> DataFrame:
    """Write the frame and read it back: a stage boundary that survives lost executors.

    ``rows_a_file`` bounds files by rows where rows compress so well that files of the usual size hold hours of work.
    """
    path = fresh_path(frame.sparkSession, name)
    frame.write.option("maxRecordsPerFile", rows_a_file or 0).parquet(path)
    return frame.sparkSession.read.parquet(path)
