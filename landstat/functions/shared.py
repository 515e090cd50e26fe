"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``). Only in local mode, as in tests, a temporary one stands in for it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, with its lineage cut, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that was written between two steps."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
