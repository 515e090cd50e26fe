"""Tables that a stream writes exactly once, behind ``foreachBatch``.

Spark may call the function of a batch again after a failure, with the same number and rows. Each batch has a folder of its own,
``batch=<number>``, which a repeated call overwrites, and a marker in ``_commits`` that is written last. Readers see marked batches
only, so half-written folders count for nothing, and a batch that is marked is not written again. A table belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Write = Callable[[DataFrame, int], None]


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def committed(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the batches that are whole, in order."""
    fs, at = _path(spark, f"{table}/_commits/*")
    return sorted(int(f.getPath().getName()) for f in fs.globStatus(at) or [])


def commit(spark: SparkSession, table: str, batch_id: int) -> None:
    """Marks a batch as whole."""
    fs, at = _path(spark, f"{table}/_commits/{batch_id}")
    fs.create(at, True).close()


def read_batches(spark: SparkSession, table: str, part: str = "") -> DataFrame | None:
    """The rows of all whole batches with their number in ``batch``; None before the first."""
    done = committed(spark, table)
    root = f"{table}/{part}" if part else table
    return spark.read.option("basePath", root).parquet(*(f"{root}/batch={k}" for k in done)) if done else None


def append_once(table: str) -> Write:
    """Each batch's rows, once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id not in committed(spark, table):
            batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")
            commit(spark, table, batch_id)

    return write


def upsert_once(table: str, keys: Sequence[str]) -> Write:
    """Rows whose ``keys`` no earlier batch brought; rows of a batch that share their keys all stay. Null keys are keys like others.

    A batch reads the different keys of the batches before it, which each left theirs in ``keys``, and none of the rows in ``rows``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in committed(spark, table):
            return
        known = read_batches(spark, table, "keys")
        if known is not None:
            known = known.select(*(F.col(k).alias(f"_known_{k}") for k in keys)).distinct()
            on = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
            batch = batch.join(known, on, "left_anti")
        batch.write.mode("overwrite").parquet(f"{table}/rows/batch={batch_id}")
        own = spark.read.schema(batch.schema).parquet(f"{table}/rows/batch={batch_id}")
        own.select(*keys).distinct().write.mode("overwrite").parquet(f"{table}/keys/batch={batch_id}")
        commit(spark, table, batch_id)

    return write


def merge_once(table: str, measure: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame]) -> Write:
    """A small table that each batch brings up to date: ``merge`` of the last version and of ``measure`` of the batch, side by side.

    A version is made from the one before it and never in place, so a repeated batch gives the same version; the two newest are kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = committed(spark, table)
        if batch_id in done:
            return
        state = measure(batch)
        if done:
            state = merge(spark.read.parquet(f"{table}/batch={done[-1]}").unionByName(state))
        state.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")
        commit(spark, table, batch_id)
        for k in done[:-1]:
            for path in (f"{table}/_commits/{k}", f"{table}/batch={k}"):
                fs, at = _path(spark, path)
                fs.delete(at, True)

    return write


def read_merged(spark: SparkSession, table: str) -> DataFrame | None:
    """The newest version of a table of ``merge_once``."""
    done = committed(spark, table)
    return spark.read.parquet(f"{table}/batch={done[-1]}") if done else None


def drain(stream: DataFrame, write: Write, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all that is there now, and ends."""
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
    query.awaitTermination()
