"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.functions.shared import checkpointed, shared_dir  # noqa: F401  for the operators of this subpackage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system; one that is not there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, so that helper columns never clash with a caller's."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: str, rows: int = 512) -> DataFrame:
    """``fn`` over slices of at most ``rows`` rows of each Arrow batch, so that a task holds a bounded part of its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(batch.slice(at, rows))

    return df.mapInArrow(run, schema)
