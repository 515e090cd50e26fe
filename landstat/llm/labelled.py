"""What the two classifiers share: bounded samples of labelled rows, one task that fits, and scoring of all rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed

MOST_CHARS = 64_000_000  # characters of the labelled texts to learn from, at most
SLICE = 256  # texts that a task scores at once


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most_rows: int, most_chars: int = MOST_CHARS, text: str = "text") -> tuple[DataFrame, float]:
    """Labelled texts to learn from, at most ``most_rows`` of ``most_chars`` characters together, and the share of label 1 among all
    usable labels.

    Each class gives up to half of either bound, in the order of a hash of the id, so the sample is the same on every run; every
    chosen text is whole. Of repeated labels of one id the largest counts; null labels and ids give nothing.
    """
    usable_labels = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in usable_labels.groupBy("label").count().collect()}
    total = sum(counts.values())
    parts = [usable_labels.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows // 2) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most most_rows rows of two numbers
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    # of rows that repeat an id, each different text is learnt from once
    found = checkpointed(docs.select("doc_id", body).join(chosen, "doc_id").groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.first("label").alias("label")))
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "h").rowsBetween(Window.unboundedPreceding, 0)
    room = found.select("doc_id", "h", F.sum(F.char_length("text")).over(order).alias("so_far")).filter(F.col("so_far") <= most_chars // 2)
    return found.join(F.broadcast(room.select("doc_id", "h")), ["doc_id", "h"], "left_semi").drop("h"), (counts.get(1, 0) / total if total else 0.5)


def fit_in_one_task(rows: DataFrame, fit: Callable[[list[str], np.ndarray], object]) -> object | None:
    """``fit`` on the bounded ``rows`` (doc_id, text, label) in one task; None without rows. The model is small by its parameters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if frames:
            rows = pd.concat(frames).sort_values(["doc_id", "text"], kind="stable")
            del frames
            texts, y = rows["text"].tolist(), rows["label"].to_numpy(dtype=np.float64)
            del rows
            yield pd.DataFrame({"model": [pickle.dumps(fit(texts, y))]})

    found = rows.repartition(1).mapInPandas(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def score_of(spark: SparkSession, model: object | None, scorer: Callable[[object], Callable[[list[str]], np.ndarray]], text: Column) -> Column:
    """A column of doubles: the score of ``text``; 0.5 for all if nothing could be learnt. ``scorer(model)`` is built once a task.

    Only the text goes to Python and only the score comes back; all other columns of a row stay where they are.
    """
    if model is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = scorer(shared.value)
        for whole in texts:
            parts = [of([t or "" for t in whole.slice(at, SLICE).to_pylist()]) for at in range(0, len(whole), SLICE)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored(text)
