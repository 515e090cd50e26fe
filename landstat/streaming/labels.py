"""Labels as they arrive: Structured Streaming jobs over the label stream (event_id, ts, plotid, email, answer, analysis_secs).

Each function takes a batch or a streaming frame; the batch result is what the stream comes to once all labels are in.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from landstat.operators.labels import ingest_new_sources, keep_first
from landstat.streaming import sinks

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_dedupe(df: DataFrame, keys=("plotid", "email"), delay: str = "40 days") -> DataFrame:
    """The first label of a key; the state of a key ends once the watermark passes it, and labels later than that go."""
    if df.isStreaming:
        return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
    return keep_first(df, keys, ["ts", "event_id"])


def stream_counts(df: DataFrame, size: str = "1 day", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Labels of each class in tumbling or sliding windows."""
    own = df.withWatermark("ts", delay) if df.isStreaming else df
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return own.groupBy(window.alias("w"), "answer").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "answer", "n")


def stream_sessions(df: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Work sessions of labelers: start, end, labels and seconds of analysis."""
    own = df.withWatermark("ts", delay) if df.isStreaming else df
    each = own.groupBy("email", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("analysis_secs").alias("secs"))
    return each.select("email", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "secs")


def stream_band_stats(df: DataFrame, by: str = "answer") -> DataFrame:
    """Count, sum and sum of squares by band: additive, so a later reader has mean and deviation at any time."""
    return df.groupBy(by).agg(F.count("analysis_secs").alias("n"), F.sum("analysis_secs").alias("sum"), F.sum(F.col("analysis_secs") * F.col("analysis_secs")).alias("sum_sq"))


def moments(stats: DataFrame, by: str = "answer") -> DataFrame:
    mean = F.col("sum") / F.col("n")
    return stats.select(by, "n", mean.alias("mean"), F.sqrt(F.try_divide(F.greatest(F.lit(0.0), F.col("sum_sq") - F.col("n") * mean * mean), F.col("n") - 1)).alias("std"))


CONSENSUS = "plotid long, n_crop long, n_other long, answer string"


class Consensus(StatefulProcessor):
    """Counts of a plot in a value state, and a timer that ends them."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "n_crop long, n_other long, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        crop, other, last = self.counts.get() if self.counts.exists() else (0, 0, 0)
        for f in rows:
            own = int((f["answer"] == "Crop").sum())
            crop, other = crop + own, other + int(f["answer"].notna().sum()) - own
            last = max(last, int(f["ts"].max().timestamp() * 1000)) if f["ts"].notna().any() else last
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.counts.update((crop, other, last))
        self.handle.registerTimer(max(last, timerValues.getCurrentWatermarkInMs()) + self.keep_ms)
        answer = "Crop" if crop > other else "Non-crop" if crop < other else "tie"
        yield pd.DataFrame({"plotid": [key[0]], "n_crop": [crop], "n_other": [other], "answer": [answer]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_consensus(df: DataFrame, delay: str = "1 hour", keep_days: float = 400.0) -> DataFrame:
    """Per plot: labels for crop and for other, and the answer of most (``tie`` for as many). A stream re-emits a plot on each change.

    The state of a plot is two counts and a time; a batch that is run again after a restart starts from the counts before it. A timer ends
    the state once the watermark is ``keep_days`` past the last label of the plot, and later labels of it count anew; labels older than
    the watermark go. Labels without an answer count for neither. The batch twin counts all labels. A stream needs the state store that
    has timers, which this sets for the session.
    """
    if not df.isStreaming:
        crop, other = F.count_if(F.col("answer") == "Crop"), F.count_if(F.col("answer") != "Crop")
        return df.groupBy("plotid").agg(crop.alias("n_crop"), other.alias("n_other")).withColumn("answer", F.when(F.col("n_crop") > F.col("n_other"), "Crop").when(F.col("n_crop") < F.col("n_other"), "Non-crop").otherwise("tie"))
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own = df.select("plotid", "answer", "ts").withWatermark("ts", delay).groupBy("plotid")
    return own.transformWithStateInPandas(Consensus(int(keep_days * 86_400_000) + 1), CONSENSUS, "update", "eventTime")


def merged_band_stats(table: str, by: str = "answer") -> sinks.Write:
    """A ``foreachBatch`` function that keeps the table of ``stream_band_stats`` at ``table`` up to date, each batch once."""
    sums = [F.sum(c).alias(c) for c in ("n", "sum", "sum_sq")]
    return sinks.merge_once(table, lambda batch: stream_band_stats(batch, by), lambda both: both.groupBy(by).agg(*sums))


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The batch twin of ``sinks.upsert_once``."""
    return ingest_new_sources(existing, incoming)
