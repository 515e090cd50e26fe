"""Streaming jobs against their batch twins, over a stream of files."""

import pytest
from pyspark.sql import functions as F

from landstat.plans import bindings as b
from landstat.streaming import labels as st
from landstat.streaming import sinks


@pytest.fixture(scope="module")
def source(spark, sf, tmp_path_factory):
    """The label stream as files in the order of time, and a last label far later that moves the watermark past all others."""
    at = str(tmp_path_factory.mktemp("events") / "in")
    events = spark.read.parquet(f"{sf}/events.parquet")
    late = events.limit(1).withColumns({"ts": F.lit("2100-01-01").cast("timestamp").cast(events.schema["ts"].dataType), "event_id": F.lit(-1).cast("long")})
    events.orderBy("ts").coalesce(1).write.parquet(at)
    late.coalesce(1).write.mode("append").parquet(at)
    return at, events


def run(spark, df, mode, name):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def stream(spark, source):
    return b.as_stream(spark.readStream.schema(source[1].schema).option("maxFilesPerTrigger", 1).parquet(source[0]))


def key(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_counts_by_window(spark, source):
    got = run(spark, st.stream_counts(stream(spark, source)), "append", "counts").filter("start < '2099-01-01'")
    assert key(got, ["start", "answer", "n"]) == key(st.stream_counts(b.as_stream(source[1])), ["start", "answer", "n"])


def test_sessions(spark, source):
    got = run(spark, st.stream_sessions(stream(spark, source)), "append", "sessions").filter("start < '2099-01-01'")
    assert key(got, ["email", "start", "n"]) == key(st.stream_sessions(b.as_stream(source[1])), ["email", "start", "n"])


def test_dedupe_keeps_one_label_a_key(spark, source):
    got = run(spark, st.stream_dedupe(stream(spark, source)), "append", "deduped").filter("event_id >= 0")
    assert key(got, ["plotid", "email"]) == key(st.stream_dedupe(b.as_stream(source[1])), ["plotid", "email"])


def test_consensus_last_state(spark, source):
    got = run(spark, st.stream_consensus(stream(spark, source).filter("event_id >= 0")), "update", "consensus")
    last = got.groupBy("plotid").agg(F.max_by(F.struct("n_crop", "n_other", "answer"), F.col("n_crop") + F.col("n_other")).alias("s")).select("plotid", "s.*")
    columns = ["plotid", "n_crop", "n_other", "answer"]
    assert key(last, columns) == key(st.stream_consensus(b.as_stream(source[1])), columns)


LABELS = "plotid long, answer string, ts timestamp"


def test_consensus_ends_and_starts_anew(spark, tmp_path):
    """Files arrive one by one, the job restarts from its checkpoint between them, and a plot's state ends by its timer."""
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    told = {}

    def arrive(k, rows):
        spark.createDataFrame(rows, "plotid long, answer string, ts string").select("plotid", "answer", F.col("ts").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(at)
        stream = spark.readStream.schema(LABELS).option("maxFilesPerTrigger", 1).parquet(at)
        sinks.drain(st.stream_consensus(stream, keep_days=10), sinks.append_once(out), str(tmp_path / "checkpoint"), "update")
        rows = sinks.read_batches(spark, out).collect()
        new = {(r["plotid"], r["n_crop"], r["n_other"], r["answer"]) for r in rows if (r["batch"], r["plotid"]) not in told}
        told.update({(r["batch"], r["plotid"]): r for r in rows})
        return new

    assert arrive(0, [(1, "Crop", "2020-01-01"), (1, "Crop", "2020-01-02"), (2, "Non-crop", "2020-01-02"), (2, None, "2020-01-02")]) == {(1, 2, 0, "Crop"), (2, 0, 1, "Non-crop")}
    assert arrive(1, [(1, "Non-crop", "2020-01-05"), (3, "Crop", "2020-01-05")]) == {(1, 2, 1, "Crop"), (3, 1, 0, "Crop")}  # counts come from the checkpoint
    assert arrive(3, [(4, "Crop", "2020-03-01")]) == {(4, 1, 0, "Crop")}  # the watermark passes all timers
    assert arrive(4, [(1, "Crop", "2020-03-02"), (2, "Non-crop", "2020-03-02")]) == {(1, 1, 0, "Crop"), (2, 0, 1, "Non-crop")}


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    at, batch = str(tmp_path / "t"), spark.range(5)
    write = sinks.append_once(at)
    assert sinks.read_batches(spark, at) is None
    write(batch, 0), write(batch, 0)
    batch.write.parquet(f"{at}/batch=1")  # written, but the job was lost before its marker
    assert sinks.read_batches(spark, at).count() == 5
    write(batch.limit(3), 1), write(batch, 2)
    assert rows_of(sinks.read_batches(spark, at).groupBy("batch").count(), "batch", "count") == [(0, 5), (1, 3), (2, 5)]


def test_upsert_is_idempotent(spark, tmp_path):
    at = str(tmp_path / "labels")
    rows = lambda *r: spark.createDataFrame(list(r), "source string, start_year int, id int")
    write = sinks.upsert_once(at, ["source", "start_year"])
    first = rows(("a", 2020, 1), ("a", 2020, 2), ("b", 2020, 3), (None, 2020, 4))
    write(first, 0), write(first, 0)
    second = rows(("a", 2020, 5), ("c", 2021, 6), (None, 2020, 7), (None, 2021, 8))
    second.write.parquet(f"{at}/rows/batch=1")  # half-written: rows without keys and marker
    assert rows_of(sinks.read_batches(spark, at, "rows"), "id") == [(1,), (2,), (3,), (4,)]
    write(second, 1), write(second, 1), write(first, 2)
    assert rows_of(sinks.read_batches(spark, at, "rows"), "batch", "id") == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 6), (1, 8)]


def test_merged_moments_equal_those_of_one_batch(spark, sf, tmp_path):
    at = str(tmp_path / "moments")
    labels = b.stream(spark, sf).select("event_id", "answer", "analysis_secs")
    write = st.merged_band_stats(at)
    for k in range(5):
        part = labels.filter(F.col("event_id") % 5 == k)
        if k == 3:  # lost between the version and its marker
            st.stream_band_stats(labels).write.parquet(f"{at}/batch={k}")
        write(part, k), write(part, k)
    tidy = lambda df: {r["answer"]: (r["n"], round(r["mean"], 6), round(r["std"], 6)) for r in st.moments(df).collect()}
    assert tidy(sinks.read_merged(spark, at)) == tidy(st.stream_band_stats(labels))
    assert len(list((tmp_path / "moments").glob("batch=*"))) == 2 and sinks.committed(spark, at) == [3, 4]


def test_dedupe_keeps_the_first_label(spark, tmp_path):
    """Labels that arrive in the order of time: the stream keeps the one that the batch twin keeps."""
    at = str(tmp_path / "in")
    for k, day in enumerate(("2020-01-01", "2020-01-02", "2020-01-03")):
        rows = [(10 * k + i, day, i % 2, "u1") for i in range(3 if k else 2)]
        spark.createDataFrame(rows, "event_id long, ts string, plotid long, email string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(at)
    schema = "event_id long, ts timestamp, plotid long, email string"
    sinks.drain(st.stream_dedupe(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at)), sinks.append_once(str(tmp_path / "out")), str(tmp_path / "c"))
    assert rows_of(sinks.read_batches(spark, str(tmp_path / "out")), "event_id") == rows_of(st.stream_dedupe(spark.read.schema(schema).parquet(at)), "event_id") == [(0,), (1,)]
