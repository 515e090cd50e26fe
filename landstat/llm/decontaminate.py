"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Only DataFrame and SQL functions. The n-grams of the benchmark become one nested array, cut into buckets by their hash; it
reaches every task as the value of a scalar subquery. Each text then finds its hits within its own row: no shuffle at all.
The array is used only while the benchmark has at most ``most_windows`` n-grams; beyond that, windows meet by a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import ascii_lower, fresh, table

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

NO_HITS = "array<struct<start:int,length:int,items:array<string>>>"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of ``value``, which is computed once however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text: A-Z in lower case, cut at ASCII characters that are neither letters nor digits. Null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(window, length, h, items): each different window of the items and the sorted ids of the items that have it.

    A window is ``n`` consecutive words; an item of fewer words, but not none, is one window. Null ids and texts give none.
    """
    rows = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    rows = rows.filter(F.size("w") > 0).select("item", "w", F.least(F.size("w"), F.lit(n)).alias("length"))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)).alias("i")
    rows = rows.select("item", "w", "length", starts).select("item", "length", F.array_join(F.slice("w", F.col("i"), F.col("length")), " ").alias("window"))
    return rows.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("h", F.xxhash64(F.split("window", " ")))


def bucket_array(windows: DataFrame, buckets: int) -> DataFrame:
    """One row, one column: ``buckets`` arrays of the windows whose hash falls there. Its size is the benchmark's, checked by the caller."""
    entry = F.struct("h", "window", "length", "items")
    found = windows.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.collect_list(entry).alias("e"))
    every = windows.sparkSession.range(buckets).withColumnRenamed("id", "b").join(found, "b", "left")
    none = F.array().cast(windows.select(F.array(entry).alias("e")).schema["e"].dataType)
    return every.agg(F.array_sort(F.collect_list(F.struct("b", F.coalesce("e", none).alias("e")))).alias("all")).select(F.col("all.e"))


def scan(words: Column, buckets: Column, n_buckets: int, lengths: list[int]) -> Column:
    """Hits of ``words``, an array of (start, length, items) sorted by start; each hash hit is verified word for word."""

    def of(length: int) -> Column:
        def matched(i: Column) -> Column:
            window = F.slice(words, i, F.lit(length))
            h = F.xxhash64(window)
            same = let(h, lambda h: F.filter(F.get(buckets, F.pmod(h, F.lit(n_buckets)).cast("int")), lambda e: e["h"] == h))
            return F.filter(same, lambda e: (e["length"] == length) & (e["window"] == F.array_join(window, " ")))

        starts = F.when(F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - length + 1)).otherwise(F.array().cast("array<int>"))
        near = F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(length).alias("length"), F.flatten(F.transform(matched(i), lambda e: e["items"])).alias("items")))
        return F.filter(near, lambda s: F.size(s["items"]) > 0)

    return F.array_sort(F.concat(*[of(length) for length in lengths])) if lengths else F.array().cast(NO_HITS)


def prepared(benchmark: DataFrame, n: int) -> tuple[DataFrame, int, list[int]]:
    """The windows of a benchmark, how many there are, and their lengths."""
    windows = benchmark_windows(benchmark, n)
    counted = windows.groupBy("length").count().orderBy("length").collect()  # one row a length: n at most
    return windows, sum(r["count"] for r in counted), [r["length"] for r in counted]


def buckets_for(total: int) -> int:
    return 1 << max(4, (2 * total).bit_length())


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str, words: str, hits: str, n: int = 13, most_windows: int = 200_000) -> DataFrame:
    """``docs`` with its words (column ``words``) and its hits (column ``hits``)."""
    windows, total, lengths = prepared(benchmark, n)
    docs = docs.withColumn(words, words_of(F.col(text)))
    if total <= most_windows:
        buckets = buckets_for(total)
        if not total:
            return docs.withColumn(hits, F.array().cast(NO_HITS))
        held = fresh(docs, "buckets")
        docs = docs.withColumn(held, bucket_array(windows, buckets).scalar())
        return docs.withColumn(hits, scan(F.col(words), F.col(held), buckets, lengths)).drop(held)
    # Too many windows to hold: windows of each different text meet those of the benchmark by their hash.
    key = fresh(docs, "text_key")
    docs = docs.withColumn(key, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    each = docs.select(F.col(key).alias("key"), F.explode(F.array(*[F.struct(F.lit(x).alias("length"), F.col(words).alias("w")) for x in lengths])).alias("l")).filter("size(l.w) >= l.length")
    each = each.select("key", "l.length", F.posexplode(F.expr("transform(sequence(1, size(l.w) - l.length + 1), i -> array_join(slice(l.w, i, l.length), ' '))")).alias("p", "window"))
    each = each.select("key", "length", "p", "window", F.xxhash64(F.split("window", " ")).alias("h"))
    found = each.join(windows, ["h", "window", "length"]).select("key", F.struct((F.col("p") + 1).cast("int").alias("start"), "length", "items").alias("s"))
    found = found.groupBy("key").agg(F.array_sort(F.collect_set("s")).alias(hits)).withColumnRenamed("key", key)
    return docs.join(found, key, "left").withColumn(hits, F.coalesce(hits, F.array().cast(NO_HITS))).drop(key)


def hit_count(hits: Column) -> Column:
    """How many words lie inside any hit; hits are sorted by start."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["start"] + s["length"] - 1)
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(F.least(acc["end"], end), s["start"] - 1)).cast("int").alias("n"))

    return F.aggregate(hits, start, step, lambda acc: acc["n"].cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 13, most_windows: int = 200_000) -> DataFrame:
    """``docs`` and n_words, n_hit, n_items, items_sha256, contaminated; columns of these names are replaced.

    A word inside any occurrence of a benchmark window is hit. n_items counts items with windows that occur; items_sha256 is
    the SHA-256 of their ids, sorted as strings and comma-joined (of the empty string for none). A document is contaminated if
    it has a hit and 20 * n_hit >= n_words. A null text has no words; repeated rows and texts get equal results; an empty
    benchmark hits nothing.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    words, hits = fresh(docs, "words"), fresh(docs, "hits")
    found = with_hits(docs, benchmark, text, words, hits, n, most_windows)
    items = fresh(found, "items")
    found = found.withColumns({"n_words": F.size(words).cast("long"), "n_hit": hit_count(F.col(hits)), items: F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda s: s["items"]))))})
    return found.withColumns(
        {
            "n_items": F.size(items).cast("long"),
            "items_sha256": F.sha2(F.array_join(items, ","), 256),
            "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        }
    ).drop(words, hits, items)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 13, most_windows: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are.

    The test of a row is one expression in which words, hits and their count are bound once: a filter on columns would be pushed
    below them, and each of its uses would scan the text anew.
    """
    windows, total, lengths = prepared(benchmark, n)
    if not total:
        return docs
    if total > most_windows:
        inner = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
        return contamination(inner, benchmark, "text", n, most_windows).filter(~F.col("contaminated")).select("row.*")
    held, size = fresh(docs, "buckets"), buckets_for(total)
    judged = lambda w: let(let(F.col(held), lambda b: hit_count(scan(w, b, size, lengths))), lambda k: (k > 0) & (20 * k >= F.size(w)))
    return docs.withColumn(held, bucket_array(windows, size).scalar()).filter(F.coalesce(~let(words_of(F.col(text)), judged), F.lit(True))).drop(held)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 13) -> DataFrame:
    """``docs`` with each hit word and what follows it up to the next word taken out of its text; null and clean texts stay."""
    words, hits = fresh(docs, "words"), fresh(docs, "hits")
    found = with_hits(docs, benchmark, text, words, hits, n)
    upper_word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    upper_not = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    parts = F.regexp_extract_all(F.col(text), F.lit(f"({upper_word}|{upper_not})"), F.lit(1))
    shift = F.when(F.col(text).rlike(f"^{upper_word}"), 0).otherwise(1)  # parts alternate; the first is a word or not
    gone = F.array_distinct(F.flatten(F.transform(hits, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    number = lambda j: F.floor((j - shift) / 2).cast("int") + 1
    kept = let(gone, lambda g: F.array_join(F.filter(parts, lambda part, j: ~F.array_contains(g, number(j))), ""))
    return found.withColumn(text, F.when(F.size(hits) > 0, kept).otherwise(F.col(text))).drop(words, hits)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every whole text of ``documents`` by 13-word windows of ``benchmark``."""
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("text")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
 b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
 bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT item, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
 hit AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, win)),
 pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
 its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
