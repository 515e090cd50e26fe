"""Cross-entropy difference: how much likelier a document is under a target model than under a background model.

Both are word bigram models with the same vocabulary, smoothing and order; the target model counts the target documents, the
background model all documents. Every word of the corpus has its own counts, so words and pairs grow with the input; a smaller
vocabulary, whose other words are one unknown word, is a parameter. Counts cover every document.

Documents are dealt into blocks of bounded text. A block counts its own words and pairs under keys (64-bit hashes), sorted, and
sends each bucket of the key space its part; a bucket adds up the counts of all blocks and sends each block the sums of its own
keys, in their order. A key, however common, is sent once a block; nothing but the size of the text reaches the driver.

Where there are many blocks, parties of about the square root of their number stand between: a party adds up the counts of its
blocks, asks the buckets as one, and hands its blocks their sums. With n blocks that sends n ** 1.5 parts in place of n ** 2.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, fresh, table

MASS = 20.0  # pseudo-counts with which a word's unigram chance enters its bigram chance
BLOCK = 8_000_000  # characters of text in a block, about
LEAST_BLOCKS = 12  # so that small inputs are spread as well
MOST_DIRECT = 512  # blocks that ask the buckets themselves; more do so in parties
START, UNKNOWN = "\n", "\t"  # stand for the start of a document and words outside a given vocabulary; no word has white space
ODD_A, ODD_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
ONE = np.uint64(1)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def vocabulary(docs: DataFrame, text: str, size: int) -> list[str]:
    """The ``size`` most frequent words over all documents, ties by the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        hand = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(words_of(t))
                if len(counts) > 400_000:
                    yield hand()
                    counts.clear()
        yield hand()

    counted = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(size).select("word").collect()]


class Hashes(dict):
    """The hash of each word; of ``UNKNOWN`` for words outside ``words``, if those are given."""

    def __init__(self, words: list[str] | None):
        super().__init__({} if words is None else {w: xxhash.xxh64_intdigest(w) for w in words})
        self.other = None if words is None else xxhash.xxh64_intdigest(UNKNOWN)

    def __missing__(self, word: str) -> int:
        if self.other is not None:
            return self.other
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return h


def encoded(texts: pa.ChunkedArray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of texts end to end and of the word before each, and how many words each text has."""
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(texts), 512):
        ws = [words_of(t) for t in texts.slice(at, 512).to_pylist()]
        sizes.append(np.fromiter(map(len, ws), np.int64, len(ws)))
        parts.append(np.fromiter((hashes[w] for one in ws for w in one), np.uint64, int(sizes[-1].sum())))
    flat, counts = np.concatenate(parts), np.concatenate(sizes)
    before = np.roll(flat, 1)
    before[(np.cumsum(counts) - counts)[counts > 0]] = xxhash.xxh64_intdigest(START)
    return before, flat, counts


def keys_of(before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of pairs, of words before and of words; only the keys of words are odd."""
    pair, first, single = (before * ODD_A + word) & ~ONE, (before * ODD_B) & ~ONE, word | ONE
    return pair.view(np.int64), first.view(np.int64), single.view(np.int64)


def counted(before: np.ndarray, word: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, n_target, n_all) of a block: each of its keys once, in ascending order."""
    keys, inverse = np.unique(np.concatenate(keys_of(before, word)), return_inverse=True)
    return keys, np.bincount(inverse[np.tile(chosen, 3)], minlength=len(keys)), np.bincount(inverse, minlength=len(keys))


def packed(x: np.ndarray) -> bytes:
    """Numbers of 64 bits, byte by byte of all of them, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def edges_of(keys: np.ndarray, buckets: int, first: int = 0, n: int | None = None) -> np.ndarray:
    """Where ``n`` of the buckets (all), equal parts of the key space, begin and end among sorted keys, all of which lie in them."""
    bounds = [-(2**63) + 2**64 * i // buckets for i in range(first + 1, first + (n or buckets))]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, dtype=np.int64)), [len(keys)]])


def summed(table: pa.Table) -> pa.Table:
    """The sums over all blocks for the keys of each block; ``table`` has a bucket's keys and counts by block."""
    read = lambda name: [unpacked(x) for x in table.column(name).to_pylist()]
    each = [np.cumsum(x) for x in read("keys")]
    sizes = [len(x) for x in each]
    keys, inverse = np.unique(np.concatenate(each), return_inverse=True)
    sums = [np.bincount(inverse, weights=np.concatenate(read(n)), minlength=len(keys)).astype(np.int64) for n in ("n_target", "n_all")]
    is_word, ends = keys & 1 == 1, np.cumsum(sizes)
    whole = [int(is_word.sum()), *(int(n[is_word].sum()) for n in sums)]
    parts = [[packed(n[inverse[e - k : e]]) for e, k in zip(ends, sizes)] for n in sums]
    return pa.table([table.column("block"), table.column("bucket"), *(pa.array(x, pa.binary()) for x in parts), *(pa.array([x] * len(sizes), pa.int64()) for x in whole)], names=["block", "bucket", "n_target", "n_all", "n_words", "all_target", "all_all"])


def steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, with fewer bits."""
    return np.diff(keys, prepend=keys.dtype.type(0))


PARTS = ("block", "bucket", "keys", "n_target", "n_all")
ANSWER = "block int, bucket int, n_target binary, n_all binary, n_words long, all_target long, all_all long"


def parts_of(block: int, first: int, keys: np.ndarray, counts: list[np.ndarray], edges: np.ndarray) -> pa.Table:
    """The rows that a block sends, one a bucket from ``first`` on."""
    cut = lambda x, turn: pa.array([packed(turn(x[i:j])) for i, j in zip(edges, edges[1:])], pa.binary())
    n = len(edges) - 1
    return pa.table([pa.array(np.full(n, block, np.int32)), pa.array(np.arange(first, first + n, dtype=np.int32)), cut(keys, steps), *(cut(x, np.asarray) for x in counts)], names=list(PARTS))


def united(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The different keys of some blocks in one bucket, where the key of each row stands among them, and how many rows each block has."""
    each = [np.cumsum(unpacked(x)) for x in table.column("keys").to_pylist()]
    return *np.unique(np.concatenate(each), return_inverse=True), [len(x) for x in each]


def by_parties(asked: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """What ``summed`` answers to each block, for blocks that asked ``buckets`` coarse buckets; parties have as many blocks.

    A party splits a coarse bucket into fine ones, so that a fine one gets about as many keys as a block has.
    """
    fine = blocks // buckets + 1
    asked = checkpointed(asked.withColumn("party", F.floor(F.col("block") / buckets).cast("int")))  # both ways need it

    def ask(table: pa.Table) -> pa.Table:
        keys, inverse, _ = united(table)
        add = lambda n: np.bincount(inverse, weights=np.concatenate([unpacked(x) for x in table.column(n).to_pylist()]), minlength=len(keys)).astype(np.int64)
        bucket = table.column("bucket")[0].as_py()
        return parts_of(table.column("party")[0].as_py(), bucket * fine, keys, [add("n_target"), add("n_all")], edges_of(keys, fine * buckets, bucket * fine, fine))

    sums = asked.groupBy("party", "bucket").applyInArrow(ask, "block int, bucket int, keys binary, n_target binary, n_all binary").groupBy("bucket").applyInArrow(summed, ANSWER)
    sums = sums.withColumnRenamed("block", "party").withColumn("coarse", F.floor(F.col("bucket") / fine).cast("int"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        _, inverse, sizes = united(left)
        right = right.sort_by("bucket")
        whole = [int(right.column(n).to_numpy().sum()) for n in ("n_words", "all_target", "all_all")]
        both = [np.concatenate([unpacked(x) for x in right.column(n).to_pylist()]) for n in ("n_target", "n_all")]
        ends = np.cumsum(sizes)
        own = [pa.array([packed(n[inverse[e - k : e]]) for e, k in zip(ends, sizes)], pa.binary()) for n in both]
        return pa.table([left.column("block"), left.column("bucket"), *own, *(pa.array([x] * len(sizes), pa.int64()) for x in whole)], names=["block", "bucket", "n_target", "n_all", "n_words", "all_target", "all_all"])

    return asked.groupBy("party", "bucket").cogroup(sums.groupBy("party", "coarse")).applyInArrow(answer, ANSWER)


def scores_of(before: np.ndarray, word: np.ndarray, counts: np.ndarray, sums: tuple[np.ndarray, np.ndarray], totals: tuple[int, int], width: int) -> np.ndarray:
    """The mean loss difference of each text; ``sums`` are the counts of the two models for the block's keys in ascending order."""
    inverse = np.unique(np.concatenate(keys_of(before, word)), return_inverse=True)[1]
    pair, first, single = inverse.reshape(3, -1)
    losses = [np.log((n[first] + MASS) / (n[pair] + MASS * (n[single] + 1.0) / (total + width))) for n, total in zip(sums, totals)]
    ends, at_end = np.concatenate([[0.0], np.cumsum(losses[0] - losses[1])]), np.cumsum(counts)
    return np.where(counts > 0, (ends[at_end] - ends[at_end - counts]) / np.maximum(counts, 1), 0.0)


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, size: int | None = None, text: str = "text", doc_id: str = "doc_id", block_chars: int = BLOCK, most_direct: int = MOST_DIRECT) -> DataFrame:
    """``docs`` and n_tokens (long) and score (double): the mean over a text's words of target loss less background loss, in nats.

    Lower is closer to the target. ``targets`` has the ids of the target documents (column doc_id; repeats and nulls do not
    count). A null or empty text has no words and score 0. Without target documents the target model is uniform. Repeated rows
    count as often as they stand there and get equal scores. Columns of the two names are replaced. All words are in the
    vocabulary unless ``size`` cuts it to the most frequent ones. More than ``most_direct`` blocks work in parties, with equal scores.
    """
    docs = docs.drop("n_tokens", "score")
    words = None if size is None else vocabulary(docs, text, size)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    block = fresh(docs, "block")
    blocks = max(LEAST_BLOCKS, (docs.agg(F.sum(F.length(text))).first()[0] or 0) // block_chars + 1)
    buckets = blocks if blocks <= most_direct else math.isqrt(blocks) + 1
    # a text without an id is no target, so it may be in any block
    dealt = docs.withColumn(block, F.pmod(F.when(F.col(doc_id).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id)), F.lit(blocks)).cast("int"))
    chosen = targets.select(F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("id")).filter("id is not null").distinct()
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), *[pa.binary()] * 3)], names=list(PARTS))
        before, word, counts = encoded(left.column(text), Hashes(shared.value))
        mark = pc.is_in(left.column(doc_id), value_set=right.column("id").combine_chunks()).to_numpy() if right.num_rows else np.zeros(left.num_rows, bool)
        keys, *both = counted(before, word, np.repeat(mark.astype(bool), counts))
        return parts_of(left.column(block)[0].as_py(), 0, keys, both, edges_of(keys, buckets))

    by_block = dealt.groupBy(block)
    asked = by_block.cogroup(chosen.groupBy("block")).applyInArrow(count, "block int, bucket int, keys binary, n_target binary, n_all binary")
    given = asked.groupBy("bucket").applyInArrow(summed, ANSWER) if buckets == blocks else by_parties(asked, blocks, buckets)
    schema = docs.withColumn("n_tokens", F.lit(0).cast("long")).withColumn("score", F.lit(0.0)).schema

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns([block])
        before, word, counts = encoded(left.column(text), Hashes(shared.value))
        right = right.sort_by("bucket")  # every bucket answers every block, so that its totals add up
        sums = [np.concatenate([unpacked(x) for x in right.column(n).to_pylist()]) for n in ("n_target", "n_all")] if len(word) else []
        n_words, *totals = (int(right.column(n).to_numpy().sum()) for n in ("n_words", "all_target", "all_all"))
        width = (n_words if shared.value is None else len(shared.value)) + 2  # the unknown word and the start of a document
        score = scores_of(before, word, counts, sums, totals, width) if len(word) else np.zeros(len(counts))
        return left.append_column("n_tokens", pa.array(counts)).append_column("score", pa.array(score))

    return by_block.cogroup(given.groupBy("block")).applyInArrow(score, schema)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text of ``documents``; the target documents are those whose label says quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    targets = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return cross_entropy_difference(docs, targets).select("doc_id", "n_tokens", "score")
