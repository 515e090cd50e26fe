"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most two of 64 bits agree on two of four 16-bit blocks at least, so each pair meets under
one of six top nodes of the index (two blocks, their shared bit pattern). Below a top node, fingerprints stand in the
order of their Gray rank, where neighbours differ in few bits; runs of them form leaves, runs of leaves upper nodes. A
node keeps the bits that all below it share. A search carries the differences found so far from node to node, adds those
of the bits that a node shares and its parent does not, and leaves a node and all below it once they exceed the limit.
Top nodes with many members are cut into chunks by Gray rank; only chunks whose shared bits allow a link are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, map_batches, table

BLOCK = 16
PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
LEAF = 32  # fingerprints below a leaf, and children below an upper node
CHUNK = 4096  # members of a top node that one task compares at once


def simhash(text: str, words: int = 3) -> int:
    """The 64-bit fingerprint of a text: a bit is set if it is set in over half the hashes of its word shingles.

    Shingles are ``words`` words joined by spaces, repeats included; a text of fewer words is one shingle, one of none gives 0.
    """
    parts = text.encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(words, len(parts))
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    total, n = np.zeros(64, dtype=np.int64), len(parts) - k + 1
    for i in range(0, n, 65_536):
        j = min(n, i + 65_536)
        hashes = [digest(view[a:b], 42) for a, b in zip(starts[i:j].tolist(), ends[i + k - 1 : j + k - 1].tolist())]
        total += np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3) -> DataFrame:
    """Per row of ``docs``: its id and ``fp``, its fingerprint as a signed 64-bit number. A null text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([simhash(t or "", words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, fp long")


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in Gray order, with its top bit turned so that signed numbers sort as unsigned ones."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(2**63)))


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class GrayIndex:
    """Upper nodes over fingerprints in Gray order; each level keeps shared bits (mask, pattern) and is LEAF times shorter."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        ones, zeros = fps, ~fps  # bits set in all, bits clear in all
        while len(ones) > 1:
            at = np.arange(0, len(ones), LEAF)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
            self.levels.insert(0, (ones | zeros, ones))

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) that differ in at most ``most`` bits, as places in ``queries`` and in Gray order."""
        query = np.arange(len(queries))
        node, apart, known = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint64)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                query, node, apart, known = self.children(query, node, apart, known, len(mask))
            apart = apart + popcount((queries[query] ^ pattern[node]) & mask[node] & ~known)
            keep = apart <= most
            query, node, apart, known = query[keep], node[keep], apart[keep], mask[node[keep]]
        query, node, apart, known = self.children(query, node, apart, known, len(self.fps))
        keep = apart + popcount((queries[query] ^ self.fps[node]) & ~known) <= most
        return query[keep], node[keep]

    @staticmethod
    def children(query, node, apart, known, n):
        below = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
        real = below < n
        return (np.repeat(query, LEAF)[real], below[real], np.repeat(apart, LEAF)[real], np.repeat(known, LEAF)[real])


def links_of(fps: np.ndarray, most: int) -> np.ndarray:
    """For fingerprints in Gray order: the place of the first member of each one's group of links."""
    root = np.arange(len(fps))
    index = GrayIndex(fps)
    for i in range(0, len(fps), 256):
        a, b = index.search(fps[i : i + 256], most)
        a = a + i
        keep = a < b
        a, b = a[keep], b[keep]
        while len(a):  # hook the larger root to the smaller, then shorten, until both ends of each link agree
            ra, rb = root[a], root[b]
            keep = ra != rb
            a, b = a[keep], b[keep]
            np.minimum.at(root, np.maximum(ra, rb)[keep], np.minimum(ra, rb)[keep])
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def group_links(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Links within groups of ``keys``: (src, dst), for each member the first of its group of links, as far as it is another.

    Groups hold a bounded number of rows. Each is gathered into one row, its members in the order of their Gray rank, so that all of
    them meet in one task: a ``repartition`` by keys that a join before has used too can be dropped, and a broadcast may then take the
    place of the join.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(0)
            yield links(members.values.to_numpy(), members.offsets.to_numpy())

    def links(fps: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        """Of the groups that ``starts`` opens; its last entry ends the last group."""
        src, dst = [], []
        sizes = np.diff(starts)
        two = starts[:-1][sizes == 2]
        near = two[popcount((fps[two] ^ fps[two + 1]).view(np.uint64)) <= most]
        src.append(fps[near]), dst.append(fps[near + 1])
        for a, n in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            part = fps[a : a + n]
            root = links_of(part.view(np.uint64), most)
            own = root != np.arange(n)
            src.append(part[root[own]]), dst.append(part[own])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (src, dst)], names=["src", "dst"])

    groups = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("gray", "fp"))).alias("members"))
    return groups.select(F.col("members.fp").alias("fps")).mapInArrow(run, "src long, dst long")


def links(fps: DataFrame, most: int = 2, chunk: int = CHUNK) -> DataFrame:
    """Links (src, dst) between different fingerprints (column ``fp``, no repeats) that join all that ``most`` (0 to 2) bits part.

    Links within a group form a star, so a group of n gives n - 1 rows at most; groups follow from them by transitivity.
    """
    if not 0 <= most <= 2:
        raise ValueError("two of four blocks agree only up to two differing bits")
    block = lambda i: F.shiftrightunsigned("fp", BLOCK * i).bitwiseAND(0xFFFF)
    tops = F.array(*[F.struct(F.lit(n).alias("top"), F.shiftleft(block(b), BLOCK).bitwiseOR(block(a)).alias("bits")) for n, (a, b) in enumerate(PAIRS)])
    rows = fps.select("fp", gray_rank(F.col("fp")).alias("gray"), F.explode(tops).alias("t")).select("t.top", "t.bits", "gray", "fp")
    sizes = checkpointed(rows.groupBy("top", "bits").count().filter("count > 1"))
    some = rows.join(sizes.filter(F.col("count") <= chunk).select("top", "bits"), ["top", "bits"], "left_semi")
    out = group_links(some, ["top", "bits"], most)
    large = sizes.filter(F.col("count") > chunk)
    if large.isEmpty():
        return out
    # Chunks of a large top node: cuts at quantiles of the Gray rank; shared bits of each chunk; pairs of chunks that may link.
    much = rows.join(large, ["top", "bits"])
    parts = F.ceil(F.col("n") / chunk).cast("int")
    largest = large.agg(F.max("count")).first()[0]
    fine = 1 << max(6, (2 * largest // chunk).bit_length())  # quantiles, at least two for each chunk of the largest node
    cuts = much.groupBy("top", "bits").agg(F.first("count").alias("n"), F.percentile_approx("gray", [i / fine for i in range(1, fine)], 16 * fine).alias("cuts"))
    cuts = cuts.withColumn("step", F.greatest(F.lit(1), (fine / parts).cast("int")))
    cuts = cuts.select("top", "bits", F.expr("filter(cuts, (c, i) -> (i + 1) % step = 0)").alias("cuts"))
    much = checkpointed(much.drop("count").join(cuts, ["top", "bits"]).withColumn("chunk", F.expr("size(filter(cuts, c -> c < gray))")).drop("cuts"))
    nodes = much.groupBy("top", "bits", "chunk").agg(F.bit_and("fp").alias("ones"), F.bit_and(F.bitwise_not("fp")).alias("zeros"))
    one, two = nodes.select("top", "bits", *[F.col(c).alias(f"{c}1") for c in ("chunk", "ones", "zeros")]), nodes.select("top", "bits", *[F.col(c).alias(f"{c}2") for c in ("chunk", "ones", "zeros")])
    apart = F.bit_count(F.col("ones1").bitwiseAND(F.col("zeros2"))) + F.bit_count(F.col("zeros1").bitwiseAND(F.col("ones2")))
    pairs = one.join(two, ["top", "bits"]).filter((F.col("chunk1") <= F.col("chunk2")) & (apart <= most)).select("top", "bits", "chunk1", "chunk2")
    of = F.explode(F.array_distinct(F.array("chunk1", "chunk2"))).alias("chunk")
    dealt = much.join(pairs.select("*", of), ["top", "bits", "chunk"])
    return out.unionByName(group_links(dealt, ["top", "bits", "chunk1", "chunk2"], most))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (src, dst): root is the smallest node that links reach.

    Alternates two steps until nothing changes: each node's larger neighbours go to its smallest one (large star), then its
    smaller neighbours do (small star). Each round is two joins and keeps no more links than there were; the number of rounds
    grows with the logarithm of the longest chain.
    """
    edges = checkpointed(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpointed(small.select("e.u", "e.v").filter("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, most: int = 2, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that links reach.

    Fingerprints that differ in at most ``most`` bits link; texts without words have fingerprint zero and link like any
    other. Null ids never name a component unless all its ids are null (then component_id is null). Repeated rows stay.
    Equal fingerprints are one node, so a group of copies costs one row beyond its own pre-aggregated count.
    """
    own = checkpointed(fingerprints(docs, text, doc_id, words))
    firsts = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    nodes = checkpointed(firsts)
    roots = components(links(nodes.select("fp"), most, chunk))
    joined = checkpointed(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = joined.select("fp", "root").join(least, "root").select("fp", "component_id")
    return own.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates over all of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"))
