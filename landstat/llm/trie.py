"""The prefix trie of conversations, with count-min screening of prefix digests.

A turn travels as a digest of its role and text and its number of words. The digest of a prefix is the exclusive or of hashes of
(position, digest) over its turns, in two lanes of 64 bits, so a long conversation is cut into stretches of turns and its prefixes
still come from sums over stretches. A count-min sketch counts all prefixes, up to two. An estimate of one proves that no other
conversation has the prefix, nor any longer one: such a node and all below it are a tail, told from its own rows. What may be
shared is grouped exactly.

A node stands for the smallest conversation that passes it. That conversation then also stands for all its deeper nodes, so every
figure of a subtree is a sum over conversations that pass its top, and needs no walk along the depth: each carries what its own nodes
save, whether it ends in a leaf, and the one node at which its own nodes are attached.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, table

STRETCH = 1024  # turns of a conversation that are put in order together
ROWS, LEAST_WIDTH, MOST_WIDTH = 3, 1 << 14, 1 << 24  # of the sketch; a byte a cell: 48 MB at most, whatever the input
SLICE = 1 << 16  # cells that are added up together
IDS = 20_000  # ids of a node's ends that one row holds
WORDS = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, stretch, digest, words. A null role or text counts as empty; rows without a conv_id belong to none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.expr(f"floor(turn / {STRETCH})").cast("long"), F.lit(-(2**62))).alias("stretch"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )


def in_order(turns: DataFrame) -> DataFrame:
    """``turns`` with ``i``, the place of each in its conversation from 1: by turn (null first), then digest.

    Places are counted inside stretches, and what comes before a stretch is added, so no task orders a long conversation alone.
    """
    sizes = turns.groupBy("conv_id", "stretch").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select("conv_id", "stretch", F.coalesce(before, F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    return turns.withColumn("local", local).join(ahead, ["conv_id", "stretch"]).select("conv_id", (F.col("before") + F.col("local")).alias("i"), "digest", "words")


def plain(turns: DataFrame) -> DataFrame:
    """Conversations as they are: conv_id, pos (from 1), digest, words, and n, their number of turns."""
    ordered = in_order(turns)
    return ordered.join(ordered.groupBy("conv_id").agg(F.max("i").alias("n")), "conv_id").select("conv_id", F.col("i").alias("pos"), "digest", "words", "n")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, digest, words, n) and conversations (conv_id, n).

    Conversation c opens with the first h turns of conversation ``c - c % every`` (all if it has fewer, none if there is none) and goes
    on with its own after its first h; h is the unsigned crc32 of the decimal c, modulo ``heads``.
    """
    ordered = checkpointed(in_order(turns))
    own = ordered.groupBy("conv_id").agg(F.max("i").alias("own"))
    convs = own.select("conv_id", "own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("from"))
    bases = own.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("from"), F.col("own").alias("has"))
    convs = convs.join(bases, "from", "left").withColumn("given", F.least("h", F.coalesce("has", F.lit(0))))
    convs = checkpointed(convs.select("conv_id", "from", "h", "given", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    first = ordered.filter((F.col("conv_id") % every == 0) & (F.col("i") < heads)).withColumnRenamed("conv_id", "from")
    opened = convs.filter("given > 0").join(first, "from").filter("i <= h").select("conv_id", F.col("i").alias("pos"), "digest", "words", "n")
    kept = ordered.join(convs, "conv_id").filter("i > h").select("conv_id", (F.col("i") - F.col("h") + F.col("given")).alias("pos"), "digest", "words", "n")
    return opened.unionByName(kept), convs.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn of (conv_id, pos, digest, words, n): conv_id, n, depth, words, and the lanes a, b of the prefix that ends there."""
    part = turns.withColumn("stretch", F.floor((F.col("pos") - 1) / STRETCH)).withColumns({"a": F.xxhash64(F.lit(1), "pos", "digest"), "b": F.xxhash64(F.lit(2), "pos", "digest")})
    sums = part.groupBy("conv_id", "stretch").agg(F.bit_xor("a").alias("sa"), F.bit_xor("b").alias("sb"))
    w = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("conv_id", "stretch", *(F.coalesce(F.bit_xor(c).over(w), F.lit(0)).alias(o) for c, o in (("sa", "oa"), ("sb", "ob"))))
    w = Window.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = part.select("conv_id", "stretch", "n", "pos", "words", F.bit_xor("a").over(w).alias("la"), F.bit_xor("b").over(w).alias("lb"))
    joined = local.join(ahead, ["conv_id", "stretch"])
    return joined.select("conv_id", "n", F.col("pos").alias("depth"), "words", F.col("la").bitwiseXOR(F.col("oa")).alias("a"), F.col("lb").bitwiseXOR(F.col("ob")).alias("b"))


def cells(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """The cell of each prefix in each row of the sketch; ``width`` is a power of two."""
    a, b = a.astype(np.uint64), b.astype(np.uint64) | np.uint64(1)
    return np.stack([((a + np.uint64(k) * b) >> np.uint64(17)) & np.uint64(width - 1) for k in range(ROWS)]).astype(np.int64)


def sketch(keys: DataFrame, width: int) -> np.ndarray:
    """The count-min sketch of (a, b): ``ROWS`` rows of ``width`` cells that count to two.

    Each task fills its own; slices of them are added up in a shuffle, and the whole, at most 48 MB, comes to the driver.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            held = np.zeros(ROWS * width, np.uint8) if held is None else held
            at = cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), width) + np.arange(ROWS)[:, None] * width
            some, n = np.unique(at, return_counts=True)
            held[some] = np.minimum(2, held[some] + np.minimum(n, 2))
        if held is not None:
            for k in range(0, len(held), SLICE):
                if (part := held[k : k + SLICE]).any():
                    yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "held"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(0, np.uint8)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "held"])

        for batch in batches:
            for k, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                more = np.frombuffer(held.as_buffer(), np.uint8)
                if k != at:
                    if at is not None:
                        yield out()
                    at, total = k, more.copy()
                else:
                    total = np.minimum(2, total + more)
        if at is not None:
            yield out()

    schema = "slice int, held binary"
    parts = keys.select("a", "b").mapInArrow(fill, schema).repartition("slice").sortWithinPartitions("slice").mapInArrow(add, schema)
    whole = np.zeros(ROWS * width, np.uint8)
    for k, held in parts.collect():
        whole[k * SLICE : k * SLICE + len(held)] = np.frombuffer(held, np.uint8)
    return whole


def screened(prefix: DataFrame, width: int | None = None) -> DataFrame:
    """``prefix`` (checkpointed) with ``tail``: 0 may be shared, 1 the first proven singleton of a stretch of rows, 2 one below another.

    Rows of a conversation that lie together in a partition are told from each other; in any other order, more rows are 0 or 1 and all stay right.
    """
    if width is None:
        width = min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (4 * max(1, prefix.count()) - 1).bit_length()))
    shared = prefix.sparkSession.sparkContext.broadcast(sketch(prefix, width))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = shared.value.reshape(ROWS, width), (None, 0)
        for batch in batches:
            at = cells(batch.column("a").to_numpy(), batch.column("b").to_numpy(), width)
            alone = (held[np.arange(ROWS)[:, None], at].min(0) <= 1).tolist()
            out = []
            for c, d, one in zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), alone):
                below = last == (c, d - 1)
                out.append(2 if below else int(one))
                last = (c, d) if below or one else (None, 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "tail"])

    return prefix.mapInArrow(probe, prefix.withColumn("tail", F.lit(0)).schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """Per (depth, a, b): ends_sha256 of the decimal conv_ids, ascending and comma-joined.

    A hash over all ids of a node has to read them in order. Ids are sorted by ranges over all tasks and joined, ``IDS`` to a row, so
    that the task which hashes a node reads few rows, one after the other.
    """
    names = ["depth", "a", "b"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in names], 1)
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(ids)]
            pieces = [(x, min(x + IDS, b)) for a, b in zip(cuts, cuts[1:]) for x in range(a, b, IDS)]
            firsts = pa.array([x for x, _ in pieces], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(firsts) for c in (*names, "conv_id")), pa.array([",".join(map(str, ids[x:y])) for x, y in pieces], pa.string())],
                names=[*names, "conv_id", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, hashlib.sha256()
        for batch in batches:
            out = []
            for key, ids in zip(zip(*(batch.column(c).to_pylist() for c in names)), batch.column("ids").to_pylist()):
                if key != at:
                    if at:
                        out.append((*at, sha.hexdigest()))
                    at, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield rows(out)
        if at:
            yield rows([(*at, sha.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*names, "ends_sha256"])

    key = "depth long, a long, b long"
    joined = ends.select(*names, "conv_id").repartitionByRange(*names, "conv_id").sortWithinPartitions(*names, "conv_id").mapInArrow(join, f"{key}, conv_id long, ids string")
    return joined.repartition(*names).sortWithinPartitions(*names, "conv_id").mapInArrow(digest, f"{key}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, width: int | None = None) -> DataFrame:
    """Per node of the trie over ``turns`` (conv_id, pos, digest, words, n) of ``convs`` (conv_id, n; those without turns too):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations end at the node of all their turns, one without turns at the root. No conversations: no nodes. ``width`` (a power of two)
    sets the cells of a row of the sketch; any width gives the same result.
    """
    node = ["depth", "a", "b"]
    zero = F.lit(0).cast("long")
    rows = checkpointed(screened(checkpointed(prefixes(turns)), width))
    tails = rows.filter("tail > 0")
    root = convs.select("conv_id", "n", zero.alias("depth"), zero.alias("words"), zero.alias("a"), zero.alias("b"))
    shared = rows.filter("tail = 0").drop("tail").unionByName(root)

    ends_here = F.col("n") == F.col("depth")
    nodes = shared.groupBy(*node).agg(
        F.count("*").alias("n_convs"),
        F.min(F.struct("conv_id", "n")).alias("least"),
        F.max("words").alias("words"),
        F.count_if(ends_here).alias("n_ends"),
        F.min(F.when(ends_here, F.col("conv_id"))).alias("an_end"),
    )
    saves = (F.col("n_convs") - 1) * F.col("words")
    nodes = checkpointed(nodes.select(*node, "n_convs", "n_ends", "an_end", F.col("least.conv_id").alias("conv_id"), F.col("least.n").alias("n"), saves.alias("saves")))

    # what each conversation stands for: its first own node, what its nodes save, whether it ends in a leaf
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.sum("saves").alias("total"), F.count_if(F.col("n_ends") == F.col("n_convs")).alias("leaf"))
    tail = tails.groupBy("conv_id").agg(F.min("depth").alias("first"), zero.alias("total"), F.count_if(ends_here).alias("leaf"))
    own = own.unionByName(tail).groupBy("conv_id").agg(F.min("first").alias("first"), F.sum("total").alias("total"), F.sum("leaf").alias("leaf"))
    own = checkpointed(own)

    # each conversation tells every node it passes; its own nodes hang on the last one that is not its own
    passing = shared.select("conv_id", *node).join(own, "conv_id").withColumn("hangs", F.col("depth") == F.col("first") - 1)
    told = passing.groupBy(*node).agg(F.sum("total").alias("all_saves"), F.sum("leaf").alias("n_leaves"), F.count_if("hangs").alias("hanging"))
    hung = passing.filter("hangs").select("conv_id", "first", *node)
    parents = hung.join(nodes.select(*node, F.col("conv_id").alias("above")), node).select("conv_id", "above")
    own = own.join(parents, "conv_id", "left").select("conv_id", "first", "total", "above")

    deeper = F.sum("saves").over(Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))
    above = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id")
    grouped = nodes.withColumn("deeper", deeper).join(own, "conv_id").join(told, node).join(ends_digests(shared.filter(ends_here).join(nodes.filter("n_ends > 1").select(*node), node, "left_semi")), node, "left")
    grouped = grouped.select(
        "conv_id",
        "depth",
        above,
        "n_convs",
        (F.col("hanging") + (F.col("n") > F.col("depth")).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("all_saves") - F.col("total") + F.col("deeper")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.when(F.col("n_ends") == 1, F.sha2(F.col("an_end").cast("string").cast("binary"), 256)), F.lit(NO_ENDS)).alias("ends_sha256"),
    )

    def told_alone(df: DataFrame, parent: Column) -> DataFrame:
        end = F.col("n") == F.col("depth")
        one = F.lit(1).cast("long")
        sha = F.when(end, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS))
        return df.select("conv_id", "depth", parent, one.alias("n_convs"), (~end).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), sha.alias("ends_sha256"))

    first = told_alone(tails.filter("tail = 1").join(own, "conv_id"), above)
    inner = told_alone(tails.filter("tail = 2"), F.col("conv_id").alias("parent_conv_id"))
    return grouped.unionByName(first).unionByName(inner)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all ``conversations``, rebuilt so that prefixes are shared."""
    return prefix_trie(*rebuilt(turns_of(table(spark, sf_dir, "conversations"))))
