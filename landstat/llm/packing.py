"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document's ids and one closing id are one item; only an item above the capacity is cut. Items above a third of the capacity
share a sequence with at most one other of them: greedy matching gives each, longest first, the longest partner that fits. Smaller
items, longest first, go to the smallest gap that holds them, and new sequences open only when no gap does.

All items of one length are alike, so the packing is worked out on the counts of lengths, at most ``capacity`` numbers whatever the
input. It yields runs: so many items of one length go into so many sequences, so many to each, at this offset. An item finds
its place from its length and its rank among the items of that length, and both come from Spark.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, fresh, table

CAPACITY = 2048
END = 0
KEPT, LONGEST = 800_000, 64  # parts that a worker remembers, and characters of the longest; all others are encoded each time
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER, SIGN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
#: Parts that can be encoded on their own: letters up to a space or sign, signs up to a letter or space, other runs up to white space,
#: and white space, whose last space opens the next token.
PARTS = re.compile(f" ?[{LETTER}]+(?=[{SPACE}{SIGN}]|\\Z)| ?[{SIGN}]+(?=[{LETTER}{SPACE}]|\\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SIMPLE = re.compile(f" ?[{LETTER}]+").fullmatch  # one match of the tokenizer's pattern, which goes to its model as it is


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers; remembers short parts."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.content, self.tokenizer, self.known = content, Tokenizer.from_buffer(content), {}
        self.tokenizer.encode_special_tokens = True
        as_signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {k: as_signs.pre_tokenize_str(chr(k))[0][0] for k in range(256) if k == 32 or re.fullmatch(f"[{LETTER}]", chr(k))}

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [PARTS.findall(t) for t in texts]
        found = [list(map(self.known.get, some)) for some in parts]
        lacking = [k for k, some in enumerate(found) if None in some]
        new = list({p for k in lacking for p, ids in zip(parts[k], found[k]) if ids is None})
        simple = {p for p in new if SIMPLE(p)}
        other = [p for p in new if p not in simple]
        coded = [(p, c.ids) for p, c in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False))]
        coded += [(p, [t.id for t in self.tokenizer.model.tokenize(p.translate(self.signs))]) for p in simple]
        fresh_ids = {p: struct.pack(f"<{len(ids)}I", *ids) for p, ids in coded}
        for k in lacking:
            found[k] = [fresh_ids[p] if ids is None else ids for p, ids in zip(parts[k], found[k])]
        if len(self.known) + len(new) > KEPT:
            self.known = {}
        self.known.update((p, ids) for p, ids in fresh_ids.items() if len(p) <= LONGEST)
        return [b"".join(some) for some in found]


_ENCODERS: list[Encoder] = []


def _encoder(content: bytes) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    if not _ENCODERS or _ENCODERS[0].content != content:
        _ENCODERS[:] = [Encoder(content)]
    return _ENCODERS[0]


def pieces(docs: DataFrame, tokenizer: bytes, capacity: int = CAPACITY, end: int = END, token_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece (from 0), start, length, ids_crc32 and, if wanted, token_ids.

    An item is the ids of a text by ``tokenizer`` (the content of its file, a few MB, broadcast) and the id ``end``. An item above the
    capacity is cut into pieces of that length, the first one being the shorter. A null text counts as empty. A row is a document: rows
    with equal or null doc_id each have their own pieces. Other columns of ``docs`` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    close = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                rows, number, start, length, crc, ids = [], [], [], [], [], []
                for row, coded in enumerate(encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                    coded = memoryview(coded + close)
                    n = len(coded) // 4
                    ends = range((n - 1) % capacity + 1, n + 1, capacity)
                    for k, b in enumerate(ends):
                        a = ends[k - 1] if k else 0
                        rows.append(row)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(coded[4 * a : 4 * b]))
                        if token_ids:
                            ids.append(np.frombuffer(coded[4 * a : 4 * b], "<u4").astype(np.int32))
                columns = [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if token_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", token_ids array<int>" * token_ids)


def runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs of a packing of ``counts[length]`` items: (length, first rank, items a sequence, first sequence, offset), by length and rank."""
    left = {k: n for k, n in counts.items() if n}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    gaps: dict[int, list[tuple[int, tuple]]] = {}  # by what is free: (sequences, ((length, items), ...))
    free: list[int] = []

    def put(gap: int, n: int, held: tuple) -> None:
        if n:
            if not gaps.setdefault(gap, []):
                insort(free, gap)
            gaps[gap].append((n, held))

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        if at >= 0 and large[at] == a and left[a] == 1:
            at -= 1
        if at < 0:
            put(capacity - a, left[a], ((a, 1),))
            left[a] = 0
        elif (b := large[at]) == a:
            put(capacity - 2 * a, left[a] // 2, ((a, 2),))
            left[a] %= 2
        else:
            n = min(left[a], left[b])
            put(capacity - a - b, n, ((a, 1), (b, 1)))
            left[a] -= n
            left[b] -= n
            if not left[b]:
                del large[at]
        if not left[a]:
            large.pop()
    for k in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        n = left[k]
        while n:
            at = bisect_left(free, k)
            if at == len(free):
                put(capacity, -(-n // (capacity // k)), ())
                continue
            gap = free[at]
            some, held = gaps[gap].pop()
            if not gaps[gap]:
                del free[at]
            each = min(n, gap // k)
            full = min(some, n // each)
            put(gap - each * k, full, (*held, (k, each)))
            put(gap, some - full, held)
            n -= full * each
    out, base, met = [], 0, dict.fromkeys(left, 0)
    for gap in free:
        for n, held in gaps[gap]:
            offset = 0
            for k, each in held:
                out.append((k, met[k], each, base, offset))
                met[k] += n * each
                offset += k * each
            base += n
    return sorted(out)


def pack(items: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``items`` with sequence_id and offset: items of ``length`` tokens in as few sequences of ``capacity`` as the method finds.

    Sequences have no gaps. Lengths must lie between 1 and the capacity. Columns pass through; sequence_id and offset are replaced.
    Items are written once to the shared folder, which fixes their partitions; ranks come from counts a partition and length, so no task
    takes all items of a common length. The driver sees the counts of lengths alone.
    """
    items = items.drop("sequence_id", "offset")
    place, part, local, before, n = (fresh(items, c) for c in ("place", "part", "local", "before", "n"))
    kept = checkpointed(items.withColumn(place, F.monotonically_increasing_id())).withColumn(part, F.shiftright(place, 33))
    counts = kept.groupBy(part, length).agg(F.count("*").alias(n))
    found = runs({r[0]: r[1] for r in counts.groupBy(length).agg(F.sum(n)).collect()}, capacity)
    ahead = counts.select(part, length, F.coalesce(F.sum(n).over(Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    ranked = kept.withColumn(local, F.row_number().over(Window.partitionBy(part, length).orderBy(place))).join(ahead, [part, length])
    ranked = ranked.select(*items.columns, (F.col(before) + F.col(local) - 1).alias(n))
    kinds, firsts, each, base, offset = np.array(found, dtype=np.int64).reshape(-1, 5).T
    keys = (kinds << 44) + firsts  # ranks stay below 2 ** 44
    schema = ranked.drop(n).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in (length, n))
            at = np.searchsorted(keys, (size << 44) + rank, "right") - 1
            row, turn = np.divmod(rank - firsts[at], each[at])
            columns = [batch.column(c) for c in batch.schema.names if c != n]
            names = [c for c in batch.schema.names if c != n]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(base[at] + row), pa.array(offset[at] + turn * size)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id and token_ids, from packed pieces that kept theirs. A sequence holds at most the capacity."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "token_ids"))), lambda p: p["token_ids"])
    return packed.groupBy("sequence_id").agg(F.flatten(parts).alias("token_ids"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all ``documents`` into sequences of 2048 tokens by the 50k byte-level tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        tokenizer = f.read()
    return pack(pieces(table(spark, sf_dir, "documents"), tokenizer, token_ids=False))
