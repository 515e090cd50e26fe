"""Byte-level BPE encoding and decoding with a public rank table.

Each match of the split pattern is a row of byte positions. A segment tree over the positions stores, at every node, the
leftmost of the smallest pair ranks below it. The root names the next merge; a merge changes at most three leaves (the
merged pair, the pair that it swallows, and the pair to its left), and each is a logarithmic update. Short pieces are
merged side by side, one tree a row of a matrix; long pieces one at a time with the same tree in a list.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import fresh, table

NONE = np.int64(2**62)
WIDE = 64  # bytes; longer pieces are merged one at a time
KEPT = 400_000  # entries of a worker's memory of words and of pieces; a full memory is emptied and results stay the same
ODD_SPACE = re.compile(r" \s|\s |^ | $")


class RankTable:
    """Ranks of a ``.tiktoken`` file, the pairs that can merge, and the bytes of each id."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"the rank table lacks the bytes {missing[:5]}")
        self.width = max(self.ranks.values()) + 1
        self.pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        parts = [b""] * self.width
        for token, rank in self.ranks.items():
            parts[rank] = token
        self.numbers = list(range(self.width))  # one object an id, shared by all that is remembered
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where they do not merge."""
        want = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.values[at], NONE)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the segment tree as a list."""
        n, pairs, width = len(piece), self.pairs, self.width
        size = 1 << max(1, (n - 1).bit_length())
        none = int(NONE)
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        leaves = np.full(size, NONE)
        found = self.pair_ranks(ids[:-1], ids[1:])
        leaves[: n - 1] = np.where(found < NONE, found * size + np.arange(n - 1), NONE)
        levels = [leaves]
        while len(levels[0]) > 1:
            levels.insert(0, np.minimum(levels[0][::2], levels[0][1::2]))
        tree = [none, *np.concatenate(levels).tolist()]
        ids = ids.tolist()
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def put(leaf: int, value: int) -> None:
            k = size + leaf
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                least = a if a < b else b
                if tree[k] == least:
                    break
                tree[k] = least
                k >>= 1

        while tree[1] < none:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            ids[at] = rank
            after[at] = right = after[gone]
            ids[gone] = -1
            put(gone, none)
            if right >= 0:
                before[right] = at
                rank = pairs.get(ids[at] * width + ids[right])
                put(at, none if rank is None else rank * size + at)
            else:
                put(at, none)
            if (left := before[at]) >= 0:
                rank = pairs.get(ids[left] * width + ids[at])
                put(left, none if rank is None else rank * size + left)
        return tuple(i for i in ids if i >= 0)

    def merge_side_by_side(self, pieces: list[bytes], size: int) -> list[tuple[int, ...]]:
        """Ids of pieces of 2 to ``size`` bytes (a power of two): row r of the matrix is the tree of piece r."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8).reshape(n, size)
        live = np.arange(size) < lengths[:, None]
        ids = np.where(live, self.byte_ids[raw], -1)
        tree = np.full((n, 2 * size), NONE)
        found = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        tree[:, size : 2 * size - 1] = np.where((found < NONE) & live[:, 1:], found * size + np.arange(size - 1), NONE)
        half = size // 2
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half //= 2
        after = np.tile(np.arange(1, size + 1), (n, 1))
        after[np.arange(n), lengths - 1] = size
        before = np.tile(np.arange(-1, size - 1), (n, 1))
        rows = np.flatnonzero(tree[:, 1] < NONE)

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            k = leaf + size
            tree[rows, k] = value
            for _ in range(size.bit_length() - 1):
                k = k >> 1
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        while len(rows):
            rank, at = np.divmod(tree[rows, 1], size)
            gone = after[rows, at]
            right = after[rows, gone]
            ids[rows, at], ids[rows, gone] = rank, -1
            after[rows, at] = right
            tree[rows, size + gone] = NONE
            put(rows, gone, np.full(len(rows), NONE))
            has = right < size
            before[rows[has], right[has]] = at[has]
            value = np.full(len(rows), NONE)
            found = self.pair_ranks(rank[has], ids[rows[has], right[has]])
            value[has] = np.where(found < NONE, found * size + at[has], NONE)
            put(rows, at, value)
            left = before[rows, at]
            has = left >= 0
            some, at, left = rows[has], at[has], left[has]
            found = self.pair_ranks(ids[some, left], rank[has])
            put(some, left, np.where(found < NONE, found * size + left, NONE))
            rows = rows[tree[rows, 1] < NONE]
        kept = ids >= 0
        flat, ends = list(map(self.numbers.__getitem__, ids[kept].tolist())), np.cumsum(kept.sum(1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of different pieces. A piece that is a token is that token."""
        out: dict[str, tuple[int, ...]] = {}
        waiting: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            if (rank := self.ranks.get(raw)) is not None:
                out[piece] = (rank,)
            elif len(raw) > WIDE:
                out[piece] = self.merge_long(raw)
            else:
                waiting.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for size, some in waiting.items():
            for i in range(0, len(some), 20_000):
                part = some[i : i + 20_000]
                out.update(zip((p for p, _ in part), self.merge_side_by_side([r for _, r in part], size)))
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, end to end, and how many each id has."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.width):
            raise ValueError("an id is outside the rank table")
        lengths = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[at], lengths


class Encoder:
    """Encodes texts batch by batch; remembers words and pieces it has met."""

    def __init__(self, ranks: RankTable, pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        # Splitting at single spaces first is exact for patterns in which a space only ever opens a match, as here.
        self.by_words = " ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+" in pattern
        self.words: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def parts(self, text: str) -> list[str]:
        """Parts of a text that can be split on their own: at each space between two characters that are not spaces."""
        if not text:
            return []
        if not self.by_words or ODD_SPACE.search(text):
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids start and the last end."""
        parts = [self.parts(t) for t in texts]
        new = set().union(*parts).difference(self.words)
        if new:
            if len(self.words) + len(new) > KEPT:
                self.words = {}
                new = set().union(*parts)
            if len(self.pieces) > KEPT:
                self.pieces = {}
            split = {p: self.split(p) for p in new}
            self.pieces.update(self.ranks.encode_pieces({x for some in split.values() for x in some if x not in self.pieces}))
            pieces = self.pieces
            for p, some in split.items():
                self.words[p] = pieces[some[0]] if len(some) == 1 else tuple(i for x in some for i in pieces[x])
        found = [list(map(self.words.__getitem__, some)) for some in parts]
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([sum(map(len, some)) for some in found], out=offsets[1:])
        return np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int32, int(offsets[-1])), offsets


def load_ranks(path: str) -> bytes:
    """The content of a rank file; ``path`` is a parameter and the file is never copied into the repository."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` and a column ``ids`` (array of int): the text's ids by ``ranks``, each match of ``pattern`` on its own.

    A null or empty text has no ids. Repeated rows stay. Columns of any names pass through; a column called ``ids`` is replaced.
    The ranks reach each executor once as a broadcast (under 1 MB, the size of the vocabulary and not of the data).
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    docs = docs.drop(ids)
    schema = docs.withColumn(ids, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(RankTable(shared.value), pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                flat, offsets = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks: bytes, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``tokens`` and a column ``out`` (binary): the bytes of the ids. Null ids give empty bytes; an unknown id fails."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)
    tokens = tokens.drop(out)
    schema = tokens.withColumn(out, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = RankTable(shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column(ids).fill_null([]) if batch.column(ids).null_count else batch.column(ids)
                counts = np.diff(lists.offsets.to_numpy())
                raw, lengths = by.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
                whole_bytes = raw.tobytes()
                values = [whole_bytes[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], names=[*batch.schema.names, out])

    return tokens.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256, from the operator's ids and decoded bytes."""
    ids, raw = fresh(docs, "token_ids"), fresh(docs, "decoded")
    coded = encode(docs.select("doc_id", "text"), ranks, pattern, ids=ids).drop("text")
    return decode(coded, ranks, ids, raw).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids, " "), 256).alias("ids_sha256"),
        F.sha2(raw, 256).alias("decoded_sha256"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every whole text of ``documents`` with the 50k byte-level ranks."""
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
