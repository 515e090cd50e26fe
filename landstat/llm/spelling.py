"""Spelling variants: words one edit apart, found by k-d trees over letter counts, and the usual form of each rare one.

One edit changes the vector of letter counts by at most two in L1: a replacement by two, an insertion or deletion by one. For each
length a k-d tree, grown on a bounded sample, divides the space of vectors into cells. Every word belongs to one cell and, as a query, to
the other cells of its own length within two and the cells of the next shorter length within one; all other cells are pruned
by their boxes. A task grows a finer tree over each of its cells, searches it in the same way, and verifies the order of the letters.
Each pair is met once and counts for both words; no pair leaves its task, only how many near words a word met there, and the best.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import LOWER, UPPER, checkpointed, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
TO_LOWER = str.maketrans(UPPER, LOWER)
SHORTEST, LEAST, RATIO = 6, 5, 5
SAMPLE = 50_000  # words on which the trees are grown; every word is in them
CELL, LEAF = 400, 24  # words of a cell that the trees aim at, and of a leaf inside a cell
PENDING = 300_000  # different words that a task counts before it hands them on
DIMS = 26 + 64
FAR = 1 << 30


def count_words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, slip: int | None = None) -> DataFrame:
    """Per word of at least ``shortest`` code points and ``least`` occurrences: word, n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With ``slip``, a run loses the code point ``h %
    length`` where ``slip`` divides h, the unsigned crc32 of ``<doc_id>:<run>``; a null doc_id stands as an empty string there. A null
    or empty text has no words; repeated rows count again. Tasks add up before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], names=["word", "n"])
            met.clear()
            return out

        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if not text:
                        continue
                    low: dict[str, int] = {}
                    for word, n in Counter(RUN.findall(text)).items():
                        word = word.lower() if word.isascii() else word.translate(TO_LOWER)
                        low[word] = low.get(word, 0) + n
                    head = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for word, n in low.items():
                        if slip and (h := zlib.crc32(word.encode(), head)) % slip == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                        if len(word) >= shortest:
                            met[word] = met.get(word, 0) + n
                    if len(met) > PENDING:
                        yield flush()
        yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint16)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts: a to z, then U+00C0 to U+00FF."""
    at = np.where(codes < 128, codes.astype(np.int64) - 97, codes.astype(np.int64) - 0xC0 + 26)
    n = len(codes)
    return np.bincount((at + DIMS * np.arange(n)[:, None]).ravel(), minlength=n * DIMS).reshape(n, DIMS).astype(np.int32)


class Tree:
    """A k-d tree over letter counts. Its leaves are boxes that cover the whole space."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.nodes: list[tuple[int, int, int, int, int, int]] = []  # dimension, value, box in that dimension, children; -1: leaf
        self.leaves: list[np.ndarray] = []  # the rows of points of each
        self.leaf = leaf
        self._grow(points, np.arange(len(points)), {})

    def _grow(self, points: np.ndarray, rows: np.ndarray, box: dict[int, tuple[int, int]]) -> int:
        here = len(self.nodes)
        self.nodes.append((-1, len(self.leaves), 0, 0, 0, 0))
        if len(rows) > self.leaf:
            own = points[rows]
            values = range(int(own.max())) if own.max() <= 16 else np.unique(np.quantile(own, np.linspace(0, 1, 33)).astype(int))[:-1].tolist()
            below = np.stack([(own <= v).sum(0) for v in values])
            even = np.minimum(below, len(rows) - below)
            k, dim = divmod(int(even.argmax()), DIMS)
            if even[k, dim]:
                value, (low, high) = values[k], box.get(dim, (-FAR, FAR))
                goes = own[:, dim] <= value
                left = self._grow(points, rows[goes], box | {dim: (low, value)})
                right = self._grow(points, rows[~goes], box | {dim: (value + 1, high)})
                self.nodes[here] = (dim, value, low, high, left, right)
                return here
        self.leaves.append(rows)
        return here

    def owner(self, points: np.ndarray) -> np.ndarray:
        """The leaf in whose box each point lies."""
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            dim, value, _, _, left, right = self.nodes[node]
            if dim < 0:
                out[rows] = value
            elif len(rows):
                goes = points[rows, dim] <= value
                waiting += [(left, rows[goes]), (right, rows[~goes])]
        return out

    def within(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of points whose L1 distance to its box is at most ``radius``)."""
        waiting = [(0, np.arange(len(points)), np.zeros(len(points), np.int32))]
        while waiting:
            node, rows, far = waiting.pop()
            dim, value, low, high, left, right = self.nodes[node]
            if dim < 0:
                yield value, rows
                continue
            q = points[rows, dim]
            far = far - np.maximum(0, np.maximum(low - q, q - high))
            for child, a, b in ((left, low, value), (right, value + 1, high)):
                there = far + np.maximum(0, np.maximum(a - q, q - b))
                near = there <= radius
                if near.any():
                    waiting.append((child, rows[near], there[near]))


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each row of words of equal length or one apart: do they differ by one replaced, or one inserted code point?"""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(1) == 1
    head = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= n


class Cell:
    """The words of one cell, what each has met so far, and the tree over them."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.codes = letters(words)
        self.points = vectors(self.codes)
        self.tree = Tree(self.points, LEAF)
        self.order = ranks(words, n)
        self.by_order = np.argsort(self.order)
        self.met = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}
        own, other = self.pairs(self.points, self.codes, 2)
        once = own < other
        own, other = np.concatenate([own[once], other[once]]), np.concatenate([other[once], own[once]])
        self.note(own, words, n, self.order, self.by_order, other)

    def pairs(self, points: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of queries, and rows of this cell's words that are one edit from them."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for leaf, rows in self.tree.within(points, radius):
            held = self.tree.leaves[leaf]
            for at in range(0, len(rows), step := max(1, 2_000_000 // (len(held) * codes.shape[1] + 1))):
                q, d = np.repeat(rows[at : at + step], len(held)), np.tile(held, len(rows[at : at + step]))
                ok = one_edit(self.codes[d], codes[q])
                found.append((q[ok], d[ok]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def note(self, rows: np.ndarray, words: list[str], n: np.ndarray, order: np.ndarray, by_order: np.ndarray, other: np.ndarray) -> None:
        """``other[i]``, a row of ``words``, is near this cell's word ``rows[i]``."""
        self.met += np.bincount(rows, minlength=len(self.words))
        first = np.full(len(self.words), len(words))
        np.minimum.at(first, rows, order[other])
        for k in np.flatnonzero(first < len(words)).tolist():
            w = by_order[first[k]]
            mine = (-int(n[w]), words[w])
            self.best[k] = min(mine, self.best.get(k, mine))

    def ask(self, words: list[str], n: np.ndarray, radius: int) -> Iterator[tuple[str, int, int, str]]:
        """What each of ``words``, from other cells, meets here: (word, near words, n of the best, the best)."""
        codes = letters(words)
        q, d = self.pairs(vectors(codes), codes, radius)
        order = ranks(words, n)
        self.note(d, words, n, order, np.argsort(order), q)
        first = np.full(len(words), len(self.words))
        np.minimum.at(first, q, self.order[d])
        counts = np.bincount(q, minlength=len(words))
        for k in np.flatnonzero(counts).tolist():
            w = self.by_order[first[k]]
            yield words[k], int(counts[k]), int(self.n[w]), self.words[w]

    def told(self) -> Iterator[tuple[str, int, int, str]]:
        """What this cell's own words have met."""
        for k, (minus, word) in self.best.items():
            yield self.words[k], int(self.met[k]), -minus, word


def ranks(words: list[str], n: np.ndarray) -> np.ndarray:
    """The place of each word by falling n, then code points."""
    out = np.empty(len(words), np.int64)
    out[sorted(range(len(words)), key=lambda k: (-n[k], words[k]))] = np.arange(len(words))
    return out


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], list[str], np.ndarray]]:
    """Stretches of equal (size, leaf, kind) of a sorted batch."""
    keys = np.stack([batch.column(c).to_numpy() for c in ("size", "leaf", "kind")], 1)
    cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
    words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield tuple(keys[a].tolist()), words[a:b], n[a:b]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells one after the other: the words of a cell (kind 0) come before its queries (the radius is their kind)."""
    names = ["word", "n_near", "best_n", "best"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=names)

    at, words, counts, cell = None, [], [], None
    for batch in batches:
        out: list[tuple] = []
        for (size, leaf, kind), some, n in _rows(batch):
            if (size, leaf) != at:
                if words:
                    cell = Cell(words, np.concatenate(counts))
                if cell:
                    out.extend(cell.told())
                at, words, counts, cell = (size, leaf), [], [], None
            if kind == 0:
                words += some
                counts.append(n)
                continue
            if words:
                cell, words, counts = Cell(words, np.concatenate(counts)), [], []
            if cell:
                for of in _by_length(some).values():
                    out.extend(cell.ask([some[k] for k in of], n[of], kind))
        yield batch_of(out)
    if words:
        cell = Cell(words, np.concatenate(counts))
    if cell:
        yield batch_of(list(cell.told()))


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """Per word of ``words`` (word, n; different words of the letters above) that has any: word, n_near, best_n, best.

    ``best`` is the near word of the largest n, the smallest in code-point order among equals. Trees are grown on the ``sample`` words of
    the smallest hashes; a length without a word in the sample is one cell. Words with equal letter counts share a cell, however many
    there are. Rows with a null or empty word meet nothing.
    """
    size = words.agg(F.count("word").alias("n")).first()["n"]
    drawn = [r[0] for r in words.filter("word != ''").orderBy(F.xxhash64("word"), "word").limit(sample).select("word").collect()]
    leaf = max(10, round(cell * len(drawn) / max(size, 1)))
    trees = {k: Tree(vectors(letters([drawn[i] for i in of])), leaf) for k, of in _by_length(drawn).items()}
    for t in trees.values():
        t.leaves = []
    whole = Tree(np.zeros((0, DIMS), np.int32), 1)
    shared = words.sparkSession.sparkContext.broadcast(trees)  # at most one node for five words of the sample

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            to: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

            def send(rows: np.ndarray, size: int, leaf: np.ndarray | int, kind: int) -> None:
                to.append((rows, np.full(len(rows), size), np.broadcast_to(leaf, len(rows)), np.full(len(rows), kind)))

            for size, of in _by_length(texts).items():
                of, points = np.array(of), vectors(letters([texts[k] for k in of]))
                own = shared.value.get(size, whole).owner(points)
                send(of, size, own, 0)
                for there, rows in shared.value.get(size, whole).within(points, 2):
                    send(of[rows[own[rows] < there]], size, there, 2)
                for there, rows in shared.value.get(size - 1, whole).within(points, 1):
                    send(of[rows], size - 1, there, 1)
            if not to:
                continue
            rows, sizes, leaves, kinds = (np.concatenate(x) for x in zip(*to))
            for at in range(0, len(rows), 20_000):
                part = slice(at, at + 20_000)
                some = batch.take(pa.array(rows[part]))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[part].astype(np.int32)) for x in (sizes, leaves, kinds)), *some.columns], names=["size", "leaf", "kind", "word", "n"])

    routed = words.select("word", "n").filter("word != ''").mapInArrow(route, "size int, leaf int, kind int, word string, n long")
    routed = routed.repartition("size", "leaf").sortWithinPartitions("size", "leaf", "kind")
    met = routed.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """Per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n where that is at least ``ratio`` (2 or more) times the word's own n; ``root`` is where forms lead.
    A chain of forms multiplies n at each step, so the rounds that double its steps follow from the largest n.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = checkpointed(words.select("word", "n"))
    found = near_words(words, sample, cell)
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = words.join(found, "word", "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    out = checkpointed(out)
    ends = words.agg(F.max("n").alias("most"), F.min("n").alias("fewest")).first()
    steps = math.floor(math.log(max(1, (ends["most"] or 1) / max(1, ends["fewest"] or 1)), ratio)) + 1
    led = out.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        then = led.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        led = checkpointed(led.join(then, "root", "left").select("word", F.coalesce("onward", "root").alias("root")))
    return out.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants over the words of all ``documents``."""
    return spelling_variants(count_words(table(spark, sf_dir, "documents"), slip=199))
