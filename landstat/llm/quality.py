"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer numpy network.

Each word has a sparse random index vector drawn from a hash of its characters; a word's context vector is the sum of the
index vectors of its neighbours in the labelled sample. Words never met there keep their own index vector. The form of a
word (its upper and lower case, digits and marks) is indexed in the same way. A document is the mean of its words' vectors
and of their forms', with the share of words that repeat the one before. Probabilities are calibrated by a temperature.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.labelled import fit_in_one_task, remainder, sample, score_of
from landstat.llm.common import table

DIM, ONES = 64, 6  # length of index vectors, and how many of their places are not zero
REACH = 2  # neighbours on either side that a context vector gathers
SAMPLE = 8_000  # labelled rows to learn from, at most
LEAST = 0.3  # the score from which a text is taken
VOCABULARY, FEWEST = 60_000, 3  # words with a context vector, at most, and times that such a word occurs, at least
KEPT = 120_000  # words whose vectors a worker remembers
LONGEST = 40  # characters of a word
STEP = 65_536  # words whose vectors are added up at once
HIDDEN, EPOCHS, RATE, DECAY, HELD = 24, 60, 0.003, 1e-4, 5  # every HELD-th row of the sample sets the temperature


def index_vectors(words: list[str], salt: int) -> np.ndarray:
    """The sparse random vectors of words: ONES places of each, plus or minus, drawn from its hash."""
    h = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), salt) for w in words), np.uint64, len(words))
    out, rows = np.zeros((len(words), DIM), dtype=np.float32), np.arange(len(words))
    for k in range(ONES):
        part = (h >> np.uint64(9 * k)).astype(np.int64)
        out[rows, part % DIM] += np.where(part >> 7 & 1, 1.0, -1.0).astype(np.float32)
    return out / np.float32(ONES**0.5)


RUN = re.compile(r"(.)\1+", re.S)


def form(word: str) -> str:
    """The form of a word: A, a, 9 for runs of upper case, lower case and digits; other characters as they are, runs of two at most."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return RUN.sub(lambda m: m[1] if m[1] in "Aa9" else m[1] * 2, kinds)


def words_of(text: str) -> list[str]:
    """The words of a text; a stretch without spaces of more than LONGEST characters counts as pieces of that length, end to end."""
    words = text.split()
    if len(text) > LONGEST and len(max(words, key=len, default="")) > LONGEST:
        words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


@dataclass
class Model:
    context: dict[str, int]  # rows of vectors
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    shift: float  # from the sample's share of label 1 to that of all labels, in log odds


class Pooler:
    """Document vectors; remembers the vectors and the forms of words it has met."""

    def __init__(self, context: dict[str, int], known: np.ndarray):
        self.context, self.known = context, known
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.forms: dict[str, int] = {}
        self.vectors, self.form_of, self.form_vectors = np.zeros((1024, DIM), np.float32), np.zeros(1024, np.int32), np.zeros((0, DIM), np.float32)

    def learn(self, words: set[str]) -> None:
        new, first = sorted(words), len(self.ids)
        if first + len(new) > len(self.vectors):
            size = max(first + len(new), len(self.vectors) * 3 // 2)
            self.vectors.resize((size, DIM), refcheck=False)
            self.form_of.resize(size, refcheck=False)
        self.ids.update(zip(new, range(first, first + len(new))))
        rows = self.vectors[first : first + len(new)]
        rows[:] = index_vectors(new, 1)
        met = [(i, self.context[w]) for i, w in enumerate(new) if w in self.context]
        if met:
            at, row = map(list, zip(*met))
            rows[at] = self.known[row]
        forms = [form(w) for w in new]
        if unknown := sorted(set(forms).difference(self.forms)):
            self.forms.update(zip(unknown, range(len(self.forms), len(self.forms) + len(unknown))))
            self.form_vectors = np.concatenate([self.form_vectors, index_vectors(unknown, 2)])
        self.form_of[first : first + len(new)] = [self.forms[f] for f in forms]

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 2 * DIM + 3))
        parts = [words_of(t) for t in texts]
        new = set().union(*parts).difference(self.ids)
        if len(self.ids) + len(new) > KEPT:
            self.clear()
            new = set().union(*parts)
        if new:
            self.learn(new)
        for i, words in enumerate(parts):
            if not words:
                out[i, -1] = 1.0
                continue
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            for a in range(0, len(ids), STEP):
                some = ids[a : a + STEP]
                out[i, :DIM] += self.vectors[some].sum(0, dtype=np.float64)
                out[i, DIM : 2 * DIM] += self.form_vectors[self.form_of[some]].sum(0, dtype=np.float64)
            out[i, : 2 * DIM] /= len(ids)
            out[i, -3] = np.mean(ids[1:] == ids[:-1]) if len(ids) > 1 else 0.0
            out[i, -2] = np.log1p(len(ids)) / 10
        return out


def context_vectors(texts: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Context vectors of the words that occur FEWEST times at least, the VOCABULARY most frequent of them."""
    counts: dict[str, int] = {}
    for t in texts:
        for w in words_of(t):
            counts[w] = counts.get(w, 0) + 1
    words = sorted((w for w, n in counts.items() if n >= FEWEST), key=lambda w: (-counts[w], w))[:VOCABULARY]
    ids = {w: i for i, w in enumerate(words)}
    index = np.concatenate([index_vectors(words, 1), np.zeros((1, DIM), np.float32)])
    total = np.zeros((len(words) + 1, DIM), dtype=np.float32)
    for t in texts:
        row = np.fromiter((ids.get(w, len(words)) for w in words_of(t)), np.int64)
        for a in range(0, len(row), STEP):
            some = row[a : a + STEP]
            near = np.zeros((len(some), DIM), dtype=np.float32)
            for k in range(1, REACH + 1):
                before, after = row[max(0, a - k) : a + len(some) - k], row[a + k : a + len(some) + k]
                near[len(some) - len(before) :] += index[before]
                near[: len(after)] += index[after]
            np.add.at(total, some, near)
    norms = np.linalg.norm(total, axis=1, keepdims=True)
    total /= np.where(norms > 0, norms, 1)
    return ids, total[:-1].copy()


def forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ layers[0] + layers[1])
    return hidden, (hidden @ layers[2] + layers[3])[:, 0]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Two layers, by Adam over mini-batches, with fixed seeds."""
    rng = np.random.default_rng(0)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)]
    m, v, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(order), 128):
            some = order[a : a + 128]
            hidden, z = forward(layers, x[some])
            d = ((sigmoid(z) - y[some]) / len(some))[:, None]
            dh = d @ layers[2].T * (1 - hidden**2)
            grads = [x[some].T @ dh + DECAY * layers[0], dh.sum(0), hidden.T @ d + DECAY * layers[2], d.sum(0)]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                layers[k] = layers[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which held-out rows are likeliest."""
    if not len(z):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(texts: list[str], y: np.ndarray, share: float) -> Model:
    context, known = context_vectors(texts)
    pool = Pooler(context, known)
    x = np.concatenate([pool(texts[i : i + 64]) for i in range(0, len(texts), 64)])
    del pool
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1.0
    x = np.clip((x - mean) / scale, -6, 6)
    held = np.arange(len(x)) % HELD == 0 if len(x) >= 10 * HELD else np.zeros(len(x), bool)
    layers = train(x[~held], y[~held])
    odds = lambda p: float(np.log(np.clip(p, 1e-3, 1 - 1e-3) / (1 - np.clip(p, 1e-3, 1 - 1e-3))))
    return Model(context, known, mean, scale, layers, temperature(forward(layers, x[held])[1], y[held]), odds(share) - odds(y.mean()))


def scorer(model: Model):
    pool = Pooler(model.context, model.vectors)

    def of(texts: list[str]) -> np.ndarray:
        x = np.clip((pool(texts) - model.mean) / model.scale, -6, 6)
        return sigmoid(forward(model.layers, x)[1] / model.temperature + model.shift)

    return of


def quality_score(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, most_rows: int = SAMPLE, text: str = "text", doc_id: str = "doc_id") -> Column:
    """The score of each row of ``docs`` (double, 0 to 1, higher: quality 1 likelier) as a column; fits the model at once.

    Learns from at most ``most_rows`` labelled rows whose crc32(id) modulo ``mod`` is not ``held``; only the text is an input.
    """
    rows, share = sample(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), labels, "quality", remainder(F.col("doc_id"), mod) != held, most_rows)
    model = fit_in_one_task(rows, lambda texts, y: fit(texts, y, share))
    return score_of(docs.sparkSession, model, scorer, F.col(text))


def quality_scores(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, most_rows: int = SAMPLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` and held_out (boolean), score (``quality_score``) and predicted (score >= 0.3).

    Null and empty texts get a score like any other; a null id is not held out. Without any label all scores are 0.5; with
    labels of one class only, all scores lean to that class. Repeated rows get equal scores. Columns of the three names are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    value = quality_score(docs, labels, mod, held, most_rows, text, doc_id)
    docs = docs.withColumn("held_out", F.coalesce(remainder(F.col(doc_id), mod) == held, F.lit(False))).withColumn("score", value)
    return docs.withColumn("predicted", (F.col("score") >= LEAST).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, as they are; all columns stay, whatever their names."""
    return docs.filter(quality_score(docs, labels, text=text, doc_id=doc_id) >= least)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``, learnt from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
