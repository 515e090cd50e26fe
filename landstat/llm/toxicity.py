"""Toxicity: a counterfactual-regularised classifier.

A logistic regression over words and the beginnings of words. For each labelled text that names a group of people, copies are
made in which the group's terms are swapped for those of each other group of its set; a difference between the scores of a text
and its copies is penalised. So is one between a text labelled 0 that names no group and copies to which the term of a group is
added, which makes pairs on any data. A term, or a beginning that it shares with other words, that only goes with toxic texts by
chance or by bias then cannot carry weight of its own, so neutral mentions of a group are not taken for toxic ones.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import table
from landstat.llm.labelled import fit_in_one_task, remainder, sample, score_of

SAMPLE = 8_000  # labelled rows to learn from, at most
FEATURES = 2_048  # words and beginnings that may carry weight, at most
FEWEST, APART = 4, 4.5  # texts that such a feature is in, at least; standard errors of its log odds from zero, at least
STEMS = (3, 4, 5, 6)  # lengths of beginnings
PENALTY, DECAY, STEPS, RATE = 5.0, 0.002, 400, 0.1
KEPT = 400_000  # words whose features a worker remembers
LETTERS = re.compile(r"[^\W\d_]+")

#: Sets of terms for groups of people; terms at the same place in a set's groups stand for each other.
GROUPS = (
    (("women", "woman", "girls", "girl", "female"), ("men", "man", "boys", "boy", "male")),
    (("muslims", "muslim"), ("christians", "christian"), ("jews", "jewish"), ("hindus", "hindu"), ("buddhists", "buddhist"), ("atheists", "atheist")),
    (("black",), ("white",), ("asian",), ("latino",), ("african",), ("european",), ("arab",)),
    (("gay",), ("straight",), ("lesbian",), ("bisexual",), ("queer",), ("heterosexual",), ("transgender",)),
    (("immigrants", "immigrant"), ("refugees", "refugee"), ("citizens", "citizen"), ("foreigners", "foreigner")),
    (("old", "elderly"), ("young", "younger")),
    (("blind",), ("deaf",), ("disabled",), ("autistic",)),
    (("frauen", "frau"), ("männer", "mann")),
    (("femmes", "femme"), ("hommes", "homme")),
    (("mujeres", "mujer"), ("hombres", "hombre")),
)


def swaps(groups: tuple) -> list[dict[str, str]]:
    """Swaps of terms: the k-th turns each group of a set into the k-th next one of the same set."""
    out: list[dict[str, str]] = []
    for k in range(1, max(map(len, groups), default=0)):
        swap = {}
        for of in groups:
            if k < len(of):
                for i, terms in enumerate(of):
                    swap.update(zip(terms, of[(i + k) % len(of)]))
        out.append(swap)
    return out


def features_of(word: str) -> list[str]:
    """The words in a piece of text without spaces, and their beginnings."""
    out = []
    for w in LETTERS.findall(word.lower()):
        out.append(w)
        out += [f"{w[:n]}*" for n in STEMS if len(w) > n]
    return out


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


class Apart:
    """The mean of d d' over pairs of texts, for differences d of their features; pairs without a difference do not count.

    The mean square of the pairs' score differences is w' mean w, so no pair has to be kept.
    """

    def __init__(self, chosen: dict[str, int]):
        self.chosen, self.n, self.sums = chosen, 0, np.zeros((len(chosen), len(chosen)), dtype=np.float32)

    def add(self, a: set[str], b: set[str]) -> None:
        up, down = ([self.chosen[f] for f in one if f in self.chosen] for one in (a - b, b - a))
        if up or down:
            sign = np.repeat(np.array([1, -1], dtype=np.float32), [len(up), len(down)])
            self.sums[np.ix_(up + down, up + down)] += np.outer(sign, sign)
            self.n += 1

    def mean(self) -> np.ndarray:
        return self.sums / max(1, self.n)


def fit(texts: list[str], y: np.ndarray, share: float, groups: tuple = GROUPS, penalty: float = PENALTY) -> Model:
    """Weights that fit the labels, with equal scores for texts and their copies with swapped terms as far as ``penalty`` asks."""
    features = lambda text: {f for w in set(text.split()) for f in features_of(w)}
    n = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
    seen = [Counter(), Counter()]
    for text, label in zip(texts, y.astype(int)):  # features are made anew where they are needed; all at once would fill a task's memory
        seen[label].update(features(text))
    terms = {t for of in groups for g in of for t in g}
    ranked = []
    for f in chain(seen[1], (f for f in seen[0] if f not in seen[1])):
        a, b = seen[0].get(f, 0), seen[1].get(f, 0)
        if a + b >= FEWEST:
            odds = np.log((b + 0.5) / (n[1] - b + 0.5)) - np.log((a + 0.5) / (n[0] - a + 0.5))
            z = odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if abs(z) >= APART or odds > 0 and a == 0 and b >= 3 * FEWEST or f in terms:
                ranked.append((-abs(z), f))
    chosen = {f: i for i, (_, f) in enumerate(sorted(ranked)[:FEATURES])}

    del seen, ranked

    def row(fs: set[str]) -> np.ndarray:
        out = np.zeros(len(chosen), dtype=np.float32)
        out[[chosen[f] for f in fs if f in chosen]] = 1.0
        return out

    x = np.zeros((len(texts), len(chosen)), dtype=np.float32)
    swapped, added = Apart(chosen), Apart(chosen)
    for i, text in enumerate(texts):
        own = features(text)
        x[i] = row(own)
        lowered = set(LETTERS.findall(text.lower()))
        if terms & lowered:
            for swap in swaps(groups):
                swapped.add(own, {f for w in lowered for f in features_of(swap.get(w, w))})
        elif y[i] == 0 and groups:
            for of in groups[i % len(groups)]:
                added.add(own, own.union(features_of(of[i // len(groups) % len(of)])))
    apart = penalty * (swapped.mean() + added.mean())
    y = y.astype(np.float32)
    w, bias = np.zeros(len(chosen), dtype=np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -40, 40)))
        g = x.T @ ((p - y) / len(y)) + DECAY * w
        g = g + 2 * (apart @ w)
        gb = float(np.mean(p - y))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = RATE * (1 - step / (STEPS + 1))
        w = (w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    odds = lambda q: float(np.log(np.clip(q, 1e-3, 1 - 1e-3) / (1 - np.clip(q, 1e-3, 1 - 1e-3))))
    return Model({f: float(w[i]) for f, i in chosen.items()}, bias + odds(share) - odds(y.mean()))


def scorer(model: Model):
    """Scores of texts: the words of a text once each, their features once each."""
    known: dict[str, tuple[str, ...]] = {}
    weights = model.weights

    def of(texts: list[str]) -> np.ndarray:
        nonlocal known
        parts = [set(t.split()) for t in texts]
        new = set().union(*parts).difference(known)
        if len(known) + len(new) > KEPT:
            known = {}
            new = set().union(*parts)
        for word in new:
            known[word] = tuple(f for f in features_of(word) if f in weights)
        z = np.array([model.bias + sum(weights[f] for f in {f for fs in map(known.__getitem__, ws) if fs for f in fs}) for ws in parts])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    return of


def _model(docs: DataFrame, labels: DataFrame, mod: int, held: int, most_rows: int, groups: tuple, penalty: float, text: str, doc_id: str) -> Model | None:
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, share = sample(named, labels, "toxic", remainder(F.col("doc_id"), mod) != held, most_rows)
    return fit_in_one_task(rows, lambda texts, y: fit(texts, y, share, groups, penalty))


def group_gaps(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2, most_rows: int = SAMPLE, groups: tuple = GROUPS, penalty: float = PENALTY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(terms, n, gap): how far the scores of held-out texts move with the group that they name, for each set of groups.

    The first term of each group of a set is put before a text in turn; the gap of a text is its largest less its smallest score,
    the result the mean over the n texts that are held out (null and empty ones too). Without labels all gaps are 0.
    """
    model = _model(docs, labels, mod, held, most_rows, groups, penalty, text, doc_id)
    sets = F.array(*[F.struct(F.lit(", ".join(g[0] for g in of)).alias("terms"), F.array(*[F.lit(g[0]) for g in of]).alias("each")) for of in groups])
    own = docs.filter(remainder(F.col(doc_id), mod) == held).select(F.coalesce(text, F.lit("")).alias("text"))
    named = own.select("text", F.explode(sets).alias("s")).select("s.terms", F.transform("s.each", lambda t: F.concat_ws(" ", t, "text")).alias("texts"))
    # the copies of a text stay in one row, so nothing is shuffled but sums
    of = [F.when(F.size("texts") > i, score_of(docs.sparkSession, model, scorer, F.coalesce(F.get("texts", i), F.lit("")))) for i in range(max(map(len, groups)))]
    return named.select("terms", (F.array_max(F.array(*of)) - F.array_min(F.array(*of))).alias("d")).groupBy("terms").agg(F.count("*").alias("n"), F.avg("d").alias("gap"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2, most_rows: int = SAMPLE, groups: tuple = GROUPS, penalty: float = PENALTY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` and held_out (boolean), score (double, 0 to 1, higher: toxic likelier) and predicted (score >= 0.3).

    Learns from at most ``most_rows`` labelled rows whose crc32(id) modulo ``mod`` is not ``held``; only the text is an input.
    Null and empty texts get the score of a text without any known word; a null id is not held out. Without any label all
    scores are 0.5. Repeated rows get equal scores. Columns of the three names are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = _model(docs, labels, mod, held, most_rows, groups, penalty, text, doc_id)
    docs = docs.withColumn("held_out", F.coalesce(remainder(F.col(doc_id), mod) == held, F.lit(False)))
    docs = docs.withColumn("score", score_of(docs.sparkSession, model, scorer, F.col(text)))
    return docs.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learnt from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
