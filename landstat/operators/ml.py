"""Crop classifiers as Spark ML jobs. Frames carry ``features`` (array of double), ``is_crop`` (0 or 1) and a key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landstat.functions.shared import shared_dir
from landstat.operators import groupfits as gf
from landstat.operators.confusion import binary_metrics


def vectors(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn("vector", array_to_vector(F.col(features)))


def with_balance(df: DataFrame, label: str = "is_crop") -> DataFrame:
    """``df`` with ``weight`` that gives both classes half of the total."""
    share = df.agg(F.avg(label).alias("_share"))
    w = F.when(F.col(label) == 1, F.try_divide(F.lit(0.5), F.col("_share"))).otherwise(F.try_divide(F.lit(0.5), 1 - F.col("_share")))
    return df.join(F.broadcast(share), F.lit(True)).withColumn("weight", F.coalesce(w, F.lit(1.0))).drop("_share")  # one row


def fit_forest(df: DataFrame, trees: int = 20, seed: int = 0, label: str = "is_crop"):
    return RandomForestClassifier(featuresCol="vector", labelCol=label, numTrees=trees, seed=seed).fit(vectors(df))


def fit_logistic(df: DataFrame, balanced: bool = True, label: str = "is_crop", ridge: float = 0.0):
    own = with_balance(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    return LogisticRegression(featuresCol="vector", labelCol=label, weightCol="weight", maxIter=20, regParam=ridge).fit(vectors(own))


def fit_gbt(df: DataFrame, rounds: int = 10, seed: int = 0, label: str = "is_crop"):
    return GBTClassifier(featuresCol="vector", labelCol=label, maxIter=rounds, seed=seed).fit(vectors(df))


def fit_svm(df: DataFrame, label: str = "is_crop"):
    """A linear support vector machine; its score is a margin and not a probability."""
    return LinearSVC(featuresCol="vector", labelCol=label, maxIter=20).fit(vectors(df))


def standardize(df: DataFrame, features: str = "features") -> DataFrame:
    """``features`` with mean 0 and deviation 1."""
    own = vectors(df, features)
    model = StandardScaler(inputCol="vector", outputCol="_scaled", withMean=True, withStd=True).fit(own)
    return model.transform(own).withColumn(features, vector_to_array("_scaled")).drop("vector", "_scaled")


def predict(model, df: DataFrame) -> DataFrame:
    """``df`` with ``score``: the probability of crop, or the margin through a logistic curve for models without one."""
    out = model.transform(vectors(df))
    if "probability" in out.columns:
        score = F.get(vector_to_array("probability"), F.lit(1))
    else:
        score = 1 / (1 + F.exp(-F.get(vector_to_array("rawPrediction"), F.lit(1))))
    return out.withColumn("score", score).drop("vector", "rawPrediction", "probability", "prediction")


FITS: dict[str, Callable] = {"forest": fit_forest, "logistic": fit_logistic, "gbt": fit_gbt, "svm": fit_svm}


def run_baseline(train: DataFrame, valid: DataFrame, kind: str = "forest", threshold: float = 0.5) -> DataFrame:
    """Metrics on a validation frame of a model of a training frame."""
    return binary_metrics(predict(FITS[kind](train), valid), threshold, truth="is_crop").withColumn("model", F.lit(kind))


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder."""
    at = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def feature_benchmark(df: DataFrame, variants: dict[str, Callable[[DataFrame], DataFrame]], kind: str = "logistic") -> DataFrame:
    """Metrics by feature variant; each variant makes ``features``. ``df`` has ``part``: train or test. A fit a variant."""
    return _union([run_baseline(v(df).filter("part = 'train'"), v(df).filter("part = 'test'"), kind).withColumn("variant", F.lit(name)) for name, v in variants.items()])


def plus_one(train: DataFrame, valid: DataFrame, base: Sequence[str], candidates: Sequence[str], kind: str = "logistic", rounds: int = 1, ridge: float = 0.01) -> DataFrame:
    """Greedy growth of a set of datasets: in each round every candidate is tried with those chosen; the best F1 stays, on ties the last name.

    Kinds ``logistic`` and ``linear`` (least squares) fit all candidates of a round in one plan; ``linear`` reads the training rows once for
    all rounds, as the sums of datasets add up. Other kinds take a fit a candidate. Candidates without usable rows have no row in the result.
    """
    chosen, out = list(base), []
    sums = gf.grams(train, "dataset").transform(stored) if kind == "linear" else None
    for k in range(1, rounds + 1):
        left = [c for c in candidates if c not in chosen]
        if not left:
            break
        if kind in ("linear", "logistic"):
            members = gf.members_of(train, "dataset", {c: [*chosen, c] for c in left})
            models = gf.least_squares(sums, "dataset", members, ridge) if kind == "linear" else gf.logistic(train, "dataset", members, ridge)
            scored = gf.score_sets(models, valid, gf.curve if kind == "logistic" else lambda m: m)
            tried = binary_metrics(scored, 0.5, ["model"], truth="is_crop").withColumnsRenamed({"model": "added"}).withColumns({"model": F.lit(kind), "round": F.lit(k)})
        else:
            tried = _union([run_baseline(train.filter(F.col("dataset").isin(*chosen, c)), valid, kind).withColumns({"round": F.lit(k), "added": F.lit(c)}) for c in left])
        tried = tried.transform(stored)  # a row a candidate
        out.append(tried)
        best = tried.agg(F.max(F.struct("f1", "added")).alias("best")).first()["best"]
        if best is None:
            break
        chosen.append(best["added"])
    return _union(out)


def grid(train: DataFrame, valid: DataFrame, sets: dict[str, Sequence[str]], seeds: Sequence[int], kind: str = "forest", ridge: float = 0.01, key: str = "id") -> DataFrame:
    """Metrics on a fixed validation frame for each training set and seed.

    A forest takes a fit a set and seed. ``logistic`` fits all of them in one plan; there a seed draws the rows of a model with
    replacement, by the hash of their ``key``.
    """
    if kind == "logistic":
        pairs = [(d, f"{name}/{s}", int(s)) for name, datasets in sets.items() for d in dict.fromkeys(datasets) for s in seeds]
        members = train.sparkSession.createDataFrame(pairs, "dataset string, model string, seed long")
        metrics = binary_metrics(gf.score_sets(gf.logistic(train, "dataset", members, ridge, key=key), valid), 0.5, ["model"], truth="is_crop")
        return metrics.select("accuracy", "precision", "recall", "f1", F.regexp_replace("model", "/[^/]*$", "").alias("training_set"), F.element_at(F.split("model", "/"), -1).cast("int").alias("seed"))
    out = []
    for name, datasets in sets.items():
        own = train.filter(F.col("dataset").isin(*datasets))
        out += [binary_metrics(predict(fit_forest(own, seed=s), valid), 0.5, truth="is_crop").withColumns({"training_set": F.lit(name), "seed": F.lit(s)}) for s in seeds]
    return _union(out)


def score(df: DataFrame, predict_fn: Callable[[pd.Series], pd.Series], features: str = "features") -> DataFrame:
    """``df`` with ``score`` by a user's function of a batch of features, batch by batch on the executors."""
    schema = df.withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=predict_fn(batch[features]))

    return df.mapInPandas(run, schema)


def per_region(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | T.StructType, by: str) -> DataFrame:
    """A user's function of each region, called once a region, whatever its size, on the frames of its rows as they come.

    A call sees an iterator of frames, at most one Arrow batch of rows each, and yields frames of ``schema``; what it keeps is all the
    memory that it takes. Rows without a region are one region.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(batches)

    return df.groupBy(by).applyInPandas(run, schema)


def region_maps(train: DataFrame, pixels: DataFrame, regions: Sequence[str] | None = None, ridge: float = 0.01) -> DataFrame:
    """Scores of each region's pixels by a logistic model of its own training rows; the maps together are a mosaic.

    All regions are fitted in one plan, however many there are; ``regions`` names those that are wanted (all of them if it is left
    out). Pixels of regions without training rows are left out.
    """
    own = train if regions is None else train.filter(F.col("region").isin(*regions))
    return gf.score_groups(gf.logistic(own, "region", ridge=ridge), pixels, "region")
