"""Many linear models in one plan: tasks add up the sums of their rows, the sums of a model are added and solved in one place.

Frames carry ``features`` (array of double, as many in every row), a label (0 or 1) and a group. A model belongs to a group, or to a set of
groups. The number of Spark jobs depends on the number of steps alone, and not on how many models there are. Rows without a group, label or
features, and rows with a feature that is null or not finite, take no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from math import e

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstat.functions.shared import discard, shared_dir

CHUNK = 1_024  # sums that travel in one row
HELD = 4_000_000  # sums that a task holds before it sends them on, 32 MB
PIECE = 200_000  # rows of a group that one task adds up
MOST_NUMBERS = 4_000_000  # of all models together that are broadcast, 32 MB
TOLERANCE = 1e-6  # of the last step; a Newton step squares what is left


def _summed(rows: DataFrame, key: str, numbers: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
    """(key, chunk, sums): ``numbers`` of the rows of each key, added up in the tasks first and then chunk by chunk."""
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, chunk int, sums array<double>"

    def sent(held: dict) -> Iterator[pd.DataFrame]:
        for k, sums in held.items():
            parts = [sums[a : a + CHUNK] for a in range(0, len(sums), CHUNK)]
            yield pd.DataFrame({key: [k] * len(parts), "chunk": range(len(parts)), "sums": parts})

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = {}, 0
        for batch in batches:
            for k, own in batch.groupby(key, sort=False):
                sums = numbers(own)
                size += 0 if k in held else len(sums)
                held[k] = held[k] + sums if k in held else sums
                if size > HELD:
                    yield from sent(held)
                    held, size = {}, 0
        yield from sent(held)

    def across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, total = None, 0.0
        for f in frames:
            first = f.iloc[[0]] if first is None else first
            total = total + np.stack(f["sums"].to_list()).sum(axis=0)
        yield first.assign(sums=[total])

    return rows.mapInPandas(within, schema).groupBy(key, "chunk").applyInPandas(across, schema)


def _whole(chunks: pd.DataFrame) -> np.ndarray:
    return np.concatenate(chunks.sort_values("chunk")["sums"].to_list())


def _square(packed: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros((q, q))
    out[np.triu_indices(q)] = packed
    return out + np.triu(out, 1).T


def _usable(df: DataFrame, by: str, label: str, features: str) -> DataFrame:
    finite = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.filter(F.col(by).isNotNull() & F.col(label).isNotNull() & finite)


def members_of(df: DataFrame, by: str, sets: dict[str, Sequence] | None) -> DataFrame:
    """(by, model): a model a group, or a model a named set of groups."""
    if sets is None:
        return df.filter(F.col(by).isNotNull()).select(by, F.col(by).alias("model")).distinct()
    kind = df.schema[by].dataType.simpleString()
    return df.sparkSession.createDataFrame([(g, m) for m, groups in sets.items() for g in dict.fromkeys(groups)], f"`{by}` {kind}, model string")


def grams(df: DataFrame, by: str, label: str = "is_crop", features: str = "features") -> DataFrame:
    """(by, chunk, sums): what least squares needs of each group, in one pass; sums of groups add up to those of any set of them."""

    def numbers(own: pd.DataFrame) -> np.ndarray:
        a = np.column_stack([np.ones(len(own)), np.stack(own[features].to_list()), own[label].to_numpy(float)])
        return (a.T @ a)[np.triu_indices(a.shape[1])]

    return _summed(_usable(df, by, label, features).select(by, features, F.col(label).cast("double").alias(label)), by, numbers)


def least_squares(sums: DataFrame, by: str, members: DataFrame | None = None, ridge: float = 0.0) -> DataFrame:
    """(model, n, intercept, coefficients) from ``grams``: a model a group, or a model of each row of ``members`` (by, model).

    ``ridge`` is added to the mean square of each feature but not to that of the constant. Features that the rows of a model
    cannot tell apart share the smallest coefficients that fit.
    """
    own = sums.withColumnRenamed(by, "model") if members is None else sums.join(members, by)
    kind = own.schema["model"].dataType.simpleString()

    def solve(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
        packed = sum(_whole(one) for _, one in chunks.groupby("part", sort=True))
        q = int((np.sqrt(8 * len(packed) + 1) - 1) / 2)
        full = _square(packed, q)
        n = full[0, 0]
        a = full[:-1, :-1] / n + ridge * np.diag([0.0] + [1.0] * (q - 2))
        beta = np.linalg.lstsq(a, full[:-1, -1] / n, rcond=1e-12)[0]
        return pd.DataFrame({"model": [key[0]], "n": [int(n)], "intercept": [beta[0]], "coefficients": [beta[1:]]})

    part = F.lit(0) if members is None else F.col(by)
    return own.select("model", part.alias("part"), "chunk", "sums").groupBy("model").applyInPandas(solve, f"model {kind}, n long, intercept double, coefficients array<double>")


def _draws(key: str) -> Column:
    """How often a row is drawn for a ``seed``: Poisson with mean 1 from a hash of its key; once where there is no seed."""
    u = F.pmod(F.xxhash64(F.col(key), F.col("seed")), F.lit(2**31)) / 2.0**31
    times, upto, term = F.lit(0.0), 0.0, 1 / e
    for k in range(1, 11):
        upto, term = upto + term, term / k
        times = times + (u >= upto).cast("double")
    return F.when(F.col("seed").isNull(), 1.0).otherwise(times)


STATE = "n long, weight0 double, weight1 double, total double, center array<double>, scale array<double>, beta array<double>, prior array<double>, objective double, change double"


def logistic(df: DataFrame, by: str, members: DataFrame | None = None, ridge: float = 0.01, balanced: bool = True, steps: int = 25, label: str = "is_crop", features: str = "features", key: str | None = None) -> DataFrame:
    """(model, n, intercept, coefficients, converged): a logistic regression a group, or a row of ``members`` (by, model), in one plan a step.

    ``ridge`` is the penalty on coefficients of features with mean 0 and deviation 1; with ``balanced`` both classes have half of the
    weight. Each step is one Newton step of all models that have not converged; a step that makes a model worse is halved. Rows are laid out
    once in the shared folder, those of a large group in pieces of ``PIECE`` rows, so that a group is added up by as many tasks as its
    size asks for. A model whose rows are of one class says that class (its intercept is infinite). With ``seed`` in ``members``, rows of a
    model are drawn with replacement by the hash of the seed and their ``key``.
    """
    spark, at = df.sparkSession, f"{shared_dir(df.sparkSession)}/fits-{uuid.uuid4().hex}"
    members = members_of(df, by, None) if members is None else members
    seeded = "seed" in members.columns
    if seeded and key is None:
        raise ValueError("draws by seed need the key of a row")
    kind = members.schema["model"].dataType.simpleString()
    rows = _usable(df, by, label, features).select(F.col(by).alias("_group"), F.col(features).alias("_x"), F.col(label).cast("double").alias("_y"), *([F.col(key).alias("_key")] if seeded else []))
    pieces = rows.groupBy("_group").agg(F.ceil(F.count("*") / PIECE).alias("_pieces"))
    laid = rows.join(pieces, "_group").withColumn("_piece", F.pmod(F.xxhash64("_x", "_y"), F.col("_pieces"))).drop("_pieces")
    laid.repartition("_group", "_piece").sortWithinPartitions("_group", "_piece").drop("_piece").write.parquet(f"{at}/rows")
    members.withColumnRenamed(by, "_group").write.parquet(f"{at}/members")
    rows, members = spark.read.parquet(f"{at}/rows"), spark.read.parquet(f"{at}/members")
    w = _draws("_key") if seeded else F.lit(1.0)

    def moments(own: pd.DataFrame) -> np.ndarray:
        x, y, w = np.stack(own["_x"].to_list()), own["_y"].to_numpy(), own["_w"].to_numpy()
        each = [((y == c) * w)[:, None] for c in (0.0, 1.0)]
        return np.concatenate([np.concatenate([[float((v > 0).sum()), v.sum(), (v * v).sum()], (v * x).sum(axis=0), (v * x * x).sum(axis=0)]) for v in each])

    def begin(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
        (n0, w0, v0, *_), (n1, w1, v1, *_) = both = _whole(chunks).reshape(2, -1)
        p = (both.shape[1] - 3) // 2
        one = w0 == 0 or w1 == 0
        c0, c1 = (0.5 * (w0 + w1) / w0, 0.5 * (w0 + w1) / w1) if balanced and not one else (1.0, 1.0)
        total, squares = c0 * w0 + c1 * w1, c0**2 * v0 + c1**2 * v1
        mean = (c0 * both[0, 3 : 3 + p] + c1 * both[1, 3 : 3 + p]) / max(total, 1e-300)
        variance = (c0 * both[0, 3 + p :] + c1 * both[1, 3 + p :] - mean**2 * total) / max(total - squares / max(total, 1e-300), 1e-300)
        scale = np.sqrt(np.where(variance > 1e-13 * mean**2, variance, 0.0))
        beta = np.zeros(p + 1)
        beta[0] = (np.inf if w1 > 0 else -np.inf) if one else 0.0
        return pd.DataFrame({"model": [key[0]], "n": [int(n0 + n1)], "weight0": [c0], "weight1": [c1], "total": [total], "center": [mean], "scale": [scale], "beta": [beta], "prior": [beta], "objective": [np.inf], "change": [0.0 if one else np.inf]})

    def slopes(own: pd.DataFrame) -> np.ndarray:
        first, y = own.iloc[0], own["_y"].to_numpy()
        scale, beta = np.asarray(first["scale"]), np.asarray(first["beta"])
        z = (np.stack(own["_x"].to_list()) - first["center"]) / np.where(scale > 0, scale, np.inf)
        a = np.column_stack([np.ones(len(own)), z])
        w, eta = own["_w"].to_numpy() * np.where(y == 1, first["weight1"], first["weight0"]), a @ beta
        p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
        curved = (a * (w * p * (1 - p))[:, None]).T @ a
        return np.concatenate([[(w * (np.logaddexp(0, eta) - y * eta)).sum()], a.T @ (w * (p - y)), curved[np.triu_indices(len(beta))]])

    def newton(chunks: pd.DataFrame) -> pd.DataFrame:
        last, sums = chunks.iloc[[0]].drop(columns=["chunk", "sums"]), _whole(chunks)
        beta, prior, total = (np.asarray(last[c].iloc[0]) for c in ("beta", "prior", "total"))
        q, objective = len(beta), last["objective"].iloc[0]
        pull = ridge * np.array([0.0] + [1.0] * (q - 1))
        now = sums[0] / total + (pull * beta**2).sum() / 2
        if now > objective + 1e-12 * abs(objective):
            half = (beta + prior) / 2
            return last.assign(beta=[half], change=np.abs(half - prior).max())
        step = np.linalg.lstsq(_square(sums[1 + q :], q) / total + np.diag(pull), sums[1 : 1 + q] / total + pull * beta, rcond=1e-14)[0]
        return last.assign(beta=[beta - step], prior=[beta], objective=now, change=np.abs(step).max())

    state = f"model {kind}, {STATE}"
    each = rows.join(members, "_group").select("model", "_x", "_y", w.alias("_w")).filter("_w > 0")
    _summed(each, "model", moments).groupBy("model").applyInPandas(begin, state).write.parquet(f"{at}/0")
    k = 0
    for k in range(steps):
        known = spark.read.parquet(f"{at}/{k}")
        left = known.filter(F.col("change") > TOLERANCE)
        to = members.join(left.select("model", "weight0", "weight1", "center", "scale", "beta"), "model")
        size = to.agg(F.sum(F.size("beta") * 3)).first()[0]
        if not size:
            break
        asked = rows.join(F.broadcast(to) if size <= MOST_NUMBERS else to, "_group")
        sums = _summed(asked.withColumn("_w", w).filter("_w > 0").drop("_group", "_key", "seed"), "model", slopes)
        better = sums.join(left, "model").groupBy("model").applyInPandas(newton, state)
        known.filter(F.col("change") <= TOLERANCE).unionByName(better).write.parquet(f"{at}/{k + 1}")
    else:
        k, known = steps, spark.read.parquet(f"{at}/{steps}")
    for used in ("rows", "members", *range(k)):
        discard(spark, f"{at}/{used}")
    plain = F.zip_with(F.slice("beta", 2, F.size("scale")), "scale", lambda b, s: F.when(s > 0, b / s).otherwise(0.0))
    shift = F.aggregate(F.zip_with("_plain", "center", lambda b, c: b * c), F.lit(0.0), lambda s, v: s + v)
    return known.withColumn("_plain", plain).select("model", "n", (F.get("beta", F.lit(0)) - shift).alias("intercept"), F.col("_plain").alias("coefficients"), (F.col("change") <= TOLERANCE).alias("converged"))


def margin(features: Column, intercept: Column, coefficients: Column) -> Column:
    return intercept + F.aggregate(F.zip_with(features, coefficients, lambda v, c: v * c), F.lit(0.0), lambda s, v: s + v)


def curve(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def score_groups(models: DataFrame, df: DataFrame, by: str, shape: Callable[[Column], Column] = curve, features: str = "features") -> DataFrame:
    """``df`` with ``score`` by the model of its own group; rows of groups without a model are left out."""
    own = models.select(F.col("model").alias(by), F.col("intercept").alias("_i"), F.col("coefficients").alias("_c"))
    return df.join(own, by).withColumn("score", shape(margin(F.col(features), F.col("_i"), F.col("_c")))).drop("_i", "_c")


def score_sets(models: DataFrame, df: DataFrame, shape: Callable[[Column], Column] = curve, features: str = "features") -> DataFrame:
    """``df`` once a model with ``model`` and ``score``: for a few models that are all tried on the same rows."""
    one = models.agg(F.collect_list(F.struct("model", "intercept", "coefficients")).alias("_models"))  # one row, as long as the sets asked for
    each = F.transform("_models", lambda m: F.struct(m["model"].alias("model"), shape(margin(F.col(features), m["intercept"], m["coefficients"])).alias("score")))
    return df.join(F.broadcast(one), F.lit(True)).withColumn("_s", F.explode(each)).select(*df.columns, "_s.model", "_s.score")
