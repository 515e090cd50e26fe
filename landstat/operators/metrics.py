"""Scores against labels: exact AUC, curves, thresholds and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landstat.operators.confusion import binary_metrics, ratio

BUCKETS = 128  # cuts of the scores of a group


def score_counts(df: DataFrame, by: Sequence[str] = (), truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, score, pos, neg): what every curve needs, one row a different score. Combines before its shuffle."""
    y = F.col(truth) == 1
    return df.groupBy(*by, F.col(score).alias("score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def running(counts: DataFrame, by: Sequence[str], sums: dict[str, str], descending: bool, own: bool) -> DataFrame:
    """``counts`` (by, score, ...) with running sums ``{new: column}`` in the order of the score, with the row's own value or without.

    A group may hold most scores and there may be a single group, so no window spans one: scores are cut at quantiles into
    buckets, sums run inside a bucket, and what the buckets before it hold (a few hundred rows a group) is added.
    """
    cuts = counts.groupBy(*by).agg(F.percentile_approx("score", [i / BUCKETS for i in range(1, BUCKETS)], 10 * BUCKETS).alias("_cuts"))
    tagged = counts.join(cuts, list(by)) if by else counts.join(F.broadcast(cuts), F.lit(True))  # without groups: one row
    tagged = tagged.withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col("score")))).drop("_cuts")
    way = F.desc if descending else F.asc
    before = Window.partitionBy(*by).orderBy(way("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = tagged.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    offsets = totals.select(*by, "_bucket", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy(*by, "_bucket").orderBy(way("score")).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    parts = tagged.withColumns({f"_i_{n}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    out = parts.join(offsets, [*by, "_bucket"]).withColumns({n: F.col(f"_o_{n}") + F.col(f"_i_{n}") for n in sums})
    return out.drop("_bucket", *[f"{k}{n}" for n in sums for k in ("_o_", "_i_")])


def quantile(df: DataFrame, column: str, q: float, name: str = "value") -> DataFrame:
    """One row with the exact q-quantile of a column, by linear interpolation; null without values.

    Values are counted first, and running counts in buckets find the two values around the position, so that no task holds all
    different values.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("score")).agg(F.count("*").alias("n"))
    upto = running(counts, (), {"upto": "n"}, descending=False, own=True)
    at = df.agg(((F.count(column) - 1) * q).alias("_at"))
    low, high = F.min(F.when(F.col("upto") > F.floor("_at"), F.col("score"))), F.min(F.when(F.col("upto") > F.ceil("_at"), F.col("score")))
    share = F.max("_at") - F.floor(F.max("_at"))
    return upto.join(F.broadcast(at), F.lit(True)).agg((low * (1 - share) + high * share).alias(name))  # one row


def cumulative_hits(df: DataFrame, by: Sequence[str] = (), truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, score, tp, fp): true and false positives if everything from ``score`` up is taken."""
    return running(score_counts(df, by, truth, score), by, {"tp": "pos", "fp": "neg"}, descending=True, own=True).select(*by, "score", "tp", "fp")


def roc_curve(df: DataFrame, by: Sequence[str] = (), truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, threshold, fpr, tpr) at each different score."""
    hits = cumulative_hits(df, by, truth, score)
    y = F.col(truth) == 1
    all_ = df.groupBy(*by).agg(F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg"))
    both = hits.join(all_, list(by)) if by else hits.join(F.broadcast(all_), F.lit(True))  # without groups: one row
    return both.select(*by, F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("_neg")).alias("fpr"), ratio(F.col("tp"), F.col("_pos")).alias("tpr"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, auc): the exact chance that a positive outranks a negative, ties as half; null for groups of one class."""
    below = running(score_counts(df, by, truth, score), by, {"below": "neg"}, descending=False, own=False)
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    return below.groupBy(*by).agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"))


def threshold_sweep(df: DataFrame, by: Sequence[str] = (), steps: int = 100, truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, k, tp, fp, fn, tn) for ``score > k / steps``, k from 0: each row counts once, at the last threshold that it passes."""
    y = F.col(truth) == 1
    last = F.greatest(F.lit(-1), F.least(F.lit(steps - 1), F.ceil(F.col(score) * steps).cast("int") - 1))
    # ceil may be off by one where score * steps is not exact; compare with the thresholds themselves
    last = F.when((last + 1 < steps) & (F.col(score) > (last + 1) / F.lit(float(steps))), last + 1).when((last >= 0) & ~(F.col(score) > last / F.lit(float(steps))), last - 1).otherwise(last)
    counted = df.groupBy(*by, last.alias("last")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    held = counted.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("last", F.struct("pos", "neg")))).alias("at"), F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))  # steps + 1 entries at most
    each = held.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    sum_of = lambda c: F.aggregate(F.filter(F.map_entries("at"), lambda e: e["key"] >= F.col("k")), F.lit(0).cast("long"), lambda a, e: a + e["value"][c])
    each = each.select(*by, "k", sum_of("pos").alias("tp"), sum_of("neg").alias("fp"), "all_pos", "all_neg")
    return each.select(*by, "k", "tp", "fp", (F.col("all_pos") - F.col("tp")).alias("fn"), (F.col("all_neg") - F.col("fp")).alias("tn"))


def best_f1_threshold(df: DataFrame, by: Sequence[str] = (), steps: int = 100, **columns: str) -> DataFrame:
    """(by, threshold, f1): the lowest of the thresholds k / steps with the best F1."""
    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    best = threshold_sweep(df, by, steps, **columns).withColumn("f1", f1).groupBy(*by).agg(F.min_by(F.struct("k", "f1"), F.struct((-F.col("f1")).alias("f"), "k")).alias("b"))
    return best.select(*by, (F.col("b.k") / float(steps)).alias("threshold"), F.col("b.f1").alias("f1"))


def threshold_for_fpr(df: DataFrame, fpr: float, by: Sequence[str] = (), **columns: str) -> DataFrame:
    """(by, threshold): the score whose false positive rate is nearest, the highest of several."""
    curve = roc_curve(df, by, **columns)
    return curve.groupBy(*by).agg(F.min_by("threshold", F.struct(F.abs(F.col("fpr") - fpr).alias("d"), (-F.col("threshold")).alias("t"))).alias("threshold"))


def threshold_effect(df: DataFrame, thresholds: Sequence[float], by: Sequence[str], truth: str = "y_true", score: str = "score") -> DataFrame:
    """(by, threshold, fpr, tpr) for a few stated thresholds."""
    each = df.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    p, y = F.col(score) > F.col("threshold"), F.col(truth) == 1
    return each.groupBy(*by, "threshold").agg(ratio(F.count_if(p & ~y), F.count_if(~y)).alias("fpr"), ratio(F.count_if(p & y), F.count_if(y)).alias("tpr"))


def f1_by_balance(df: DataFrame, steps: Sequence[int], threshold: float = 0.5, key: str = "id", truth: str = "y_true", score: str = "score") -> DataFrame:
    """(percent, accuracy, precision, recall, f1) with only ``percent`` of the negatives, drawn by a hash of the (whole) key."""
    draw = F.pmod(F.col(key) * 48271, F.lit(2147483647)) % 100
    each = df.withColumn("percent", F.explode(F.array(*map(F.lit, steps)))).filter((F.col(truth) == 1) | (draw < F.col("percent")))
    return binary_metrics(each, threshold, ["percent"], truth, score)


def evaluate(df: DataFrame, threshold: float = 0.5, other: float | None = None, by: Sequence[str] = ("subset",), truth: str = "y_true", score: str = "score") -> DataFrame:
    """Per group: accuracy, precision, recall and F1 to 4 digits, AUC, and the same at another threshold under ``thresh{t}_`` names."""
    out = binary_metrics(df, threshold, by, truth, score).join(roc_auc(df, by, truth, score), list(by))
    if other is not None:
        more = binary_metrics(df, other, by, truth, score)
        out = out.join(more.select(*by, *[F.col(c).alias(f"thresh{other}_{c}") for c in ("accuracy", "precision", "recall", "f1")]), list(by))
    return out.select(*by, *[F.round(c, 4).alias(c) if "." not in c else F.round(F.col(f"`{c}`"), 4).alias(c.replace(".", "_")) for c in out.columns if c not in by])


def split_metrics(df: DataFrame, column: str, threshold: float = 0.5, truth: str = "y_true", score: str = "score") -> DataFrame:
    """Metrics above and up to the median of a column."""
    cut = quantile(df, column, 0.5, "cut")
    halves = df.join(F.broadcast(cut), F.lit(True)).withColumn("half", F.when(F.col(column) > F.col("cut"), "above").otherwise("below"))  # one row
    return binary_metrics(halves, threshold, ["half"], truth, score)


def cloudy_months(df: DataFrame, values: str, cutoffs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Mean number of array entries above each cutoff, by group."""
    above = lambda cut: F.size(F.filter(values, lambda x: x > cut))
    return df.groupBy(*by).agg(*[F.avg(above(c)).alias(f"above_{int(c * 100)}") for c in cutoffs])
