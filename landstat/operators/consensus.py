"""Agreement between labelers: pairs of sets, who was overridden, transitions and durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstat.operators.metrics import quantile


def duration_secs(c: Column) -> Column:
    """``12.3 secs`` as seconds; null for anything else."""
    return F.split(c, " ")[0].try_cast("double")


def pair_sets(s1: DataFrame, s2: DataFrame, final: DataFrame | None = None, keys: Sequence[str] = ("plotid", "sampleid"), final_keys: Sequence[str] = ("plotid",)) -> DataFrame:
    """Two sets side by side (answer, email, seconds with suffixes 1 and 2), with the final answer if given. One row a plot and set is expected."""
    one = lambda df, n: df.select(*keys, F.col("answer").alias(f"answer{n}"), F.col("email").alias(f"email{n}"), duration_secs(F.col("analysis_duration")).alias(f"secs{n}"))
    both = one(s1, 1).join(one(s2, 2), list(keys))
    return both if final is None else both.join(final.select(*final_keys, F.col("answer").alias("final")), list(final_keys))


def change_class(y1: Column, y2: Column) -> Column:
    """0..3 for no planting, gain, loss and stable planting over two years (classes 0 and 1); null where either is unknown."""
    return y1 * 2 + y2


def change_name(y1: Column, y2: Column) -> Column:
    return F.when((y1 == 1) & (y2 == 1), "Stable P").when((y1 == 0) & (y2 == 0), "Stable NP").when((y1 == 1) & (y2 == 0), "P loss").when((y1 == 0) & (y2 == 1), "P gain")


def disagree(a: Column, b: Column) -> Column:
    """Whether two answers differ; a missing answer differs from everything, another missing one too."""
    return ~F.coalesce(a == b, F.lit(False))


def agreement_summary(paired: DataFrame) -> DataFrame:
    """Plots, agreement rate, missing answers of each set."""
    return paired.agg(F.count("*").alias("n"), F.avg((~disagree(F.col("answer1"), F.col("answer2"))).cast("double")).alias("agreement"), F.count_if(F.col("answer1").isNull()).alias("missing1"), F.count_if(F.col("answer2").isNull()).alias("missing2"))


def consensus(paired: DataFrame) -> DataFrame:
    """Disagreeing plots with the side that the final answer overrode: ``2`` if set 1 had it, ``1`` if set 2 had it, ``both`` if none.

    overridden_label and overridden_email name that side and are null for both sides; overridden_secs is its duration, kept_secs
    the other's.
    """
    rows = paired.filter(disagree(F.col("answer1"), F.col("answer2")))
    side = F.when(F.coalesce(F.col("answer1") == F.col("final"), F.lit(False)), "2").when(F.coalesce(F.col("answer2") == F.col("final"), F.lit(False)), "1").otherwise("both")
    pick = lambda c: F.when(F.col("overridden_side") == "1", F.col(f"{c}1")).when(F.col("overridden_side") == "2", F.col(f"{c}2"))
    other = F.when(F.col("overridden_side") == "1", F.col("secs2")).when(F.col("overridden_side") == "2", F.col("secs1"))
    return rows.withColumn("overridden_side", side).withColumns({"overridden_label": pick("answer"), "overridden_email": pick("email"), "overridden_secs": pick("secs"), "kept_secs": other})


def _overridden(column: str) -> Column:
    """The overridden values of a row: both sides' if both were overridden."""
    both = F.array(F.col(f"{column}1"), F.col(f"{column}2"))
    return F.explode(F.when(F.col("overridden_side") == "both", both).when(F.col("overridden_side") == "1", F.slice(both, 1, 1)).otherwise(F.slice(both, 2, 1)))


def label_overrides(c: DataFrame) -> DataFrame:
    return c.select(_overridden("answer").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def label_mistakes(c: DataFrame) -> DataFrame:
    return c.groupBy(F.col("final").alias("label")).agg(F.count("*").alias("n"))


def label_disagreements(c: DataFrame) -> DataFrame:
    """Unordered pairs of differing answers; a missing answer is ``none``."""
    a, b = F.coalesce("answer1", F.lit("none")), F.coalesce("answer2", F.lit("none"))
    return c.groupBy(F.least(a, b).alias("label_a"), F.greatest(a, b).alias("label_b")).agg(F.count("*").alias("n"))


def label_transitions(c: DataFrame) -> DataFrame:
    return c.select(_overridden("answer").alias("label"), "final").groupBy("label", "final").agg(F.count("*").alias("n"))


def labeler_overrides(c: DataFrame) -> DataFrame:
    """Overrides of each labeler, most first."""
    return c.select(_overridden("email").alias("email")).groupBy("email").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "email")


def median_durations(c: DataFrame) -> DataFrame:
    both = [quantile(c, f"{k}_secs", 0.5, k) for k in ("overridden", "kept")]
    return both[0].join(F.broadcast(both[1]), F.lit(True))  # one row each


def pooled_quantile(c: DataFrame, q: float, approx: bool = False) -> DataFrame:
    """The q-quantile of the durations of both sides, by linear interpolation or (``approx``) by a bounded sketch."""
    pooled = c.select(F.explode(F.array("secs1", "secs2")).alias("secs"))
    return pooled.agg(F.percentile_approx("secs", q, 10_000).alias("secs")) if approx else quantile(pooled, "secs", q, "secs")


def slow_points(c: DataFrame, q: float, approx: bool = False) -> DataFrame:
    """Rows in which either side took at least the q-quantile of all durations."""
    cut = pooled_quantile(c, q, approx).select(F.col("secs").alias("cut"))
    return c.join(F.broadcast(cut), (F.col("secs1") >= F.col("cut")) | (F.col("secs2") >= F.col("cut"))).drop("cut")  # one row


def outer_counts(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Counts of a key in several frames side by side (n1, n2, ...), 0 where it is missing. One shuffle of counts."""
    tagged = [df.groupBy(key).agg(F.count("*").alias("n")).withColumn("k", F.lit(i + 1)) for i, df in enumerate(frames)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out.groupBy(key).agg(*[F.sum(F.when(F.col("k") == i + 1, F.col("n")).otherwise(0)).alias(f"n{i + 1}") for i in range(len(frames))])


def labeler_disagreement(df: DataFrame, labelers: str = "labelers", prob: str = "class_probability") -> DataFrame:
    """Per labeler of comma-joined lists: labels, labels with probability 0.5, and their ratio, highest first."""
    each = df.select(F.explode(F.split(labelers, ",")).alias("labeler"), F.col(prob).alias("p")).groupBy("labeler")
    return each.agg(F.count("*").alias("n"), F.count_if(F.col("p") == 0.5).alias("n_disagree")).withColumn("ratio", F.col("n_disagree") / F.col("n")).orderBy(F.desc("ratio"), "labeler")


def distinct_labelers(df: DataFrame, by: Sequence[str], approx: bool = True) -> DataFrame:
    return df.groupBy(*by).agg((F.approx_count_distinct("email") if approx else F.count_distinct("email")).alias("labelers"))


def compare_exports(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in both exports, share with equal answers, share at the same place."""
    one = lambda df, n: df.select(*keys, *[F.col(c).alias(f"{c}{n}") for c in ("answer", "lat", "lon")])
    same = lambda c: F.coalesce(F.col(f"{c}1") == F.col(f"{c}2"), F.lit(False))
    return one(a, 1).join(one(b, 2), list(keys)).agg(F.count("*").alias("n"), F.avg(same("answer").cast("double")).alias("same_answer"), F.avg((same("lat") & same("lon")).cast("double")).alias("same_place"))


def resolve_labels(s1: DataFrame, s2: DataFrame, trusted1: Sequence[str], trusted2: Sequence[str], override: DataFrame | None = None, min_lon: float | None = None, key: str = "plotid") -> DataFrame:
    """One label a plot: the override; else what both sets say; else set 1 where set 2 is blank; else a trusted labeler of set 1, then
    of set 2. Plots without any of these go, and those west of ``min_lon``.
    """
    one = lambda df, n: df.select(key, *[F.col(c).alias(f"{c}{n}") for c in ("answer", "email", "lon")])
    rows = one(s1, 1).join(one(s2, 2), key)
    rows = rows.join(override.select(key, F.col("answer").alias("override")), key, "left") if override is not None else rows.withColumn("override", F.lit(None).cast("string"))
    label = F.coalesce(
        "override", F.when(F.col("answer1") == F.col("answer2"), F.col("answer1")), F.when(F.col("answer2").isNull(), F.col("answer1")),
        F.when(F.col("email1").isin(*trusted1), F.col("answer1")), F.when(F.col("email2").isin(*trusted2), F.col("answer2")),
    )
    out = rows.withColumn("label", label).filter(F.col("label").isNotNull())
    return (out if min_lon is None else out.filter(F.col("lon1") >= min_lon)).select(key, "label")
