"""Confusion counts and the rates that follow from them, for any number of groups in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, ref: str = "ref_class", pred: str = "map_class", by: Sequence[str] = (), classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(by, ref_class, map_class, n): counts of pairs of classes, with a zero for each pair of ``classes`` that a group lacks.

    Rows with a class outside ``classes`` or a null one do not count. One shuffle: counts of a group are spread over the pairs by
    an explode and not by a join.
    """
    keys = [F.col(c) for c in by]
    counted = df.filter(F.col(ref).isin(*classes) & F.col(pred).isin(*classes))
    cells = [(i, j) for i in classes for j in classes]
    each = [F.count_if((F.col(ref) == i) & (F.col(pred) == j)).alias(f"n_{i}_{j}") for i, j in cells]
    wide = counted.groupBy(*keys).agg(*each)
    rows = F.array(*[F.struct(F.lit(i).alias("ref_class"), F.lit(j).alias("map_class"), F.col(f"n_{i}_{j}").alias("n")) for i, j in cells])
    return wide.select(*by, F.explode(rows).alias("c")).select(*by, "c.ref_class", "c.map_class", "c.n")


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def cm_rates(cm: DataFrame, by: Sequence[str] = (), strict_reference: bool = False) -> DataFrame:
    """(by, class, fpr, tpr, accuracy) of each class against all others; ``strict_reference``: accuracy is (tp + fn) / total."""
    over = Window.partitionBy(*by)
    of_ref, of_map = Window.partitionBy(*by, "ref_class"), Window.partitionBy(*by, "map_class")
    rows = cm.withColumns({"row_sum": F.sum("n").over(of_ref), "col_sum": F.sum("n").over(of_map), "total": F.sum("n").over(over)}).filter("ref_class = map_class")
    tp, fn, fp = F.col("n"), F.col("row_sum") - F.col("n"), F.col("col_sum") - F.col("n")
    tn = F.col("total") - tp - fn - fp
    right = tp + fn if strict_reference else tp + tn
    return rows.select(*by, F.col("ref_class").alias("class"), ratio(fp, fp + tn).alias("fpr"), ratio(tp, tp + fn).alias("tpr"), ratio(right, F.col("total")).alias("accuracy"))


def binary_metrics(df: DataFrame, threshold: float, by: Sequence[str] = (), truth: str = "y_true", score: str = "score") -> DataFrame:
    """accuracy, precision, recall and F1 at ``score > threshold``; 0 where a denominator is 0."""
    p, y = F.coalesce(F.col(score) > threshold, F.lit(False)), F.col(truth) == 1
    counts = df.groupBy(*by).agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))
    return counts.select(*by, *rates_of(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def rates_of(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    return [ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def error_breakdown(df: DataFrame, category: str, ref: str = "ref_class", pred: str = "map_class") -> DataFrame:
    """(outcome, category, n): true and false positives and negatives by a category."""
    r, p = F.col(ref) == 1, F.col(pred) == 1
    outcome = F.when(r & p, "TP").when(~r & p, "FP").when(r & ~p, "FN").otherwise("TN")
    return df.groupBy(outcome.alias("outcome"), F.col(category).alias("category")).agg(F.count("*").alias("n"))


def compute_change(df: DataFrame, truth: Column, before: Column, after: Column) -> DataFrame:
    """What a change of predictions did: how many changed, to right and to wrong, F1 and accuracy before and after."""
    cell = lambda p, a, b: F.count_if((p == a) & (truth == b))
    counted = df.agg(
        F.count_if(before != after).alias("changed"), F.count_if((before != after) & (after == truth)).alias("corrected"), F.count_if((before != after) & (after != truth)).alias("broken"),
        *[cell(p, a, b).alias(f"{n}{a}{b}") for n, p in (("b", before), ("a", after)) for a in (0, 1) for b in (0, 1)],
    )
    f1 = lambda n: ratio(2 * F.col(f"{n}11"), 2 * F.col(f"{n}11") + F.col(f"{n}10") + F.col(f"{n}01"))
    acc = lambda n: ratio(F.col(f"{n}11") + F.col(f"{n}00"), F.col(f"{n}11") + F.col(f"{n}00") + F.col(f"{n}10") + F.col(f"{n}01"))
    return counted.select("changed", "corrected", "broken", f1("b").alias("f1_before"), f1("a").alias("f1_after"), acc("b").alias("accuracy_before"), acc("a").alias("accuracy_after"))
