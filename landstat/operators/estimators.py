"""Design-based area and accuracy estimates from confusion counts, by groups.

Inputs: ``cm`` (by, ref_class, map_class, n), every pair of classes present, and ``mapped`` (by, map_class, px), the mapped pixels
of each class. Sums over classes are windows over the long table, which stays as small as the number of groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landstat.operators.confusion import ratio

Z = 1.96


def _over(by: Sequence[str], *more: str):
    return Window.partitionBy(*by, *more)


def area_error_matrix(cm: DataFrame, mapped: DataFrame, by: Sequence[str] = (), area_weighted: bool = True) -> DataFrame:
    """``cm`` with px (mapped pixels), w (their share), n_j (samples of the map class) and p (area proportion; 0 for a class never sampled).

    Without ``area_weighted`` p is the share of samples and w is 1. Accepts ``mapped`` without some class: its px is 0.
    """
    own = mapped.withColumn("px", F.col("px").cast("double"))
    keys = [*by, "map_class"]
    rows = cm.join(own, keys, "left").fillna(0.0, ["px"])
    rows = rows.withColumns({"n_j": F.sum("n").over(_over(by, "map_class")), "one": F.row_number().over(_over(by, "map_class").orderBy("ref_class"))})
    rows = rows.withColumn("total_px", F.sum(F.when(F.col("one") == 1, F.col("px"))).over(_over(by))).withColumn("w", ratio(F.col("px"), F.col("total_px")))
    if not area_weighted:
        return rows.withColumns({"w": F.lit(1.0), "p": ratio(F.col("n"), F.sum("n").over(_over(by)))}).drop("one")
    return rows.withColumn("p", ratio(F.col("w") * F.col("n"), F.col("n_j"))).drop("one")


def users_accuracy(am: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, class, u): p_jj / p_.j, 0 for 0/0."""
    return am.groupBy(*by, F.col("map_class").alias("class")).agg(ratio(F.sum(F.when(F.col("ref_class") == F.col("map_class"), F.col("p"))), F.sum("p")).alias("u"))


def var_users_accuracy(am: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, class, var_u): u (1 - u) / (n_j - 1), null with a single sample."""
    own = am.groupBy(*by, F.col("map_class").alias("class")).agg(ratio(F.sum(F.when(F.col("ref_class") == F.col("map_class"), F.col("p"))), F.sum("p")).alias("u"), F.sum("n").alias("n_j"))
    return own.select(*by, "class", F.try_divide(F.col("u") * (1 - F.col("u")), F.col("n_j") - 1).alias("var_u"))


def producers_accuracy(am: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, class, p): p_ii / p_i., 0 for 0/0."""
    return am.groupBy(*by, F.col("ref_class").alias("class")).agg(ratio(F.sum(F.when(F.col("ref_class") == F.col("map_class"), F.col("p"))), F.sum("p")).alias("p"))


def class_estimates(am: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: u, var_u, p, var_p (Olofsson et al. 2014, equation 7), area proportion a, its standard error se_a, n_j, w, px.

    A variance is null where a map class that it needs has one sample, as its n_j - 1 is 0.
    """
    of_map, of_ref = _over(by, "map_class"), _over(by, "ref_class")
    same = F.col("ref_class") == F.col("map_class")
    x = am.withColumns({"p_j": F.sum("p").over(of_map), "p_i": F.sum("p").over(of_ref)})
    x = x.withColumn("u_j", ratio(F.sum(F.when(same, F.col("p"))).over(of_map), F.col("p_j"))).withColumn("pa_i", ratio(F.sum(F.when(same, F.col("p"))).over(of_ref), F.col("p_i")))
    share = ratio(F.col("n"), F.col("n_j"))
    less = F.col("n_j") - 1
    px = F.floor("px").cast("double")
    other = F.when(~same, F.try_divide(px * px * share * (1 - share), less))
    own = F.when(same, F.try_divide(px * px * (1 - F.col("pa_i")) * (1 - F.col("pa_i")) * F.col("u_j") * (1 - F.col("u_j")), less))
    missing = lambda c: F.count_if(c & (F.col("n_j") == 1)) > 0
    rows = x.groupBy(*by, F.col("ref_class").alias("class")).agg(
        F.max(F.when(same, F.col("u_j"))).alias("u"),
        F.max(F.when(same, F.try_divide(F.col("u_j") * (1 - F.col("u_j")), less))).alias("var_u"),
        F.max("pa_i").alias("p"),
        F.floor(F.sum(ratio(F.col("px") * F.col("n"), F.col("n_j")))).cast("double").alias("n_i"),
        F.coalesce(F.sum(other), F.lit(0.0)).alias("others"),
        F.max(own).alias("own"),
        missing(F.lit(True)).alias("single"),
        F.max("p_i").alias("a"),
        F.sum(F.try_divide(F.col("w") * F.col("p") - F.col("p") * F.col("p"), less)).alias("var_a"),
        F.max(F.when(same, F.col("n_j"))).alias("n_j"),
        F.max(F.when(same, F.col("w"))).alias("w"),
        F.max("total_px").alias("total_px"),
    )
    var_p = ratio(F.lit(1.0), F.col("n_i") * F.col("n_i")) * (F.col("own") + F.col("p") * F.col("p") * F.col("others"))
    return rows.withColumn("var_p", F.when(~F.col("single"), var_p)).withColumn("se_a", F.when(~F.col("single"), F.sqrt(F.greatest(F.lit(0.0), F.col("var_a"))))).drop("var_a", "others", "own", "n_i", "single")


def overall_accuracy(am: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, acc, var_acc): the sum of p_ii, and of w^2 u (1 - u) / (n_j - 1)."""
    each = class_estimates(am, by)
    acc = am.groupBy(*by).agg(F.sum(F.when(F.col("ref_class") == F.col("map_class"), F.col("p"))).alias("acc"))
    var = each.groupBy(*by).agg(F.when(F.count_if(F.col("var_u").isNull()) == 0, F.sum(F.col("w") * F.col("w") * F.col("var_u"))).alias("var_acc"))
    return acc.join(var, list(by)) if by else acc.join(var, F.lit(True))


def area_estimate(cm: DataFrame, mapped: DataFrame, px_size: float, by: Sequence[str] = ()) -> DataFrame:
    """Per class: accuracies and area (share, pixels, hectares), each with its 95 % interval; accuracy of the whole map beside them."""
    am = area_error_matrix(cm, mapped, by)
    each = class_estimates(am, by)
    over = _over(by)
    right = F.sum(F.col("u") * F.col("w")).over(over)  # p_jj = u_j w_j for sampled classes
    each = each.withColumn("acc", right).withColumn("ci_acc", Z * F.sqrt(F.when(F.count_if(F.col("var_u").isNull()).over(over) == 0, F.sum(F.col("w") * F.col("w") * F.col("var_u")).over(over))))
    ha = px_size * px_size / 10_000
    return each.select(
        *by, "class", "u", (Z * F.sqrt("var_u")).alias("ci_u"), "p", (Z * F.sqrt("var_p")).alias("ci_p"), "acc", "ci_acc", F.col("a").alias("area_pr"), (Z * F.col("se_a")).alias("ci_pr"),
        (F.col("a") * F.col("total_px")).alias("area_px"), (Z * F.col("se_a") * F.col("total_px")).alias("ci_px"), (F.col("a") * F.col("total_px") * ha).alias("area_ha"), (Z * F.col("se_a") * F.col("total_px") * ha).alias("ci_ha"),
    )


def required_samples(fractions: DataFrame, by: Sequence[str] = (), standard_error: float = 0.02, strict_reference: bool = False) -> DataFrame:
    """(by, n, n_crop, n_noncrop) for crop and non-crop fractions ``f_crop``, ``f_noncrop`` and expected accuracies ``u_crop``, ``u_noncrop``.

    n is the square of (sum of f sqrt(u (1 - u))) / standard_error, rounded half to even. ``strict_reference`` uses the product
    of u_noncrop and 1 - u_crop for the non-crop class.
    """
    uc, un = F.col("u_crop"), F.col("u_noncrop")
    s = F.col("f_crop") * F.sqrt(uc * (1 - uc)) + F.col("f_noncrop") * F.sqrt(un * (1 - (uc if strict_reference else un)))
    n = F.bround(F.pow(s / standard_error, F.lit(2.0)), 0).cast("long")
    half = F.floor(n / 2).cast("long")
    return fractions.select(*by, n.alias("n"), half.alias("n_crop"), (n - half).alias("n_noncrop"))


def f1_of(r: Column, p: Column) -> Column:
    return ratio(2 * p * r, p + r)


def f1_se(r: Column, p: Column, dr: Column, dp: Column) -> Column:
    """The propagated standard error of F1; null where precision and recall are both 0."""
    return F.try_divide(2 * (r * dp + p * dr), p + r) + F.try_divide(2 * p * r * (dp + dr), (p + r) * (p + r))


def map_report(cm: DataFrame, mapped: DataFrame, by: Sequence[str], area_weighted: bool = True) -> DataFrame:
    """The 24 columns of the map comparison, one row a group, rounded to 2 digits. Classes are 0 (non-crop) and 1 (crop)."""
    am = area_error_matrix(cm, mapped, by, area_weighted)
    each = class_estimates(am, by)
    one = lambda c, k: F.max(F.when(F.col("class") == k, F.col(c)))
    rates = each.groupBy(*by).agg(
        *[one(c, k).alias(f"{c}{k}") for c in ("u", "p", "var_u", "var_p") for k in (0, 1)],
        F.when(F.count_if(F.col("var_u").isNull()) == 0, F.sum(F.col("w") * F.col("w") * F.col("var_u"))).alias("var_acc"),
    )
    at = lambda c, i, j: F.sum(F.when((F.col("ref_class") == i) & (F.col("map_class") == j), F.col(c)))
    names = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = am.groupBy(*by).agg(*[at("n", *ij).alias(k) for k, ij in names.items()], *[at("p", *ij).alias(f"{k}_area") for k, ij in names.items()])
    se = lambda c: F.sqrt(F.col(c))
    report = {
        "crop_f1": f1_of(F.col("p1"), F.col("u1")), "std_crop_f1": f1_se(F.col("p1"), F.col("u1"), se("var_p1"), se("var_u1")),
        "accuracy": F.col("tn_area") + F.col("tp_area"), "std_acc": se("var_acc"), "crop_recall_pa": F.col("p1"), "std_crop_pa": se("var_p1"),
        "noncrop_recall_pa": F.col("p0"), "std_noncrop_pa": se("var_p0"), "crop_precision_ua": F.col("u1"), "std_crop_ua": se("var_u1"),
        "noncrop_precision_ua": F.col("u0"), "std_noncrop_ua": se("var_u0"), "crop_support": F.col("tp") + F.col("fn"), "noncrop_support": F.col("tn") + F.col("fp"),
    }
    whole = ("crop_support", "noncrop_support", "tn", "fp", "fn", "tp")
    columns = [(c if n in whole else F.round(c, 2) + 0.0).alias(n) for n, c in report.items()] + [F.col(n) for n in names] + [(F.round(F.col(f"{n}_area"), 2) + 0.0).alias(f"{n}_area") for n in names]
    return rates.join(counts, list(by)).select(*by, *columns)


def stehman_indicators(df: DataFrame, target: int, ref: str = "ref_class", pred: str = "map_class") -> DataFrame:
    """``df`` with the indicators of Stehman (2014) for a target class: oa_y, area_y, ua_y, ua_x, pa_y, pa_x (doubles)."""
    r, m = F.col(ref) == target, F.col(pred) == target
    return df.withColumns({k: v.cast("double") for k, v in {"oa_y": F.col(ref) == F.col(pred), "area_y": r, "ua_y": r & m, "ua_x": m, "pa_y": r & m, "pa_x": r}.items()})


def stratum_moments(indicators: DataFrame, by: Sequence[str] = ("stratum",)) -> DataFrame:
    """Means, sample variances and covariances of the indicators in each stratum, and the number of samples n."""
    cols = ("oa_y", "area_y", "ua_y", "ua_x", "pa_y", "pa_x")
    return indicators.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols], *[F.var_samp(c).alias(f"var_{c}") for c in cols], F.covar_samp("ua_y", "ua_x").alias("cov_ua"), F.covar_samp("pa_y", "pa_x").alias("cov_pa"))


def stehman(moments: DataFrame, by: Sequence[str] = (), strict_reference: bool = False) -> DataFrame:
    """ua, pa, oa and area with their standard errors, from moments with ``size`` (units in the stratum).

    Strata of one sample have no variance and add nothing to a standard error. ``strict_reference``: the errors of ua and pa by
    the formula for means rather than for ratios.
    """
    size, n = F.col("size").cast("double"), F.col("n")
    total = lambda c: F.sum(F.col(c) * size)
    point = moments.groupBy(*by).agg(*[total(f"mean_{c}").alias(c) for c in ("oa_y", "area_y", "ua_y", "ua_x", "pa_y", "pa_x")], F.sum(size).alias("all"),
        *[F.sum(size * size * F.col(f"var_{c}") / n).alias(f"v_{c}") for c in ("oa_y", "area_y", "ua_y", "ua_x", "pa_y", "pa_x")], *[F.sum(size * size * F.col(c) / n).alias(c) for c in ("cov_ua", "cov_pa")])

    def se(k: str) -> Column:
        r = F.try_divide(F.col(f"{k}_y"), F.col(f"{k}_x"))
        if strict_reference:
            return F.sqrt(F.col(f"v_{k}_y")) / F.col("all")
        return F.try_divide(F.sqrt(F.greatest(F.lit(0.0), F.col(f"v_{k}_y") + r * r * F.col(f"v_{k}_x") - 2 * r * F.col(f"cov_{k}"))), F.col(f"{k}_x"))

    return point.select(*by, F.try_divide("ua_y", "ua_x").alias("ua"), se("ua").alias("ua_se"), F.try_divide("pa_y", "pa_x").alias("pa"), se("pa").alias("pa_se"), (F.col("oa_y") / F.col("all")).alias("oa"), (F.sqrt("v_oa_y") / F.col("all")).alias("oa_se"), (F.col("area_y") / F.col("all")).alias("area"), (F.sqrt("v_area_y") / F.col("all")).alias("area_se"))


def stehman_report(df: DataFrame, sizes: DataFrame, by: Sequence[str] = (), stratum: str = "stratum", strict_reference: bool = False) -> DataFrame:
    """One row a group: crop and non-crop accuracies, F1, overall accuracy and crop area, with standard errors."""
    keys = [*by, stratum]

    def of(target: int, strict: bool) -> DataFrame:
        return stehman(stratum_moments(stehman_indicators(df, target), keys).join(sizes, keys), by, strict)

    crop = of(1, False)
    other = of(0, strict_reference).select(*by, F.col("ua").alias("non_crop_ua"), F.col("pa").alias("non_crop_pa"), F.col("ua_se").alias("non_crop_ua_se"), F.col("pa_se").alias("non_crop_pa_se"))
    both = crop.join(other, list(by)) if by else crop.join(other, F.lit(True))
    return both.select(*by, F.col("ua").alias("crop_ua"), F.col("ua_se").alias("crop_ua_se"), F.col("pa").alias("crop_pa"), F.col("pa_se").alias("crop_pa_se"), "oa", "oa_se",
        f1_of(F.col("pa"), F.col("ua")).alias("crop_f1_score"), f1_se(F.col("pa"), F.col("ua"), F.col("pa_se"), F.col("ua_se")).alias("crop_f1_score_se"), "non_crop_ua", "non_crop_pa", "non_crop_ua_se", "non_crop_pa_se",
        F.col("area").alias("crop_area_proportion"), F.col("area_se").alias("crop_area_proportion_se"))
