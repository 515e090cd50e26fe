"""Area estimates of regions and years from end to end: clip, agreement of label sets, confusion, estimates, tables of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.operators.confusion import cm_rates, confusion
from landstat.operators.estimators import area_estimate, map_report
from landstat.operators.labels import answer_to_class, few
from landstat.operators.points import join_regions
from landstat.operators.raster import attach_map_values, binarize, clip_pixels, ensemble_vote, sample_raster, with_crop_flag

JOB = "roi string, year int, map string, set1 int, set2 int"
MOST_JOBS = 100_000  # rows of a configuration that is broadcast


def area_jobs(spark: SparkSession, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """The configuration of a run (roi, year, map, set1, set2) as a table. A region and year may occur once."""
    columns = [c.split()[0] for c in JOB.split(", ")]
    keys = [(r["roi"], r["year"]) for r in rows]
    if len(set(keys)) < len(keys):
        raise ValueError("a region and year occurs twice")
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], JOB)


def first_answers(annotations: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """(by, lon, lat, class): the first answer of each group in a stated order, combined before the only shuffle."""
    row = F.struct("lon", "lat", answer_to_class(F.col("answer")).alias("class"))
    return annotations.groupBy(*by).agg(F.min_by(row, order).alias("_first")).select(*by, "_first.*")


def reference_agreement(s1: DataFrame, s2: DataFrame, pixels: DataFrame, meta: dict[str, float], key: str = "plotid", order: str = "file_ord", keep: Sequence[str] = ()) -> DataFrame:
    """Plots to which both sets give one known class, and the class of the map there: key, lon, lat, keep, ref_class, map_class.

    The sets (key, lon, lat, answer, order) meet by key. Several rows of a key: the first in ``order`` counts. Plots outside the
    map and on nodata go. With ``keep`` columns of ``pixels`` (map, year), a plot has a row for each of them.
    """
    tagged = s1.select(key, "lon", "lat", "answer", order).withColumn("_set", F.lit(1)).unionByName(s2.select(key, "lon", "lat", "answer", order).withColumn("_set", F.lit(2)))
    row = F.struct("lon", "lat", answer_to_class(F.col("answer")).alias("class"))
    of = lambda k: F.min_by(row, F.when(F.col("_set") == k, F.col(order)))
    both = tagged.groupBy(key).agg(of(1).alias("_a"), of(2).alias("_b")).filter("_a.class = _b.class")
    return _mapped(both.select(key, "_a.lon", "_a.lat", F.col("_a.class").alias("ref_class")), pixels, meta, keep)


def _mapped(plots: DataFrame, pixels: DataFrame, meta: dict[str, float], keep: Sequence[str]) -> DataFrame:
    known = pixels.withColumn("value", binarize(F.col("value"))).filter(F.col("value").isNotNull())
    return sample_raster(plots, known, meta, keep=keep).filter(F.col("value").isNotNull()).withColumnRenamed("value", "map_class").drop("row", "col")


def mapped_pixels(pixels: DataFrame, meta: dict[str, float], regions: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, map_class, px): pixels of each class of a region; ``by`` holds columns of regions and pixels. Nodata does not count."""
    known = pixels.withColumn("map_class", binarize(F.col("value"))).filter(F.col("map_class").isNotNull())
    return clip_pixels(known, meta, regions).groupBy(*by, "map_class").agg(F.count("*").alias("px"))


def estimate_area(pixels: DataFrame, meta: dict[str, float], regions: DataFrame, s1: DataFrame, s2: DataFrame, px_size: float, region: str = "region") -> DataFrame:
    """Area and accuracy of each class of each region, with intervals, from a map and two label sets, in one plan."""
    agreed = join_regions(reference_agreement(s1, s2, pixels, meta), regions)
    return area_estimate(confusion(agreed, by=[region]), mapped_pixels(pixels, meta, regions, [region]), px_size, [region])


def estimate_areas(jobs: DataFrame, pixels: DataFrame, meta: dict[str, float], regions: DataFrame, annotations: DataFrame, px_size: float, order: str = "file_ord") -> DataFrame:
    """``area_estimate`` of every job by (roi, year): all regions and years in one plan.

    ``jobs`` as in ``area_jobs``; pixels (map, row, col, value); regions (roi, ring or parts); annotations (set_id, plotid, lon, lat,
    answer, order). Each set is reduced once and each map clipped once, whatever the number of years that use it.
    """
    plan = few(jobs, MOST_JOBS)
    sets = few(jobs.select("set1", "set2").distinct(), MOST_JOBS)
    used = few(jobs.select("map").distinct(), MOST_JOBS)
    first = first_answers(annotations, ["set_id", "plotid"], F.col(order)).filter(F.col("class").isNotNull())
    one = first.withColumnsRenamed({"set_id": "set1", "class": "ref_class"}).join(sets, "set1")
    two = first.select(F.col("set_id").alias("set2"), "plotid", F.col("class").alias("_other"))
    both = one.join(two, ["set2", "plotid"]).filter(F.col("ref_class") == F.col("_other")).drop("_other")
    maps = pixels.join(used, "map", "left_semi")
    agreed = join_regions(_mapped(both, maps, meta, ["map"]), regions).join(plan, ["roi", "map", "set1", "set2"])
    px = mapped_pixels(maps, meta, regions, ["roi", "map"]).join(plan, ["roi", "map"])
    by = ["roi", "year"]
    return area_estimate(confusion(agreed, by=by), px.select(*by, "map_class", "px"), px_size, by)


def area_results(estimates: DataFrame, rois: Sequence[str], digits: int = 2) -> DataFrame:
    """One row a year (all years of any region), four columns a region: crop and non-crop hectares with their 95 % intervals."""
    of = lambda roi, k, c: F.round(F.max(F.when((F.col("roi") == roi) & (F.col("class") == k), F.col(c))), digits)
    columns = [of(r, k, c).alias(f"{r} {name}") for r in rois for k, c, name in ((1, "area_ha", "crop area"), (1, "ci_ha", "95% CI crop"), (0, "area_ha", "Non-crop area"), (0, "ci_ha", "95% CI noncrop"))]
    return estimates.groupBy(F.col("year").alias("Year")).agg(*columns)


def write_area_results(estimates: DataFrame, path: str, rois: Sequence[str], digits: int = 2) -> None:
    """``area_results`` as one CSV file with a header, by year; one row a year, so a single task writes it."""
    area_results(estimates, rois, digits).orderBy("Year").coalesce(1).write.mode("overwrite").csv(path, header=True)


MEASURES = {"area_ha": "Estimated area [ha]", "ci_ha": "95% CI of area [ha]", "u": "User's accuracy", "ci_u": "95% CI of user acc.", "p": "Producer's accuracy", "ci_p": "95% CI of prod acc."}
RATES = {"fpr": "False Positive Rate", "tpr": "True Positive Rate", "accuracy": "Accuracy"}


def _table(frame: DataFrame, by: Sequence[str], names: Mapping[str, str], classes: Mapping[int, str]) -> DataFrame:
    """(by, metric, a column a class) of a frame with one row a class."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).alias("value")) for c, n in names.items()])).alias("m")
    long = frame.select(*by, "class", each).select(*by, "class", "m.*")
    return long.groupBy(*by, "metric").agg(*[F.max(F.when(F.col("class") == k, F.col("value"))).alias(n) for k, n in classes.items()])


def area_summary(estimates: DataFrame, by: Sequence[str] = (), classes: Mapping[int, str] | None = None) -> DataFrame:
    """(by, metric, one column a class): areas, accuracies and their intervals."""
    return _table(estimates, by, MEASURES, classes or {0: "Non-Crop", 1: "Crop"})


def cm_summary(cm: DataFrame, by: Sequence[str] = (), classes: Mapping[int, str] | None = None, strict_reference: bool = False) -> DataFrame:
    """(by, metric, one column a class): false and true positive rate and accuracy of each class against the others."""
    return _table(cm_rates(cm, by, strict_reference), by, RATES, classes or {0: "Non-Crop", 1: "Crop"})


def compared_maps(points: DataFrame, values: DataFrame, catalog: DataFrame, maps: Sequence[str], ensemble: Sequence[str] = (), key: str = "id") -> DataFrame:
    """Points (key, ref_class, ...) once for each map, with ``dataset`` and ``map_class``; the vote of ``ensemble`` maps is one more map."""
    crop = with_crop_flag(values, catalog).select(key, "map", F.col("crop").alias("value"))
    wide = attach_map_values(points, crop, maps, key)
    wide = wide.withColumn("ensemble", ensemble_vote(wide, ensemble)) if ensemble else wide
    names = [*maps, "ensemble"] if ensemble else list(maps)
    return wide.select(*points.columns, F.explode(F.array(*[F.struct(F.lit(m).alias("dataset"), F.col(m).cast("int").alias("map_class")) for m in names])).alias("_m")).select(*points.columns, "_m.*")


def intercompare(points: DataFrame, values: DataFrame, catalog: DataFrame, maps: Sequence[str], ensemble: Sequence[str] = (), mapped: DataFrame | None = None, by: str = "country", key: str = "id") -> DataFrame:
    """``map_report`` of every map, and of the ensemble's vote, in every country, in one plan.

    ``mapped`` (dataset, by, map_class, px) weights the classes by their area; without it each point stands for one pixel.
    """
    long = compared_maps(points, values, catalog, maps, ensemble, key)
    groups = ["dataset", by]
    px = mapped if mapped is not None else long.groupBy(*groups, "map_class").agg(F.count("*").alias("px"))
    return map_report(confusion(long, by=groups), px, groups)


def with_map_attrs(results: DataFrame, attrs: DataFrame, label_year: Column | int, key: str = "dataset", most: int = 10_000) -> DataFrame:
    """``results`` with the attributes of their map (one row a map) and ``mismatch``: years between the map and its labels."""
    year = F.lit(label_year) if isinstance(label_year, int) else label_year
    return results.join(few(attrs, most), key).withColumn("mismatch", F.abs(F.col("year") - year))
