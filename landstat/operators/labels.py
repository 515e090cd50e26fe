"""Label rules and label tables: from raw rows of many sources to one schema, merged, checked and exported."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landstat.operators.cells import CELL_ROWS, meet

NUMERIC = {"double", "float", "int", "bigint", "smallint", "tinyint", "boolean"}
EARLIEST, LATEST_START = "2015-01-01", "2015-07-01"


class ProbRule:
    """Ways in which a raw column says how likely a crop is."""

    @staticmethod
    def equals(column: str, label: str) -> Column:
        return F.coalesce(F.col(column) == label, F.lit(False)).cast("double")

    @staticmethod
    def percent(column: str) -> Column:
        return F.col(column).cast("double") / 100

    @staticmethod
    def cast(column: str) -> Column:
        return F.col(column).cast("double")

    @staticmethod
    def flag(column: str) -> Column:
        """1 where the column that marks wrong labels is 0."""
        return F.coalesce(F.col(column) == 0, F.lit(False)).cast("double")

    @staticmethod
    def not_in(column: str, non_crop: Sequence[str]) -> Column:
        """0 for the listed non-crop values, 1 for all others."""
        return F.when(F.col(column).isin(*non_crop), 0.0).otherwise(1.0)


def with_class_prob(df: DataFrame, prob: Column | float) -> DataFrame:
    """``df`` with ``class_probability`` (double; NaN becomes null). A column that is neither numeric nor boolean is refused."""
    out = df.withColumn("class_probability", F.lit(prob) if isinstance(prob, (int, float)) else prob)
    kind = dict(out.dtypes)["class_probability"]
    if kind not in NUMERIC and not kind.startswith("decimal"):
        raise ValueError(f"class_probability is {kind}, not a number")
    return out.withColumn("class_probability", F.nanvl(F.col("class_probability").cast("double"), F.lit(None).cast("double")))


def with_label_window(df: DataFrame, as_of: str, start_year: int | None = None, date_col: str | None = None) -> DataFrame:
    """``df`` with start_date and end_date: January 1 of the year (fixed, or of a date) to December 31 of the next.

    The end is at most the day before ``as_of``; rows that start by 2015-01-01 go, starts before 2015-07-01 are raised to it, and
    only rows that start before they end stay.
    """
    if (start_year is None) == (date_col is None):
        raise ValueError("give start_year or date_col")
    year = F.lit(start_year) if date_col is None else F.year(F.to_date(date_col))
    start = F.make_date(year, F.lit(1), F.lit(1))
    end = F.least(F.make_date(year + 1, F.lit(12), F.lit(31)), F.date_sub(F.lit(as_of).cast("date"), 1))
    out = df.withColumns({"start_date": start, "end_date": end}).filter(F.col("start_date") > F.lit(EARLIEST).cast("date"))
    return out.withColumn("start_date", F.greatest("start_date", F.lit(LATEST_START).cast("date"))).filter("start_date < end_date")


def finalize_points(df: DataFrame) -> DataFrame:
    """Rows with coordinates and a probability, coordinates rounded to 8 digits so that equal places have equal keys."""
    return df.dropna(subset=["lon", "lat", "class_probability"]).withColumns({c: F.round(c, 8) for c in ("lon", "lat")})


def with_eo_status(df: DataFrame) -> DataFrame:
    return df.withColumn("eo_status", F.when(F.col("class_probability") == 0.5, "skipped").otherwise("waiting"))


def split_subsets(df: DataFrame, key: str = "id", validation: float = 0.2, testing: float = 0.2) -> DataFrame:
    """``df`` with ``subset`` by a draw that depends on the key alone: testing below one ratio, validation below both, else training."""
    if not 0 <= validation + testing <= 1:
        raise ValueError("ratios must lie between 0 and 1 together")
    u = F.pmod(F.col(key) * 48271, F.lit(2147483647)) / F.lit(2147483647.0)
    return df.withColumn("subset", F.when(u >= validation + testing, "training").when(u >= testing, "validation").otherwise("testing"))


@dataclass(frozen=True)
class LabelSource:
    """How one raw source maps to the canonical columns. ``prob`` is a column, a number or a function of the frame."""

    name: str
    prob: Column | float | Callable[[DataFrame], Column]
    lat: str = "lat"
    lon: str = "lon"
    start_year: int | None = None
    date_col: str | None = None
    filter: Callable[[DataFrame], DataFrame] | None = None
    labelers: str | None = None
    duration: str | None = None
    key: str = "id"
    ratios: tuple[float, float] = field(default=(0.2, 0.2))


CANONICAL = ("source", "class_probability", "start_date", "end_date", "lon", "lat", "subset", "labeler_names", "label_duration", "eo_data", "eo_lat", "eo_lon", "eo_file", "eo_status")


def process_source(df: DataFrame, source: LabelSource, as_of: str) -> DataFrame:
    """The canonical columns of a raw frame: filter, probability, dates, rounding, subset, status. One pass, no shuffle."""
    df = df.transform(source.filter) if source.filter else df
    prob = source.prob(df) if callable(source.prob) else source.prob
    df = with_class_prob(df.withColumns({"lat": F.col(source.lat).cast("double"), "lon": F.col(source.lon).cast("double")}), prob)
    df = with_eo_status(split_subsets(finalize_points(with_label_window(df, as_of, source.start_year, source.date_col)), source.key, *source.ratios))
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    extra = {"source": F.lit(source.name), "labeler_names": text(source.labelers), "label_duration": text(source.duration), "eo_data": text(None), "eo_lat": F.lit(None).cast("double"), "eo_lon": F.lit(None).cast("double"), "eo_file": text(None)}
    return df.withColumns(extra).select(*CANONICAL)


def drop_unlabeled(df: DataFrame, question: str) -> DataFrame:
    return df.filter(F.col(question).isNotNull())


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in a stated order; the same on every run unless rows tie in all of ``order``."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")  # each task sends one row a key
    return df.groupBy(*keys).agg(first).select(*(F.col(c) if c in keys else F.col(f"_first.`{c}`") for c in df.columns))


def clean_annotations(df: DataFrame, order: Sequence[str] = ("file_ord",)) -> DataFrame:
    """Unflagged rows with coordinates, one for each place and labeler."""
    return keep_first(df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.coalesce("flagged", F.lit(False))), ["lat", "lon", "email"], order)


def require_complete(df: DataFrame, columns: Sequence[str] = ("lat", "lon", "start_date", "end_date")) -> DataFrame:
    return df.dropna(subset=list(columns))


def clean_seasons(df: DataFrame, years: Sequence[int], strict_reference: bool = False) -> DataFrame:
    """Rows whose season (planting to harvest, ``yyyy-MM-dd`` texts) is valid: harvests ``nan`` and ``unknown`` go, a harvest up to a
    year before planting is moved on by 365 days, the year of planting must be listed and the gap be 1 to 365 days.
    ``strict_reference`` tests the gap from before the move, so that moved rows go.
    """
    kept = df.filter(~F.lower("harvest").isin("nan", "unknown")).withColumns({"planting_date": F.try_to_timestamp("planting", F.lit("yyyy-MM-dd")).cast("date"), "harvest_date": F.try_to_timestamp("harvest", F.lit("yyyy-MM-dd")).cast("date")})
    gap = F.datediff("harvest_date", "planting_date")
    kept = kept.withColumn("gap", gap)
    kept = kept.withColumn("harvest_date", F.when((F.col("gap") < 0) & (F.col("gap") > -365), F.date_add("harvest_date", 365)).otherwise(F.col("harvest_date")))
    tested = F.col("gap") if strict_reference else F.datediff("harvest_date", "planting_date")
    return kept.filter(F.year("planting_date").isin(*years) & (tested > 0) & (tested <= 365)).drop("gap")


def binarize_labels(df: DataFrame, rule: str) -> DataFrame:
    """``df`` with ``is_crop`` by one of three rules: ``training`` (p >= 0.5), ``export`` (p > 0.5 without p = 0.5), ``unanimous`` (0 or 1 only)."""
    p = F.col("class_probability")
    if rule == "training":
        return df.withColumn("is_crop", F.coalesce(p >= 0.5, F.lit(False)).cast("int"))
    if rule == "export":
        return df.filter(p != 0.5).withColumn("is_crop", (p > 0.5).cast("int"))
    if rule == "unanimous":
        return df.filter(p.isin(0.0, 1.0)).withColumn("is_crop", p.cast("int"))
    raise ValueError(f"no such rule: {rule}")


def select_rows(df: DataFrame, subset: str, train: Sequence[str], evaluation: Sequence[str]) -> DataFrame:
    """Rows for a subset: evaluation datasets give only theirs, training datasets give all rows but to training alone; 0.5 goes."""
    own = F.col("dataset").isin(*evaluation) & (F.col("subset") == subset)
    if subset == "training" and (others := [d for d in train if d not in evaluation]):
        own = own | F.col("dataset").isin(*others)
    return df.filter(own & (F.col("class_probability") != 0.5))


def up_to_year(df: DataFrame, year: int) -> DataFrame:
    return df.filter(F.year("start_date") <= year)


def with_is_local(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """``df`` with ``is_local``: inside (min_lat, max_lat, min_lon, max_lon), borders included."""
    return df.withColumn("is_local", F.col("lat").between(box[0], box[1]) & F.col("lon").between(box[2], box[3]))


def count_not_local(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    return with_is_local(df, box).agg(F.count_if(~F.col("is_local")).alias("outside"), F.count("*").alias("n"))


def evaluation_points(df: DataFrame, subset: str | None = "testing") -> DataFrame:
    """Unanimous points of a subset (of all subsets for None) with ``binary``."""
    kept = df if subset is None else df.filter(F.col("subset") == subset)
    return kept.filter(F.col("class_probability").isin(0.0, 1.0)).withColumn("binary", F.col("class_probability").cast("int"))


def answer_to_class(c: Column) -> Column:
    """crop, cropland, planted: 1; non-crop, non-cropland, not planted: 0; all else null."""
    low = F.lower(F.trim(c))
    return F.when(low.isin("crop", "cropland", "planted"), 1).when(low.isin("non-crop", "non-cropland", "not planted"), 0)


def merge_labels(df: DataFrame, keys: Sequence[str] = ("lon", "lat")) -> DataFrame:
    """One row a place: mean probability, sum of labelers, sorted different labelers. Sums and means combine before the shuffle."""
    return df.groupBy(*keys).agg(F.avg("class_probability").alias("class_probability"), F.sum("num_labelers").cast("bigint").alias("num_labelers"), join_unique(F.col("email")).alias("email"))


def join_unique(c: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c.cast("string"))), ",")


def join_if_all(c: Column, order: Column) -> Column:
    """All values in a stated order, comma-joined, if none is null; else empty."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), c.cast("string").alias("v")))), lambda x: x["v"])
    return F.when(F.count(c) == F.count("*"), F.array_join(texts, ",")).otherwise("")


def merge_label_windows(df: DataFrame, order: str = "id") -> DataFrame:
    """One row a place and label window: mean probability, labelers counted, first of the other columns by ``order``."""
    return df.groupBy("lon", "lat", "start_date", "end_date").agg(
        F.avg("class_probability").alias("class_probability"), F.count("*").alias("num_labelers"), F.min_by("subset", order).alias("subset"), F.min_by("country", order).alias("country"), join_if_all(F.col("dataset"), F.col(order)).alias("datasets")
    )


def min_labelers(df: DataFrame, n: int) -> DataFrame:
    return df.filter(F.col("num_labelers") >= n)


def dataset_report(df: DataFrame) -> DataFrame:
    """Per dataset and subset: rows, share of 0.5 labels, share of crop among the others."""
    p = F.col("class_probability")
    return df.groupBy("dataset", "subset").agg(F.count("*").alias("n"), F.avg((p == 0.5).cast("double")).alias("disagreement"), F.coalesce(F.avg(F.when(p != 0.5, (p > 0.5).cast("double"))), F.lit(0.0)).alias("positive"))


def test_set_stats(df: DataFrame) -> DataFrame:
    """Per dataset: unanimous rows, crop rows, crop rate to 3 digits."""
    return evaluation_points(df, None).groupBy("dataset").agg(F.count("*").alias("n"), F.count_if(F.col("binary") == 1).alias("crop"), F.round(F.avg("binary"), 3).alias("crop_rate"))


def local_amounts(df: DataFrame, boxes: DataFrame) -> DataFrame:
    """(name, subset, n): points of each subset in each named box. The boxes, a fixed list of regions, are broadcast if they are few."""
    return join_bbox(df, boxes).groupBy("name", "subset").agg(F.count("*").alias("n"))


def few(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def join_bbox(points: DataFrame, boxes: DataFrame, most: int = 10_000, cell: float = 2.0, most_rows: int = CELL_ROWS) -> DataFrame:
    """Points with the boxes (name, min_lat, max_lat, min_lon, max_lon) that hold them, borders included.

    Few boxes are broadcast. Many lie in the cells that they touch, and points meet those of their own cell; crowded cells are
    worked on in pieces of about ``most_rows`` rows of a side (``meet``).
    """
    inside = F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
    if boxes.limit(most + 1).count() <= most:
        return points.join(F.broadcast(boxes), inside)
    cells = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))
    placed = boxes.filter("min_lat <= max_lat and min_lon <= max_lon").withColumn("_y", cells("min_lat", "max_lat")).withColumn("_x", cells("min_lon", "max_lon"))
    own = points.withColumns({"_y": F.floor(F.col("lat") / cell), "_x": F.floor(F.col("lon") / cell)})
    return meet(own, placed, ["_y", "_x"], most_rows).filter(inside).drop("_y", "_x")


def export_training_table(df: DataFrame) -> DataFrame:
    """Rows with imagery and without 0.5, with ``is_crop``, under the export names."""
    return binarize_labels(df.filter(F.col("eo_data").isNotNull()), "export").select("dataset", "is_crop", "lat", "lon", "subset", "num_labelers", "country", "eo_data")


def export_points(df: DataFrame, rename: dict[str, str] | None = None, fewest: int = 2) -> DataFrame:
    """(latitude, longitude, subset, is_crop) of points without 0.5 that ``fewest`` labelers saw."""
    kept = df.filter((F.col("class_probability") != 0.5) & (F.col("num_labelers") >= fewest))
    names = {"lat": "latitude", "lon": "longitude", "class_probability": "is_crop"} | (rename or {})
    return kept.withColumnsRenamed(names).select("latitude", "longitude", "subset", "is_crop")


def ingest_new_sources(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("source", "start_year")) -> DataFrame:
    """``existing`` with the rows of ``incoming`` whose source and year it lacks."""
    return existing.unionByName(incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def drop_tail(df: DataFrame, n: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` without the last ``n`` rows of each group in a stated order."""
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") > n).drop("_rank")


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_sets(frames: dict[int, DataFrame]) -> DataFrame:
    """Several project files as one frame with ``set_id``."""
    return union_all(*[df.withColumn("set_id", F.lit(k)) for k, df in frames.items()])


def common_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def rows_not_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def common_plots(*sets: DataFrame, keys: Sequence[str] = ("plotid", "sampleid")) -> DataFrame:
    """The rows of the first set whose plot is in every other one."""
    return reduce(lambda a, b: a.join(b.select(*keys).distinct(), list(keys), "left_semi"), sets)


def apply_assignment(df: DataFrame, assignment: DataFrame, key: str) -> DataFrame:
    return df.drop("subset").join(assignment.select(key, "subset"), key, "left")


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def check_sets(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("plotid", "sampleid")) -> DataFrame:
    """For each of two sets: rows, different plots, missing answers, and plots in both."""
    both = a.select(*keys).distinct().intersect(b.select(*keys).distinct()).agg(F.count("*").alias("common"))
    one = lambda n, df: df.agg(F.lit(n).alias("set_id"), F.count("*").alias("n"), F.count_distinct(*keys).alias("plots"), F.count_if(F.col("answer").isNull()).alias("missing"))
    return one(1, a).unionByName(one(2, b)).join(F.broadcast(both), F.lit(True))  # both sides are one row of counts a set


def missing_datasets(wanted: DataFrame, registry: DataFrame) -> DataFrame:
    """Names that a run asks for and the registry lacks."""
    return wanted.join(registry, "dataset", "left_anti")


def bad_maps(catalog: DataFrame) -> DataFrame:
    """Rows of a map catalog that do not give exactly one of ``threshold`` and ``crop_classes`` (an empty list gives none), with ``problem``."""
    threshold, classes = F.col("threshold").isNotNull(), F.coalesce(F.size("crop_classes") > 0, F.lit(False))
    return catalog.withColumn("problem", F.when(threshold & classes, "both").when(~threshold & ~classes, "neither")).filter("problem is not null")


def bad_splits(splits: DataFrame, parts: Sequence[str] = ("train", "val", "test"), tolerance: float = 1e-9) -> DataFrame:
    """Rows whose shares are null or negative or do not add up to 1, with their ``total`` (null if any share is)."""
    total = reduce(lambda a, c: a + F.col(c), parts[1:], F.col(parts[0]))
    sound = reduce(lambda a, c: a & (F.col(c) >= 0), parts, F.abs(total - 1) <= tolerance)
    return splits.withColumn("total", total).filter(~F.coalesce(sound, F.lit(False)))


def share(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n, share): counts of values and their share in the group. The window runs over counts, not rows."""
    counted = df.groupBy(*by, column).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def upsert_metrics(log: DataFrame, new: DataFrame) -> DataFrame:
    return log.unionByName(new, allowMissingColumns=True)


def latest_metrics(log: DataFrame, key: str = "model", ts: str = "run_ts", tie: Sequence[str] = ()) -> DataFrame:
    """The latest row of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(ts), *tie)
    return log.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
