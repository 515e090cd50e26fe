"""Pixel tables (map, row, col, value): sampling, classes, areas, changes, composites and votes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.operators.labels import few
from landstat.operators.points import as_parts

NODATA = 255.0


def tiles_to_pixels(tiles: DataFrame, width: int, height: int) -> DataFrame:
    """Tiles (map, tr, tc, values of width x height in row order) as pixels."""
    each = tiles.select("map", "tr", "tc", F.posexplode("values").alias("pos", "value"))
    return each.select("map", (F.col("tr") * height + F.floor(F.col("pos") / width)).cast("int").alias("row"), (F.col("tc") * width + F.col("pos") % width).cast("int").alias("col"), "value")


def pixels_to_tiles(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """Pixels as tiles, nodata where a pixel is missing. A tile holds a fixed number of pixels."""
    tr, tc = F.floor(F.col("row") / height).cast("int"), F.floor(F.col("col") / width).cast("int")
    at = F.col("row") % height * width + F.col("col") % width
    packed = pixels.groupBy("map", tr.alias("tr"), tc.alias("tc")).agg(F.map_from_entries(F.collect_list(F.struct(at.cast("int"), "value"))).alias("m"))
    return packed.select("map", "tr", "tc", F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), lambda i: F.coalesce(F.get(F.array(F.try_element_at("m", i)), F.lit(0)), F.lit(NODATA))).alias("values"))


def binarize(value: Column, threshold: float = 0.5, nodata: float = NODATA) -> Column:
    """0 or 1 by a threshold; null for nodata and null."""
    return F.when(value.isNull() | (value == nodata), None).when(value < threshold, 0).otherwise(1)


def with_crop_flag(values: DataFrame, catalog: DataFrame) -> DataFrame:
    """Map values with ``crop``: at least the map's threshold, or one of its crop classes. The catalogue has one row a map."""
    flag = F.when(F.col("threshold").isNotNull(), F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False))).otherwise(F.coalesce(F.array_contains("crop_classes", F.col("value").cast("int")), F.lit(False)))
    return values.join(few(catalog, 10_000), "map").withColumn("crop", flag.cast("int"))


def attach_map_values(points: DataFrame, samples: DataFrame, maps: Sequence[str], key: str = "id") -> DataFrame:
    """Points with a column for each map: one pass over the samples, one join. Of several values the smallest."""
    wide = samples.groupBy(key).agg(*[F.min(F.when(F.col("map") == m, F.col("value"))).alias(m) for m in maps])
    return points.join(wide, key, "left")


def sample_raster(points: DataFrame, pixels: DataFrame, meta: dict[str, float], x: str = "lon", y: str = "lat", keep: Sequence[str] = ()) -> DataFrame:
    """Points with the value of the pixel that holds them, null outside the raster. A point meets its pixel by row and column.

    With ``keep`` (map, year), a point has a row for each pixel of several rasters there.
    """
    row, col = geo.rowcol(F.col(x), F.col(y), meta)
    return points.withColumns({"row": row, "col": col}).join(pixels.select("row", "col", *keep, "value"), ["row", "col"], "left")


def compare_points(points: DataFrame, pixels: DataFrame, meta: dict[str, float], threshold: float = 0.5, actual: str = "class_probability", keep: Sequence[str] = ("eo_data", "crop_type"), x: str = "lon", y: str = "lat", key: str = "id") -> DataFrame:
    """(key, actual, prediction, probability, keep...) of each point against a map of probabilities: the pixel that holds the point, and 1 where
    it is over ``threshold``. Both are null outside the map and for points without a place."""
    asked = points.select(key, F.col(actual).alias("actual"), F.col(x).alias("_x"), F.col(y).alias("_y"), *keep)
    sampled = sample_raster(asked, pixels, meta, "_x", "_y").withColumnRenamed("value", "probability")
    return sampled.select(key, "actual", (F.col("probability") > threshold).cast("int").alias("prediction"), "probability", *keep)


def sample_zonal(points: DataFrame, pixels: DataFrame, meta: dict[str, float], radius: int = 1, x: str = "lon", y: str = "lat", key: str = "id") -> DataFrame:
    """Points with the most frequent value (the smallest of several) of the pixels within ``radius`` rows and columns."""
    row, col = geo.rowcol(F.col(x), F.col(y), meta)
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    near = points.select(key, row.alias("_r"), col.alias("_c")).withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).select(key, (F.col("_r") + F.col("_i")).alias("row"), (F.col("_c") + F.col("_j")).alias("col"))
    return near.join(pixels.select("row", "col", "value"), ["row", "col"]).groupBy(key).agg(F.mode("value", True).alias("value"))


def class_area(pixels: DataFrame, px_size: float, by: Sequence[str] = ("map",)) -> DataFrame:
    """(by, class, px, ha, fraction) of a class table with column ``class``; null classes do not count."""
    from pyspark.sql import Window

    counted = pixels.filter(F.col("class").isNotNull()).groupBy(*by, "class").agg(F.count("*").alias("px"))
    return counted.select(*by, "class", "px", (F.col("px") * px_size * px_size / 10_000).alias("ha"), (F.col("px") / F.sum("px").over(Window.partitionBy(*by))).alias("fraction"))


def crop_percent(pixels: DataFrame, row_lat: Column, by: Sequence[str] = ("map",)) -> DataFrame:
    """Percent of a map that is crop, pixels weighted by the cosine of their latitude."""
    w = F.cos(F.radians(row_lat))
    known = F.col("class").isNotNull()
    return pixels.groupBy(*by).agg(F.try_divide(100 * F.sum(F.when(known, w * F.col("class"))), F.sum(F.when(known, w))).alias("percent"))


def tile_sums(pixels: DataFrame, rows: int, cols: int, by: Sequence[str] = ("map",)) -> DataFrame:
    """Pixels of each class in tiles of rows by cols pixels, and in each map (null tile), in one pass."""
    tiled = pixels.filter(F.col("class").isNotNull()).withColumn("tile", F.concat_ws("_", F.floor(F.col("row") / rows), F.floor(F.col("col") / cols)))
    return tiled.groupingSets([[*map(F.col, by), F.col("class"), F.col("tile")], [*map(F.col, by), F.col("class")]], *by, "class", "tile").agg(F.count("*").alias("px"))


def ensemble_map(pixels: DataFrame, n_maps: int) -> DataFrame:
    """(row, col, class): 1 where at least half of the maps, rounded up, say crop; missing values say no."""
    return pixels.groupBy("row", "col").agg((F.sum(F.coalesce("class", F.lit(0))) >= (n_maps + 1) // 2).cast("int").alias("class"))


def ensemble_vote(wide: DataFrame, maps: Sequence[str]) -> Column:
    """The most frequent flag of a row's maps (the smaller of several); nulls do not vote."""
    votes = sum((F.coalesce(F.col(m), F.lit(0)) for m in maps), F.lit(0))
    n = sum((F.col(m).isNotNull().cast("int") for m in maps), F.lit(0))
    return F.when(n > 0, (2 * votes > n).cast("int"))


def change_map(p1: DataFrame, p2: DataFrame) -> DataFrame:
    """(row, col, class): class of year 1 twice plus that of year 2; null where either is unknown."""
    return p1.select("row", "col", F.col("class").alias("_a")).join(p2.select("row", "col", F.col("class").alias("_b")), ["row", "col"]).select("row", "col", (F.col("_a") * 2 + F.col("_b")).alias("class"))


def mosaic(pixels: DataFrame, order: dict[str, int]) -> DataFrame:
    """(row, col, value): of several layers the last one with data."""
    rank = F.coalesce(*[F.when(F.col("map") == k, F.lit(v)) for k, v in order.items()])
    known = pixels.filter((F.col("value") != NODATA) & F.col("value").isNotNull()).withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    return known.groupBy("row", "col").agg(F.max_by("value", "_rank").alias("value"))


def mode_composite(obs: DataFrame, by: Sequence[str] = ("row", "col")) -> DataFrame:
    return obs.groupBy(*by).agg(F.mode("value", True).alias("value"))


def median_composite(obs: DataFrame, by: Sequence[str], clear: Column | None = None, most_cloud: float | None = None) -> DataFrame:
    """Median of clear observations of scenes with at most ``most_cloud`` percent cloud."""
    kept = obs if clear is None else obs.filter(clear)
    kept = kept if most_cloud is None else kept.filter(F.col("cloud_percent") <= most_cloud)
    return kept.groupBy(*by).agg(F.median("value").alias("value"))


def paint(pixels: DataFrame, updates: DataFrame, value: float = 0.0) -> DataFrame:
    """Pixels with ``value`` at the places of ``updates`` (row, col)."""
    marked = updates.select("row", "col").distinct().withColumn("_new", F.lit(value))
    return pixels.join(marked, ["row", "col"], "left").withColumn("value", F.coalesce("_new", "value")).drop("_new")


TILE = 64  # pixels a side of the blocks by which pixels meet regions
MOST_VERTICES = 2_000_000  # of the rings that are broadcast, about 50 MB


def region_tiles(regions: DataFrame, meta: dict[str, float], size: int = TILE) -> DataFrame:
    """The blocks of size by size pixels that each region touches: the region's columns, _tr, _tc, and ``_exact``.

    A block that no edge comes near lies inside or outside as a whole; those outside go, those inside carry no geometry and ask for
    no test. Blocks near an edge (``_exact``) keep it for a test of each pixel.
    """
    parts = as_parts(regions)
    b = geo.ring_bounds(F.flatten(F.flatten(parts)))
    at = [geo.rowcol(F.col(f"_b.{x}"), F.col(f"_b.{y}"), meta) for x in ("min_x", "max_x") for y in ("min_y", "max_y")]
    span = lambda k: F.explode(F.sequence(F.floor(F.least(*[c[k] for c in at]) / size).cast("int"), F.floor(F.greatest(*[c[k] for c in at]) / size).cast("int")))
    own = regions.withColumns({"_parts": parts, "_b": b}).filter(F.size(F.flatten(F.flatten("_parts"))) > 0)
    own = own.withColumn("_tr", span(0)).withColumn("_tc", span(1)).drop("_b", "ring", "parts")
    corner = [geo.pixel_center(F.col("_tr") * size + i * size - 0.5, F.col("_tc") * size + j * size - 0.5, meta) for i in (0, 1) for j in (0, 1)]
    box = [f(*[c[k] for c in corner]) for k in (0, 1) for f in (F.least, F.greatest)]
    placed = own.withColumns({"_x0": box[0], "_x1": box[1], "_y0": box[2], "_y1": box[3]})
    near = F.exists(F.flatten("_parts"), lambda ring: geo.edge_near(ring, F.col("_x0"), F.col("_y0"), F.col("_x1"), F.col("_y1")))
    kept = placed.withColumn("_exact", near).filter(F.col("_exact") | geo.holds(F.col("_parts"), (F.col("_x0") + F.col("_x1")) / 2, (F.col("_y0") + F.col("_y1")) / 2))
    return kept.withColumn("_parts", F.when(F.col("_exact"), F.col("_parts"))).drop("_x0", "_x1", "_y0", "_y1")


def clip_pixels(pixels: DataFrame, meta: dict[str, float], regions: DataFrame | None, size: int = TILE, most: int = MOST_VERTICES) -> DataFrame:
    """Pixels whose centre a region (``ring`` or ``parts``) holds, with the region's columns; all pixels without a region.

    Pixels meet regions by blocks, so a key holds size * size pixels of each map at most, however large the region; only pixels of
    blocks near a border are tested. Blocks are broadcast if their vertices are few, else both sides are shuffled by block.
    """
    if regions is None:
        return pixels
    tiles = region_tiles(regions, meta, size)
    vertices = tiles.agg(F.sum(F.lit(8) + F.coalesce(F.size(F.flatten(F.flatten("_parts"))), F.lit(0)))).first()[0] or 0
    x, y = geo.pixel_center(F.col("row"), F.col("col"), meta)
    own = pixels.withColumns({"_pr": F.floor(F.col("row") / size).cast("int"), "_pc": F.floor(F.col("col") / size).cast("int"), "_x": x, "_y": y})
    on = (F.col("_pr") == F.col("_tr")) & (F.col("_pc") == F.col("_tc")) & (~F.col("_exact") | geo.holds(F.col("_parts"), F.col("_x"), F.col("_y")))
    return own.join(F.broadcast(tiles) if vertices <= most else tiles, on).drop("_pr", "_pc", "_x", "_y", "_tr", "_tc", "_exact", "_parts")


def resample(pixels: DataFrame, source: dict[str, float], target: dict[str, float], rows: int, cols: int, to_source: Callable[[Column, Column], tuple[Column, Column]] | None = None) -> DataFrame:
    """Nearest-neighbour values of another grid: each target centre looks up the pixel that holds it. The grid is made by Spark.

    ``to_source`` takes (x, y) of the target's reference system to the source's, such as from a UTM zone to degrees.
    """
    grid = pixels.sparkSession.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    x, y = geo.pixel_center(F.col("row"), F.col("col"), target)
    x, y = (x, y) if to_source is None else to_source(x, y)
    r, c = geo.rowcol(x, y, source)
    looked = grid.select("row", "col", r.alias("_r"), c.alias("_c"))
    return looked.join(pixels.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value"), ["_r", "_c"], "left").select("row", "col", "value")


def ndvi_demote(df: DataFrame, c: float, basis: str = "prediction") -> DataFrame:
    """``df`` (prediction, label, ndvi) with ``demoted``: positives below mean - c std of the NDVI of positives by ``basis``."""
    cut = df.filter(F.col(basis) == 1).agg((F.avg("ndvi") - c * F.stddev_pop("ndvi")).alias("_cut"))
    return df.join(F.broadcast(cut), F.lit(True)).withColumn("demoted", F.when((F.col("prediction") == 1) & (F.col("ndvi") < F.col("_cut")), 0).otherwise(F.col("prediction"))).drop("_cut")


def demote(prediction: Column, *rules: Column) -> Column:
    """0 where any rule holds."""
    any_ = rules[0]
    for r in rules[1:]:
        any_ = any_ | r
    return F.when(F.coalesce(any_, F.lit(False)), 0).otherwise(prediction)


def summarise_results(results: DataFrame, metric: str, error: str) -> DataFrame:
    """Mean metric and mean error by country, by dataset and over all, in one pass."""
    return results.groupingSets([[F.col("country")], [F.col("dataset")], []], "country", "dataset").agg(F.avg(metric).alias("mean"), F.avg(error).alias("error"), F.count("*").alias("n"))


def rank_maps(results: DataFrame, metric: str, by: str = "country") -> DataFrame:
    """Dense ranks of maps by a metric in each country."""
    from pyspark.sql import Window

    rank = F.dense_rank().over(Window.partitionBy(by).orderBy(F.desc(metric)))
    return results.withColumn("rank", rank).withColumns({"best": F.col("rank") == 1, "second": F.col("rank") == 2})


def best_map(results: DataFrame, metric: str, by: str = "country", name: str = "dataset") -> DataFrame:
    return results.groupBy(by).agg(F.max_by(name, F.struct(metric, name)).alias("best"))


def metric_correlation(results: DataFrame, x: str, metric: str) -> DataFrame:
    """Pearson's r and the coefficient of determination."""
    return results.agg(F.corr(x, metric).alias("r"), F.regr_r2(F.col(metric), F.col(x)).alias("r2"))
