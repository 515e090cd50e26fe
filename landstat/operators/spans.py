"""Regions as scanlines of a grid: the stretches of columns that they cover in each row.

The edges of a region cross the rows of a north-up grid; between the crossings of a row lie the stretches inside. A clip then asks only
whether a column lies in a stretch of its row: no geometry travels to the pixels, and a large region is spread over its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstat.operators.points import as_parts

BLOCK = 256  # columns by which pixels and stretches meet


def _edges(regions: DataFrame, meta: dict[str, float]) -> tuple[DataFrame, list[str]]:
    """Edges of all rings in pixels: u along the row, v down the rows (a pixel's centre is at half)."""
    if meta["b"] or meta["d"]:
        raise ValueError("scanlines need a grid without rotation")
    keys = [c for c in regions.columns if c not in ("ring", "parts")]
    ring = regions.select(*keys, F.explode(F.flatten(as_parts(regions))).alias("_r")).filter(F.size("_r") > 2)
    at = lambda i: F.get("_r", i)
    edge = F.transform(F.sequence(F.lit(0), F.size("_r") - 1), lambda i: F.struct(at(i).alias("p"), at(F.when(i + 1 < F.size("_r"), i + 1).otherwise(0)).alias("q")))
    long = ring.select(*keys, F.explode(edge).alias("_e"))
    u, v = (lambda p: (F.col(f"_e.{p}.x") - meta["c"]) / meta["a"]), (lambda p: (F.col(f"_e.{p}.y") - meta["f"]) / meta["e"])
    return long.select(*keys, u("p").alias("u1"), v("p").alias("v1"), u("q").alias("u2"), v("q").alias("v2")), keys


def _rows(low: Column, high: Column) -> Column:
    return F.explode(F.when(low <= high, F.sequence(low.cast("int"), high.cast("int")))).alias("row")


def region_spans(regions: DataFrame, meta: dict[str, float], touched: bool = False) -> DataFrame:
    """The columns of ``regions`` but its geometry, with row, c0 and c1: columns c0 to c1 of the row belong to the region.

    A pixel belongs where its centre is inside; with ``touched``, also where any of its area is. Holes count by the even-odd rule.
    Stretches of a region do not overlap. Rows that agree in all other columns are one region; those without a geometry have none.
    """
    edges, keys = _edges(regions, meta)
    low, high = F.least("v1", "v2"), F.greatest("v1", "v2")
    crossed = edges.select("*", _rows(F.ceil(low - 0.5), F.ceil(high - 0.5) - 1))
    u = F.col("u1") + (F.col("row") + 0.5 - F.col("v1")) * (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
    xs = crossed.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(u)).alias("xs"))
    first = lambda i: F.ceil(F.get("xs", i) - 0.5).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda i: F.struct(first(i).alias("c0"), (first(i + 1) - 1).alias("c1")))
    spans = xs.select(*keys, "row", F.explode(pairs).alias("s")).select(*keys, "row", "s.*")
    if touched:  # an edge inside the strip of a row runs over these columns
        strip = edges.select("*", _rows(F.floor(low), F.ceil(high) - 1))
        slope = (F.col("u2") - F.col("u1")) / F.nullif(F.col("v2") - F.col("v1"), F.lit(0.0))
        along = lambda v: F.coalesce(F.col("u1") + (v - F.col("v1")) * slope, F.col("u1"))
        a, b = along(F.greatest(F.col("row"), low)), along(F.least(F.col("row") + 1, high))
        flat = F.col("v1") == F.col("v2")
        a, b = F.when(flat, F.col("u1")).otherwise(a), F.when(flat, F.col("u2")).otherwise(b)
        spans = spans.unionByName(strip.select(*keys, "row", F.floor(F.least(a, b)).cast("int").alias("c0"), (F.ceil(F.greatest(a, b)) - 1).cast("int").alias("c1")))
    spans = spans.filter("c0 <= c1")
    if not touched:
        return spans
    held = spans.groupBy(*keys, "row").agg(F.array_sort(F.collect_set(F.struct("c0", "c1"))).alias("all"))

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["c0"].alias("c0"), F.greatest(last["c1"], s["c1"]).alias("c1"))
        return F.when(s["c0"] <= last["c1"] + 1, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(s)))

    merged = F.aggregate("all", F.slice("all", 1, 1), add)
    return held.select(*keys, "row", F.explode(merged).alias("s")).select(*keys, "row", "s.*")


def clip_to_spans(pixels: DataFrame, meta: dict[str, float], regions: DataFrame, touched: bool = False) -> DataFrame:
    """``pixels`` (row, col, ...) of the regions, with the regions' columns; see ``region_spans`` for what belongs.

    Pixels and stretches meet by row and block of columns, so a key holds ``BLOCK`` pixels of each map.
    """
    spans = region_spans(regions, meta, touched).withColumn("_block", F.explode(F.sequence(F.floor(F.col("c0") / BLOCK), F.floor(F.col("c1") / BLOCK))))
    own = pixels.withColumn("_block", F.floor(F.col("col") / BLOCK))
    return own.join(spans, ["row", "_block"]).filter(F.col("col").between(F.col("c0"), F.col("c1"))).drop("_block", "c0", "c1").select(*pixels.columns, *(c for c in spans.columns if c not in ("row", "_block", "c0", "c1")))
