"""Joins and statistics of places: regions, distances, samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.functions.shared import checkpointed
from landstat.operators.cells import CELL_ROWS, meet
from landstat.operators.neighbours import nearest, unit  # noqa: F401  one of the joins of places

CELL = 2.0  # degrees a side of the cells that bring near places together
MOST_VERTICES = 2_000_000  # of the regions that are broadcast, about 50 MB
CELL_POINTS = 1_000_000  # places of a cell that meet its regions in one task
LEVELS = 8  # a crowded cell is halved this often each way at most
MOST_SPLITS = 100_000  # cells that are cut in four at most
COPIES = 1_000  # ids of one place that travel in a row
BLOCKS, MOST_BLOCK = 64, 20_000  # blocks of a set of places whose pairs are counted, and places of a block at most
TASK_PAIRS, MOST_TASKS = 20_000_000, 10_000  # pairs of places that a task counts, as long as there are not too many tasks
TILE = 250_000  # pairs that are computed at once
NEAR = 1 - 2e-9  # cosine of the angle below which products of unit vectors lose too many digits
SLACK = 1e-11  # of the angles that they give


def as_parts(regions: DataFrame) -> Column:
    """The geometry of a table of regions: ``parts`` (lists of rings, holes among them), or a ``ring`` as the only one."""
    return F.col("parts") if "parts" in regions.columns else F.array(F.array("ring"))


def leaf_cells(points: DataFrame, x: str, y: str, cell: float = CELL, most: int = CELL_POINTS, levels: int = LEVELS, splits: int = MOST_SPLITS) -> DataFrame:
    """(level, cx, cy, n, pieces): cells that hold all places, each once, and how many places each holds.

    A cell with more than ``most`` places is cut in four, up to ``levels`` times. What is cut grows with the data so that at most
    ``splits`` cells are; a cell that still holds too many places is worked on in ``pieces`` of ``most``.
    """
    fine = cell / 2**levels
    counts = points.groupBy(F.floor(F.col(x) / fine).alias("fx"), F.floor(F.col(y) / fine).alias("fy")).agg(F.count("*").alias("n")).filter("fx is not null and fy is not null")
    upwards = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("fx", levels - k).alias("cx"), F.shiftright("fy", levels - k).alias("cy")) for k in range(levels + 1)]))
    tree = counts.select(upwards.alias("c"), "n").groupBy("c.level", "c.cx", "c.cy").agg(F.sum("n").alias("n"))
    total = counts.agg(F.greatest(F.lit(most), F.ceil(F.sum("n") * levels / splits)).alias("limit"))
    tree = tree.join(F.broadcast(total), F.lit(True))  # one row
    above = tree.filter(f"n > limit and level < {levels}").select((F.col("level") + 1).alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py"))
    inner = tree.withColumns({"px": F.shiftright("cx", 1), "py": F.shiftright("cy", 1)}).join(above, ["level", "px", "py"], "left_semi").drop("px", "py")
    leaves = tree.filter("level = 0").unionByName(inner.select(*tree.columns)).filter(f"n <= limit or level = {levels}")
    return leaves.select("level", "cx", "cy", "n", F.ceil(F.col("n") / most).cast("long").alias("pieces"))


def _cut(placed: DataFrame, size: Column) -> DataFrame:
    """Regions in cells (_cx, _cy) of a size with the edges that places of the cell can need; cells without any are left out."""
    slack = size * 1e-6
    edges = geo.edges_right(F.col("_parts"), F.col("_cx") * size - slack, F.col("_cy") * size - slack, (F.col("_cy") + 1) * size + slack)
    return placed.withColumn("_edges", edges).drop("_parts", "_b").filter(F.size("_edges") > 0)


def join_regions(points: DataFrame, regions: DataFrame, how: str = "inner", x: str = "lon", y: str = "lat", most: int = MOST_VERTICES, cell: float = CELL, most_points: int = CELL_POINTS) -> DataFrame:
    """Points with the regions (columns of ``regions``, with ``ring`` or ``parts``) that hold them; ``how``: inner, left_semi or left_anti.

    A region lies in the cells that its bounds touch, and sends each of them only those of its edges that a ray from a place of the
    cell can cross; points meet regions of their own cell, then the exact test. Regions are broadcast if their vertices, counted
    in each cell, are at most ``most``; else both sides are shuffled by cells that follow the density of the points
    (``leaf_cells``), so that no key has more than about ``most_points`` points, but for rows that are equal in all columns.
    """
    b = geo.ring_bounds(F.flatten(F.flatten(as_parts(regions))))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))
    own = regions.withColumns({"_b": b, "_parts": as_parts(regions)}).filter(F.col("_b.min_x").isNotNull())
    placed = own.withColumn("_cx", cells(F.col("_b.min_x"), F.col("_b.max_x"))).withColumn("_cy", cells(F.col("_b.min_y"), F.col("_b.max_y")))
    reach = lambda k: F.floor(F.col(f"_b.max_{k}") / cell) - F.floor(F.col(f"_b.min_{k}") / cell) + 1
    vertices = own.agg(F.sum(reach("x") * reach("y") * (8 + F.size(F.flatten(F.flatten("_parts")))))).first()[0] or 0
    held = geo.edges_hold(F.col("_edges"), F.col(x), F.col(y))
    if vertices <= most:
        tagged = points.withColumns({"_px": F.floor(F.col(x) / cell), "_py": F.floor(F.col(y) / cell)})
        on = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & held
        return tagged.join(F.broadcast(_cut(placed, F.lit(cell))), on, how).drop("_px", "_py", "_cx", "_cy", "_edges")
    leaves = checkpointed(leaf_cells(points, x, y, cell, most_points))
    at = lambda c, k: F.shiftright(F.floor(F.col(c) / (cell / 2**LEVELS)), LEVELS - k)
    every = F.array(*[F.struct(F.lit(k).alias("level"), at(x, k).alias("cx"), at(y, k).alias("cy")) for k in range(LEVELS + 1)])
    known = leaves.select(F.struct("level", "cx", "cy").alias("_leaf"), F.col("pieces").alias("_pieces"))
    known = F.broadcast(known) if leaves.count() <= 8 * MOST_SPLITS else known  # three numbers a cell
    plain = [f.name for f in points.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    placeless = F.col(x).isNull() | F.col(y).isNull()
    tagged = points.filter(~placeless).withColumn("_leaf", F.explode(every)).join(known, "_leaf").withColumn("_piece", F.pmod(F.xxhash64(*plain), F.col("_pieces"))).drop("_pieces")
    size = cell / F.pow(F.lit(2.0), F.col("_at.level"))
    meets = lambda c, k: (F.col(c) * size <= F.col(f"_b.max_{k}") + size * 1e-6) & ((F.col(c) + 1) * size >= F.col(f"_b.min_{k}") - size * 1e-6)
    inside = leaves.select(F.expr("shiftright(cx, level)").alias("_cx"), F.expr("shiftright(cy, level)").alias("_cy"), F.struct("level", "cx", "cy").alias("_at"), F.col("pieces").alias("_pieces"))
    both = placed.join(inside, ["_cx", "_cy"]).filter(meets("_at.cx", "x") & meets("_at.cy", "y")).withColumns({"_cx": F.col("_at.cx"), "_cy": F.col("_at.cy")})
    both = _cut(both, size).withColumn("_each", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1))).drop("_cx", "_cy", "_pieces")
    out = tagged.join(both, (F.col("_leaf") == F.col("_at")) & (F.col("_piece") == F.col("_each")) & held, how).drop("_leaf", "_piece", "_at", "_each", "_edges")
    return out.unionByName(points.filter(placeless)) if how == "left_anti" else out


def _with_copies(df: DataFrame, side: str, most: int = COPIES) -> DataFrame:
    """(lat, lon, ids) of the different places of ``df``; a place with more than ``most`` ids has a row for each piece of them."""
    known = df.select("id", "lat", "lon").dropna(subset=["lat", "lon"])
    crowded = known.groupBy("lat", "lon").agg(F.ceil(F.count("*") / most).cast("long").alias("_pieces")).filter("_pieces > 1")
    keys = ["lat", "lon"]
    if not crowded.isEmpty():
        pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
        draw = (F.rand(7) * pieces).cast("long")  # not by a hash of the id, which may repeat
        known, keys = checkpointed(known.join(crowded, ["lat", "lon"], "left").withColumn("_piece", draw)), [*keys, "_piece"]
    ids = F.collect_list(F.struct("id")).alias(f"ids_{side}")  # a struct, as a null id counts too
    return known.groupBy(*keys).agg(ids).select(F.col("lat").alias(f"lat_{side}"), F.col("lon").alias(f"lon_{side}"), f"ids_{side}")


def within_distance(a: DataFrame, b: DataFrame, km: float, most: int = CELL_ROWS, digits: int | None = None, copies: int = COPIES) -> DataFrame:
    """Pairs of ``a`` (id, lat, lon) and ``b`` (id, lat, lon) at most ``km`` apart: id_a, id_b, km (rounded to ``digits``).

    Each place of ``a`` looks in the cells around its own; a cell is as high as the distance, and as wide as it is at the latitude
    of its band, so three by three cells hold all partners. Bands near the poles are one cell around. Crowded
    cells are worked on in pieces of about ``most`` places of a side (``meet``). Rows of one place meet as one: their distance is
    computed and rounded once, and their ids (``copies`` a row at most) make pairs at the end.
    """
    size = km / 111.0 * 1.01
    band = lambda lat: F.floor(lat / size).cast("long")
    # the widest place of a band and its neighbours decides how many cells there are around it
    reach = lambda k: F.least(F.lit(90.0), (F.greatest(F.abs(k), F.abs(k + 1)) + 1) * size)
    around = lambda k: F.greatest(F.lit(1), F.floor(360.0 / (size / F.greatest(F.lit(1e-6), F.cos(F.radians(reach(k)))))).cast("long"))
    cell = lambda lon, n: F.pmod(F.floor((lon + 180.0) / (360.0 / n)).cast("long"), n)
    left = _with_copies(a, "a", copies).withColumn("k", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda o: band(F.col("lat_a")) + o)))
    left = left.withColumn("n", around(F.col("k"))).withColumn("c", F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda o: F.pmod(cell(F.col("lon_a"), F.col("n")) + o, F.col("n"))))))
    right = _with_copies(b, "b", copies).withColumn("k", band(F.col("lat_b"))).withColumn("c", cell(F.col("lon_b"), around(F.col("k"))))
    d = geo.haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    near = meet(left, right, ["k", "c"], most).withColumn("km", d).filter(F.col("km") <= km)
    near = near.select("ids_a", "ids_b", (F.col("km") if digits is None else F.round("km", digits) + 0.0).alias("km"))
    each = near.select(F.explode("ids_a").alias("a"), "ids_b", "km").select("a", F.explode("ids_b").alias("b"), "km")
    return each.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), "km")


def _tile(p: np.ndarray, q: np.ndarray) -> tuple[float, list, list]:
    """All pairs of two blocks of places (rows: latitude, longitude, how often): the sum of their angles, each as often as its
    places are; the nearest pair (identical places left out) and the furthest as latitude, longitude, latitude, longitude.

    Angles follow from products of unit vectors. These lose digits near 0 and 180 degrees, where the haversine stands in.
    """
    u, v = unit(p[0], p[1]), unit(q[0], q[1]).T
    cos1, cos2 = np.cos(np.radians(p[0])), np.cos(np.radians(q[0]))

    def haversine(a, b):
        h = np.sin(np.radians(q[0][b] - p[0][a]) / 2) ** 2 + cos1[a] * cos2[b] * np.sin(np.radians(q[1][b] - p[1][a]) / 2) ** 2
        return 2 * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0, 1 - h)))

    total, low, high, nearest_, furthest = 0.0, np.inf, -np.inf, [None] * 4, [None] * 4
    step = max(1, TILE // max(1, q.shape[1]))
    for i in range(0, p.shape[1] if q.shape[1] else 0, step):
        dot = u[i : i + step] @ v
        angle = np.arccos(np.clip(dot, -1, 1))
        a = b = np.zeros(0, np.int64)
        if not (dot.max() < NEAR and dot.min() > -NEAR):
            a, b = np.nonzero(np.abs(dot) >= NEAR)
            angle[a, b] = haversine(i + a, b)
        total += float(p[2][i : i + step] @ (angle @ q[2]))
        most = angle.max()
        if not most <= high - SLACK:  # NaN too
            x, y = np.nonzero(angle >= most - SLACK) if most == most else np.nonzero(np.isnan(angle))
            exact = haversine(i + x, y)
            at = int(exact.argmax())
            if not exact[at] <= high:
                high, furthest = exact[at], [p[0][i + x[at]], p[1][i + x[at]], q[0][y[at]], q[1][y[at]]]
        one = (p[0][i + a] == q[0][b]) & (p[1][i + a] == q[1][b])
        angle[a[one], b[one]] = np.inf
        least = np.fmin.reduce(angle, axis=None)
        if least < np.inf and least < low + SLACK:
            x, y = np.nonzero(angle <= least + SLACK)
            exact = haversine(i + x, y)
            at = int(exact.argmin())
            if exact[at] < low:
                low, nearest_ = exact[at], [p[0][i + x[at]], p[1][i + x[at]], q[0][y[at]], q[1][y[at]]]
    return total, [None if x is None else float(x) for x in nearest_], [None if x is None else float(x) for x in furthest]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile (_g, _i, _j) that both sides reach: the results of ``_tile``. Rows come by tile, the left side first."""
    held, block = None, None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in ("_g", "_i", "_j"))))
        lists, out = batch.column("places"), []
        for row, (key, side, twice) in enumerate(zip(keys, batch.column("_side").to_pylist(), batch.column("_twice").to_pylist())):
            values = lists.slice(row, 1).flatten()
            places = np.stack([values.field(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(3)])
            if side == 0:
                held, block = key, places
            elif held == key:
                total, low, high = _tile(block, places)
                out.append([key[0], total * twice, int(block[2].sum()) * int(places[2].sum()) * twice, *low, *high])
        names = ["_g", "angles", "pairs", *(f"{k}{i}" for k in ("low", "high") for i in range(4))]
        kinds = [pa.int64(), pa.float64(), pa.int64(), *[pa.float64()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


def pairwise_distance(a: DataFrame, b: DataFrame, by: Sequence[str] = (), own: bool = False, block: int = 2_000) -> DataFrame:
    """Average, smallest (identical places left out) and largest distance of all pairs, in km; of all pairs that agree in ``by``.

    With ``own``, ``a`` and ``b`` are one set, and a row makes no pair with itself; groups of a single row are left out. This is
    the one operator whose answer needs every pair. Equal places are counted first; then blocks of different places (at least ``block`` of them, as many as make 64
    blocks, at most 20,000) meet as arrays, a tile of two blocks a time, and each task adds up its own tiles. If ``b`` is the very
    frame ``a``, or with ``own``, each two blocks meet once. What is sent grows with the places, up to 64 blocks of 20,000 of them.
    """
    mirrored = own or a is b
    keys = list(by) or ["_all"]
    one = lambda df: checkpointed((df if by else df.withColumn("_all", F.lit(0))).groupBy(*keys, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).agg(F.count("*").alias("n")))
    left = one(a)
    right = left if mirrored else one(b)
    size = min(max(block, -(-max(left.count(), right.count()) // BLOCKS)), max(block, MOST_BLOCK))
    sizes = lambda df, k: df.groupBy(*keys).agg(F.count("*").alias(f"_n{k}"), F.sum("n").alias(f"_rows{k}"), F.sum(F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col("n")).otherwise(0)).alias(f"_known{k}"))
    groups = sizes(left, 1).join(sizes(right, 2), keys).filter("_rows1 > 1" if own else "true")
    groups = groups.withColumns({f"_b{k}": F.ceil(F.col(f"_n{k}") / size).cast("int") for k in (1, 2)})
    groups = checkpointed(groups.withColumn("_g", F.monotonically_increasing_id()))
    tiles, pairs = groups.agg(F.sum(F.col("_b1").cast("long") * F.col("_b2")), F.sum(F.col("_n1").cast("double") * F.col("_n2"))).first()
    tasks = max(1, min(tiles or 1, int((pairs or 0) / TASK_PAIRS), MOST_TASKS))
    place = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon", "n"))

    def side(df: DataFrame, k: int, own_at: str, other: str, every: Column) -> DataFrame:
        """Blocks of a side, once for each block of the other one that they meet."""
        dealt = df.join(groups.select(*keys, "_g", "_b1", "_b2"), keys).withColumn(own_at, F.pmod(F.xxhash64("lat", "lon"), F.col(f"_b{k + 1}")).cast("int"))
        packed = dealt.groupBy("_g", "_b1", "_b2", own_at).agg(F.collect_list(place).alias("places")).withColumn(other, F.explode(every))
        twice = F.when(F.col("_i") == F.col("_j"), 1).otherwise(2) if mirrored else F.lit(1)
        return packed.select("_g", "_i", "_j", F.lit(k).alias("_side"), twice.alias("_twice"), "places")

    first = side(left, 0, "_i", "_j", F.sequence(F.col("_i") if mirrored else F.lit(0), F.col("_b2") - 1))
    second = side(right, 1, "_j", "_i", F.sequence(F.lit(0), F.col("_j") if mirrored else F.col("_b1") - 1))
    met = first.unionByName(second).repartition(tasks, "_g", "_i", "_j").sortWithinPartitions("_g", "_i", "_j", "_side")
    partial = met.mapInArrow(_tiles, "_g long, angles double, pairs long, " + ", ".join(f"{k}{i} double" for k in ("low", "high") for i in range(4)))
    d = lambda k: geo.haversine_km(*(F.col(f"{k}{i}") for i in range(4)))
    counted = F.sum(F.col("pairs")) - (F.first("_known1") if own else F.lit(0))
    summed = groups.select(*keys, "_g", "_known1").join(partial, "_g", "left").groupBy(*keys).agg(
        F.try_divide(F.sum("angles") * geo.EARTH_KM, counted).alias("avg_km"), F.min(d("low")).alias("min_km"), F.when(counted > 0, F.max(d("high"))).alias("max_km")
    )
    return summed if by else summed.groupBy().agg(*[F.max(c).alias(c) for c in ("avg_km", "min_km", "max_km")])


def density_report(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Points, area of their bounding box in square km (111 km a degree) and points per 100 square km."""
    g = df.groupBy(*by).agg(F.count("*").alias("n"), (geo.deg_to_km(F.max("lat") - F.min("lat")) * geo.deg_to_km(F.max("lon") - F.min("lon"))).alias("area_km2"))
    return g.withColumn("density_100km2", F.try_divide(F.col("n") * 100.0, F.col("area_km2")))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 40) -> DataFrame:
    """(bin, n): equal bins from ``low`` to ``high``; 0 and bins + 1 hold what lies outside."""
    return df.groupBy(F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def region_crop_proportion(df: DataFrame, areas: DataFrame, by: str, strict_reference: bool = False) -> DataFrame:
    """Share of crop among labels and crop area of each region (``area_mha``); hectares ten times too many with ``strict_reference``."""
    share = df.groupBy(by).agg(F.avg("label").alias("proportion"), F.count("*").alias("n"))
    return share.join(areas, by).withColumn("crop_ha", F.col("proportion") * F.col("area_mha") * (1e7 if strict_reference else 1e6)).drop("area_mha")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows drawn by a hash of their key: the same rows on every run."""
    return df.orderBy(F.pmod(F.col(key) * 48271 + seed, F.lit(2147483647)), key).limit(n)


def reference_sample(pixels: DataFrame, n_by_class: dict[int, int], meta: dict[str, float], seed: int = 0) -> DataFrame:
    """A stratified sample of a class map: exactly n pixels a class (or all there are) with ids and places."""
    wanted = F.coalesce(*[F.when(F.col("value") == k, F.lit(n)) for k, n in n_by_class.items()])
    kept = pixels.withColumn("_n", wanted).filter(F.col("_n").isNotNull()).withColumn("_draw", F.xxhash64("row", "col", F.lit(seed)))
    # a class may hold most pixels: the smallest draws of each of its parts, then of the class among them
    parts = Window.partitionBy("value", F.pmod("_draw", F.lit(64))).orderBy("_draw", "row", "col")
    few_ = kept.withColumn("_place", F.row_number().over(parts)).filter(F.col("_place") <= F.col("_n"))
    w = Window.partitionBy("value").orderBy("_draw", "row", "col")
    x, y = geo.pixel_center(F.col("row"), F.col("col"), meta)
    return few_.withColumn("sample_id", F.row_number().over(w)).filter(F.col("sample_id") <= F.col("_n")).select("value", "sample_id", "row", "col", x.alias("x"), y.alias("y"))


def upsample_local(df: DataFrame, local: str = "is_local", label: str = "is_crop", key: str = "id", seed: int = 0) -> DataFrame:
    """``df`` with local rows of the rarer class repeated until both classes have as many.

    Every row has as many copies as fit; the remainder goes to the rows with the smallest hash of their (unique, whole) key. Where
    that order ends is found by counts of 4,096 ranges of the hash and by the rows of one range, so no task sorts a class.
    """
    counts = df.filter(local).agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    both = df.join(F.broadcast(counts), F.lit(True))  # one row
    small, big = F.least("_pos", "_neg"), F.greatest("_pos", "_neg")
    rare = F.col(local) & (F.col(label) == F.when(F.col("_pos") < F.col("_neg"), 1).otherwise(0)) & (small > 0)
    draw = F.pmod(F.col(key) * 48271 + seed, F.lit(2147483647))
    tagged = both.withColumns({"_draw": draw, "_range": F.floor(draw / 2**19), "_rare": F.coalesce(rare, F.lit(False)), "_whole": F.floor(F.try_divide(big, small)), "_rest": F.try_mod(big, small)})
    chosen = tagged.filter("_rare and _rest > 0")
    ranges = chosen.groupBy("_range", "_rest").agg(F.count("*").alias("n")).withColumn("_upto", F.sum("n").over(Window.orderBy("_range")))  # 4,096 rows
    last = ranges.filter(F.col("_upto") >= F.col("_rest")).orderBy("_range").limit(1).select("_range", (F.col("_rest") - F.col("_upto") + F.col("n")).alias("_take"))
    # the rows of one range in 4,096
    inside = chosen.select("_range", "_draw", F.col(key).alias("_key")).join(F.broadcast(last), "_range")
    cut = inside.withColumn("_place", F.row_number().over(Window.orderBy("_draw", "_key"))).filter(F.col("_place") <= F.col("_take")).agg(F.max(F.struct("_draw", "_key")).alias("_cut"))
    more = F.coalesce(F.struct("_draw", F.col(key).alias("_key")) <= F.col("_cut"), F.lit(False)).cast("int")
    times = F.when(F.col("_rare"), F.col("_whole").cast("int") + more).otherwise(1)
    return tagged.join(F.broadcast(cut), F.lit(True)).withColumn("copy", F.explode(F.sequence(F.lit(1), times))).select(*df.columns, "copy")  # cut is one row


def region_holdout(df: DataFrame, region: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``df`` with ``part``: train outside the region, test inside; extra points train as well."""
    region = region.select(as_parts(region).alias("parts"))
    test = join_regions(df, region, "left_semi").withColumn("part", F.lit("test"))
    train = join_regions(df, region, "left_anti").withColumn("part", F.lit("train"))
    both = train.unionByName(test)
    return both if extra is None else both.unionByName(extra.withColumn("part", F.lit("train")), allowMissingColumns=True)
