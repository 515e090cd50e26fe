"""Geometry as column expressions. A ring is an array of structs (x, y) without a repeated last vertex; a part is a list of rings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), F.lit(2.0)) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    return EARTH_KM * 2 * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(0.0), 1 - h)))


def deg_to_km(c: Column) -> Column:
    return c * KM_PER_DEGREE


def unit_xyz(lat: Column, lon: Column) -> Column:
    a, o = F.radians(lat), F.radians(lon)
    return F.struct((F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z"))


def pixel_center(row: Column, col: Column, meta: dict[str, float]) -> tuple[Column, Column]:
    """(x, y) of the centre of a pixel under the affine map a, b, c, d, e, f."""
    c, r = col + 0.5, row + 0.5
    return c * meta["a"] + r * meta["b"] + meta["c"], c * meta["d"] + r * meta["e"] + meta["f"]


def rowcol(x: Column, y: Column, meta: dict[str, float]) -> tuple[Column, Column]:
    """(row, col) of the pixel that holds a place; they may lie outside the raster."""
    a, b, c, d, e, f = (meta[k] for k in "abcdef")
    det = a * e - b * d
    col = ((x - c) * e - (y - f) * b) / det
    row = ((y - f) * a - (x - c) * d) / det
    return F.floor(row).cast("int"), F.floor(col).cast("int")


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1))


def _rotated(ring: Column) -> Column:
    return F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))


def _crosses(p: Column, q: Column, x: Column, y: Column) -> Column:
    between = (p["y"] <= y) != (q["y"] <= y)
    at = p["x"] + F.try_divide((y - p["y"]) * (q["x"] - p["x"]), q["y"] - p["y"])
    return (between & F.coalesce(x < at, F.lit(False))).cast("int")


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring holds a place, by crossings of a ray to the right.

    Half open: an edge counts from its lower end up to but without its upper one, so of two rings that share an edge one holds a
    place on it. For a box that is x0 <= x < x1 and y0 <= y < y1.
    """

    hits = F.zip_with(ring, _rotated(ring), lambda p, q: _crosses(p, q, x, y))
    return F.aggregate(hits, F.lit(0), lambda a, h: a + h) % 2 == 1


def holds(parts: Column, x: Column, y: Column) -> Column:
    """Whether any part holds a place. A part is a list of rings, the outer one and its holes: an odd number of them holds the place."""
    odd = lambda part: F.aggregate(part, F.lit(0), lambda a, ring: a + contains(ring, x, y).cast("int")) % 2 == 1
    return F.exists(parts, odd)


def edges_right(parts: Column, x0: Column, y0: Column, y1: Column) -> Column:
    """Of each part the edges (p, q) that a ray to the right can cross from a place with x >= x0 and y0 <= y <= y1; parts without any are left out."""

    def ahead(e: Column) -> Column:
        p, q = e["p"], e["q"]
        return (F.least(p["y"], q["y"]) <= y1) & (F.greatest(p["y"], q["y"]) >= y0) & (F.greatest(p["x"], q["x"]) >= x0)

    of_ring = lambda ring: F.filter(F.zip_with(ring, _rotated(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q"))), ahead)
    return F.filter(F.transform(parts, lambda part: F.flatten(F.transform(part, of_ring))), lambda edges: F.size(edges) > 0)


def edges_hold(edges: Column, x: Column, y: Column) -> Column:
    """``holds`` by the edges of ``edges_right``: an odd number of crossings of any part."""
    return F.exists(edges, lambda part: F.aggregate(part, F.lit(0), lambda a, e: a + _crosses(e["p"], e["q"], x, y)) % 2 == 1)


def edge_near(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether the bounds of any edge of a ring meet a box."""
    meets = lambda p, q: (F.least(p["x"], q["x"]) <= x1) & (F.greatest(p["x"], q["x"]) >= x0) & (F.least(p["y"], q["y"]) <= y1) & (F.greatest(p["y"], q["y"]) >= y0)
    return F.exists(F.zip_with(ring, _rotated(ring), meets), lambda b: b)


def ring_area(ring: Column) -> Column:
    """Area by the shoelace formula, in squared units of the coordinates."""
    parts = F.zip_with(ring, _rotated(ring), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)) / 2


def centroid(ring: Column) -> Column:
    """The centroid of a ring as a struct (x, y); null for a ring without area."""
    w = F.zip_with(ring, _rotated(ring), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    total = F.aggregate(w, F.lit(0.0), lambda a, v: a + v)
    one = lambda k: F.aggregate(F.zip_with(ring, _rotated(ring), lambda p, q: (p[k] + q[k]) * (p["x"] * q["y"] - q["x"] * p["y"])), F.lit(0.0), lambda a, v: a + v)
    return F.struct(F.try_divide(one("x"), 3 * total).alias("x"), F.try_divide(one("y"), 3 * total).alias("y"))


def ring_bounds(ring: Column) -> Column:
    of = lambda f, k: f(F.transform(ring, lambda p: p[k]))
    return F.struct(of(F.array_min, "x").alias("min_x"), of(F.array_min, "y").alias("min_y"), of(F.array_max, "x").alias("max_x"), of(F.array_max, "y").alias("max_y"))


def point_box(lat: Column, lon: Column, size: float) -> Column:
    """The box of ``size`` degrees around a place."""
    h = size / 2
    return F.struct((lat - h).alias("min_lat"), (lat + h).alias("max_lat"), (lon - h).alias("min_lon"), (lon + h).alias("max_lon"))


def tile_grid(boxes: DataFrame, rows: int, cols: int) -> DataFrame:
    """``boxes`` (x0, y0, x1, y1) cut into rows by cols tiles: tile_row, tile_col and the tile's own corners."""
    each = boxes.withColumn("tile_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("tile_col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    w, h = (F.col("x1") - F.col("x0")) / cols, (F.col("y1") - F.col("y0")) / rows
    return each.withColumns({"tx0": F.col("x0") + F.col("tile_col") * w, "ty0": F.col("y0") + F.col("tile_row") * h, "tx1": F.col("x0") + (F.col("tile_col") + 1) * w, "ty1": F.col("y0") + (F.col("tile_row") + 1) * h})


def find_regions(regions: DataFrame, code: str, names: list[str] | None = None) -> DataFrame:
    """Regions whose code starts with ``code``, of the given names if any."""
    kept = regions.filter(F.col("code").startswith(code))
    return kept if names is None else kept.filter(F.col("region").isin(*names))


def missing_regions(regions: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(regions.select("region"), "region", "left_anti")


def dissolve(regions: DataFrame, by: str) -> DataFrame:
    """One row a group with all its parts, as ``holds`` and ``join_regions`` take them. A region's rings, not data rows."""
    part = F.flatten(F.collect_list("parts")) if "parts" in regions.columns else F.collect_list(F.array("ring"))
    return regions.groupBy(by).agg(part.alias("parts"))


# Transverse Mercator on WGS84: fixed values of the ellipsoid and the zones' scale and offsets; series by Krueger (1912).
A, FLAT, K0, EAST, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
N3 = FLAT / (2 - FLAT)
RECT = A / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
ALPHA = (N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16, 13 * N3**2 / 48 - 3 * N3**3 / 5, 61 * N3**3 / 240)
BETA = (N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96, N3**2 / 48 + N3**3 / 15, 17 * N3**3 / 480)
DELTA = (2 * N3 - 2 * N3**2 / 3 - 2 * N3**3, 7 * N3**2 / 3 - 8 * N3**3 / 5, 56 * N3**3 / 15)


def _zone(epsg: int) -> tuple[float, bool]:
    if not (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
        raise ValueError(f"EPSG {epsg} is not a UTM zone on WGS84")
    return math.radians((epsg % 100) * 6 - 183), epsg >= 32700


def wgs84_to_utm(lat: Column, lon: Column, epsg: int) -> tuple[Column, Column]:
    """(easting, northing) in a UTM zone."""
    mid, south = _zone(epsg)
    e = 2 * math.sqrt(N3) / (1 + N3)
    phi, lam = F.radians(lat), F.radians(lon) - mid
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EAST + K0 * RECT * x, (SOUTH if south else 0.0) + K0 * RECT * y


def utm_to_wgs84(easting: Column, northing: Column, epsg: int) -> tuple[Column, Column]:
    """(lat, lon) of a place in a UTM zone."""
    mid, south = _zone(epsg)
    xi0, eta0 = (northing - (SOUTH if south else 0.0)) / (K0 * RECT), (easting - EAST) / (K0 * RECT)
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi), F.degrees(F.atan2(F.sinh(eta), F.cos(xi)) + mid)
