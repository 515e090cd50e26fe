"""Triangulation of regions, and places drawn evenly over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstat.operators.points import as_parts

Ring = list[tuple[float, float]]


def twice_area(ring: Ring) -> float:
    """Twice the signed area: positive for a ring against the clock."""
    x0, y0 = ring[0]
    return sum((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0) for (x1, y1), (x2, y2) in zip(ring[1:], ring[2:]))


def tidy(ring: Ring, left: bool) -> Ring:
    """A ring without repeated neighbours, against the clock with ``left``, else with it."""
    out = [p for k, p in enumerate(ring) if p != ring[k - 1]] if len(ring) > 1 else []
    if len(out) < 3:
        return []
    return out if (twice_area(out) > 0) == left else out[::-1]


def bridged(outer: Ring, holes: list[Ring]) -> Ring:
    """One ring that runs along the outer ring and, over a bridge seen from its rightmost corner, around each hole."""
    poly = list(outer)
    for hole in sorted(holes, key=lambda h: -max(h)[0]):
        at = hole.index(max(hole))
        mx, my = hole[at]
        hit, edge = np.inf, None
        for k, ((x1, y1), (x2, y2)) in enumerate(zip(poly, poly[1:] + poly[:1])):
            if min(y1, y2) <= my <= max(y1, y2) and y1 != y2:
                x = x1 + (my - y1) / (y2 - y1) * (x2 - x1)
                if mx <= x < hit:
                    hit, edge = x, k
        if edge is None:  # the hole is not inside
            continue
        j = max(edge, (edge + 1) % len(poly), key=lambda k: poly[k][0])
        px, py = poly[j]
        if (px, py) != (hit, my):  # corners inside the triangle of corner, hit and end would hide that end
            inside = [k for k, p in enumerate(poly) if p != (px, py) and p[0] >= mx and _holds((mx, my), (hit, my), (px, py), p)]
            if inside:
                j = min(inside, key=lambda k: (abs(poly[k][1] - my) / max(poly[k][0] - mx, 1e-300), poly[k][0]))
        poly = poly[: j + 1] + hole[at:] + hole[: at + 1] + poly[j:]
    return poly


def _side(a, b, p) -> float:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def _holds(a, b, c, p) -> bool:
    s = (_side(a, b, p), _side(b, c, p), _side(c, a, p))
    return min(s) >= 0 or max(s) <= 0


def triangles(ring: Ring) -> list[tuple[tuple[float, float], ...]]:
    """Triangles of a ring against the clock, by cutting ears: corners whose triangle holds no other corner."""
    xy = np.array(ring)
    left, out, start = list(range(len(ring))), [], 0
    while len(left) > 3:
        pts = xy[left]
        for step in range(len(left)):
            k = (start + step) % len(left)
            a, b, c = pts[k - 1], pts[k], pts[(k + 1) % len(left)]
            turn = _side(a, b, c)
            if turn < 0:
                continue
            if turn > 0:
                sides = [(q[0] - p[0]) * (pts[:, 1] - p[1]) - (q[1] - p[1]) * (pts[:, 0] - p[0]) for p, q in ((a, b), (b, c), (c, a))]
                within = (sides[0] >= 0) & (sides[1] >= 0) & (sides[2] >= 0)
                corner = (pts == a).all(1) | (pts == b).all(1) | (pts == c).all(1)
                if (within & ~corner).any():
                    continue
                out.append((tuple(a), tuple(b), tuple(c)))
            break
        else:  # rounding leaves no clear ear: take the thinnest corner
            turns = [abs(_side(pts[k - 1], pts[k], pts[(k + 1) % len(left)])) for k in range(len(left))]
            k = int(np.argmin(turns))
            if _side(pts[k - 1], pts[k], pts[(k + 1) % len(left)]) > 0:
                out.append((tuple(pts[k - 1]), tuple(pts[k]), tuple(pts[(k + 1) % len(left)])))
        del left[k]
        start = k % len(left)
    a, b, c = xy[left]
    if _side(a, b, c) > 0:
        out.append((tuple(a), tuple(b), tuple(c)))
    return out


def triangulate(regions: DataFrame, key: str = "region_id") -> DataFrame:
    """(key, tri, x1, y1, x2, y2, x3, y3, area, upto, below): triangles of each region (a ``ring``, or ``parts`` with holes), their area in
    the plane, and the share of the region up to a triangle with it and without it.

    Parts stand side by side. Rings with fewer than three corners and regions without a geometry have no triangles. A region is one row
    and one task takes it whole; the time of a ring grows with the square of its corners.
    """
    kind = regions.schema[key].dataType.simpleString()
    names = ["key", "tri", "x1", "y1", "x2", "y2", "x3", "y3", "area", "upto", "below"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, parts in enumerate(batch.column(1).to_pylist()):
                found = []
                for part in parts or ():
                    rings = [[(p["x"], p["y"]) for p in r] for r in part or ()]
                    outer = tidy(rings[0], True) if rings else []
                    if outer:
                        found += triangles(bridged(outer, [h for h in (tidy(r, False) for r in rings[1:]) if h]))
                if found:
                    flat = np.array(found, dtype=float).reshape(-1, 6)
                    x1, y1, x2, y2, x3, y3 = flat.T
                    area = ((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2
                    upto = np.append(np.cumsum(area)[:-1] / area.sum(), 1.0)
                    columns = [batch.column(0).take(pa.array([k] * len(flat))), pa.array(np.arange(len(flat), dtype=np.int32))]
                    columns += [pa.array(np.ascontiguousarray(c)) for c in (*flat.T, area, upto, np.append(0.0, upto[:-1]))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    doubles = ", ".join(f"{c} double" for c in names[2:])
    found = regions.select(F.col(key).alias("key"), as_parts(regions).alias("parts")).mapInArrow(run, f"key {kind}, tri int, {doubles}")
    return found.withColumnRenamed("key", key)


def points_in_polygons(regions: DataFrame, n: int, seed: int = 0, key: str = "region_id") -> DataFrame:
    """(key, draw, x, y): exactly ``n`` places in each region that has an area, however thin, with holes and parts.

    Draws go to triangles by their area (systematic draws from one start) and then evenly inside: none is thrown away. The same
    seed gives the same places.
    """
    u = lambda *of: F.pmod(F.xxhash64(key, F.lit(seed), *of), F.lit(2**40)) / float(2**40)
    upto = lambda c: F.floor(F.col(c) * n + u(F.lit(0)))  # noqa: E731  draws of all triangles up to there
    tri = triangulate(regions, key).filter(upto("upto") > upto("below"))
    drawn = tri.withColumn("draw", F.explode(F.sequence(upto("below") + 1, upto("upto"))))
    a, b = u(F.lit(1), F.col("draw")), u(F.lit(2), F.col("draw"))
    a, b = F.when(a + b > 1, 1 - a).otherwise(a), F.when(a + b > 1, 1 - b).otherwise(b)
    at = lambda c: (F.col(f"{c}1") + a * (F.col(f"{c}2") - F.col(f"{c}1")) + b * (F.col(f"{c}3") - F.col(f"{c}1"))).alias(c)
    return drawn.select(key, F.col("draw").cast("int").alias("draw"), at("x"), at("y"))
