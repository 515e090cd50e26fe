"""Triangulated regions and draws in them, files of several encodings, and stored sketches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from landstat.operators import sketches as sk
from landstat.operators import spans as sp
from landstat.operators import triangles as tr
from landstat.sources import files

PARTS = "region_id string, parts array<array<array<struct<x double, y double>>>>"


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def holds(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def star(rng, n, cx, cy, low, high):
    at = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(cx + r * math.cos(a), cy + r * math.sin(a)) for a in at for r in [rng.uniform(low, high)]]


def shapes():
    rng = random.Random(2)
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    out = {
        "box": [[box(0, 0, 4, 2)]],
        "clockwise": [[box(0, 0, 4, 2)[::-1]]],
        "sliver": [[[(0, 0), (1000, 1e-6), (1000, 2e-6)]]],
        "comb": [[[(0, 0), (10, 0), (10, 5), (9, 1), (8, 5), (7, 1), (6, 5), (5, 1), (4, 5), (3, 1), (2, 5), (1, 1), (0, 5)]]],
        "holes": [[box(0, 0, 10, 10), box(1, 1, 2, 2), box(3, 3, 6, 4), box(7, 1, 8, 9), box(1, 5, 2, 9)]],
        "parts": [[box(0, 0, 1, 1)], [box(5, 5, 9, 9), box(6, 6, 8, 8)], [[(20, 0), (21, 0), (20, 1)]]],
        "repeated": [[[(0, 0), (0, 0), (2, 0), (2, 0), (2, 2), (1, 2), (1, 2), (0, 2)]]],
    }
    for k in range(25):
        ring = star(rng, rng.randint(4, 60), 0, 0, 3, 9)
        inner = [star(rng, rng.randint(3, 8), 1.2 * math.cos(2 * a), 1.2 * math.sin(2 * a), 0.1, 0.5) for a in range(k % 3)] if k % 2 else []
        if all(holds(ring, *p) for h in inner for p in h) and all(not holds(h, 0, 0) for h in inner):
            out[f"star{k}"] = [[ring, *inner]]
    return out


@pytest.fixture(scope="module")
def regions(spark):
    rows = [(k, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in part] for part in parts]) for k, parts in shapes().items()]
    return spark.createDataFrame([*rows, ("none", None), ("empty", []), ("line", [[[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]])], PARTS)


def test_triangles_have_the_area_of_the_region(regions):
    got = {r["region_id"]: r for r in tr.triangulate(regions).groupBy("region_id").agg(F.sum("area").alias("a"), F.min("area").alias("least"), F.count("*").alias("n")).collect()}
    want = {k: sum(area(part[0]) - sum(map(area, part[1:])) for part in parts) for k, parts in shapes().items()}
    assert got.keys() == want.keys() and len(want) > 15
    for k, a in want.items():
        assert got[k]["a"] == pytest.approx(a, rel=1e-9) and got[k]["least"] >= 0, k
    assert got["box"]["n"] == 2 and got["holes"]["n"] <= 4 + 16 + 2 * 4 - 2  # corners on a line need none


def test_draws_are_exactly_n_and_inside(regions):
    n, by = 400, {}
    for r in tr.points_in_polygons(regions, n, seed=5).collect():
        by.setdefault(r["region_id"], []).append((r["draw"], r["x"], r["y"]))
    assert by.keys() == shapes().keys()
    for k, drawn in by.items():
        assert sorted(d for d, _, _ in drawn) == list(range(1, n + 1)), k
        if k != "sliver":
            inside = [any(holds(p[0], x, y) and not any(holds(h, x, y) for h in p[1:]) for p in shapes()[k]) for _, x, y in drawn]
            assert sum(inside) >= n - 2, k  # those on an edge may fall either way
    left = sum(x < 5 for _, x, _ in by["parts"])
    assert abs(left - n / 13.5) <= 2  # draws follow the area
    again = tr.points_in_polygons(regions, n, seed=5).repartition(7).collect()
    assert {(r["region_id"], r["draw"], r["x"], r["y"]) for r in again} == {(k, *d) for k, drawn in by.items() for d in drawn}
    assert tr.points_in_polygons(regions.limit(0), n).count() == 0


def test_labels_of_several_encodings(spark, tmp_path):
    at = tmp_path / "labels"
    at.mkdir()
    (at / "a.csv").write_bytes("id,name\n1,Café\n2,日本\n".encode())
    (at / "b.csv").write_bytes("id,name\n3,Café\n4,plain\n".encode("latin-1"))
    (at / "c.csv").write_bytes(b"id,name\n5,broken \xff\xfe\n")
    got = files.read_labels(spark, str(at / "*.csv"), "id int, name string", encoding=None)
    assert {r["id"]: r["name"] for r in got.collect()} == {1: "Café", 2: "日本", 3: "Café", 4: "plain", 5: "broken ÿþ"}
    assert {k: len(v) for k, v in files.encodings(spark, str(at)).items()} == {"UTF-8": 1, "ISO-8859-1": 2}
    one = files.read_labels(spark, str(at / "b.csv"), "id int, name string", encoding=None)
    assert {r["name"] for r in one.collect()} == {"Café", "plain"}


def test_stored_sketches_unite(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7_000).alias("who"), F.pmod(F.xxhash64("id"), F.lit(1_000)).cast("double").alias("secs"))
    rows = rows.unionByName(spark.createDataFrame([(0, None, None)], rows.schema))
    sk.sketches(rows, ["day"], "who", "secs").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 30
    for low, high in ((0, 29), (3, 10)):
        some = rows.filter(F.col("day").between(low, high))
        got = sk.estimates(sk.united(stored.filter(F.col("day").between(low, high))), [0.1, 0.5, 0.99]).first()
        exact = some.agg(F.count_distinct("who")).first()[0]
        assert got["n"] == some.count() and abs(got["items"] - exact) <= 0.04 * exact
        values = sorted(r[0] for r in some.select("secs").dropna().collect())
        for q, v in ((0.1, got["q0"]), (0.5, got["q1"]), (0.99, got["q2"])):
            assert sum(x < v for x in values) / len(values) - 0.02 <= q <= sum(x <= v for x in values) / len(values) + 0.02


GRID = {"a": 0.5, "b": 0.0, "c": -12.0, "d": 0.0, "e": -0.5, "f": 11.0}


def passes(p, q, col, row):
    """Does the edge run through the inside of a pixel? Cut it by the pixel's four sides."""
    (x1, y1), (x2, y2) = (((x + 12) / 0.5, (y - 11) / -0.5) for x, y in (p, q))
    low, high = 0.0, 1.0
    for a, d, lo, hi in ((x1, x2 - x1, col, col + 1), (y1, y2 - y1, row, row + 1)):
        if d == 0:
            if not lo < a < hi:
                return False
        else:
            s, t = sorted(((lo - a) / d, (hi - a) / d))
            low, high = max(low, s), min(high, t)
    return low < high - 1e-12


@pytest.mark.parametrize("touched", [False, True])
def test_clip_by_scanlines(spark, regions, touched):
    names = ["holes", "parts", "comb", "clockwise", "star1", "star3", "star4"]
    shapes_, n = {k: v for k, v in shapes().items() if k in names}, 70
    pixels = spark.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), F.lit(1.0).alias("value"))
    spans = sp.region_spans(regions, GRID, touched)
    got = sp.clip_to_spans(pixels, GRID, regions, touched).filter(F.col("region_id").isin(names))
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    rows = [(r["region_id"], r["row"], r["col"]) for r in got.collect()]
    assert len(rows) == len(set(rows))
    for k, parts in shapes_.items():
        rings = [ring for part in parts for ring in part]
        want = set()
        for row in range(n):
            for col in range(n):
                inside = sum(holds(r, -12 + 0.5 * (col + 0.5), 11 - 0.5 * (row + 0.5)) for r in rings) % 2 == 1
                if inside or (touched and any(passes(p, q, col, row) for r in rings for p, q in zip(r, r[1:] + r[:1]))):
                    want.add((k, row, col))
        assert {r for r in rows if r[0] == k} == want, k
    wide = spans.groupBy("region_id", "row").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("px"), F.max("c1").alias("high"), F.min("c0").alias("low")).filter("px > high - low + 1").count()
    assert wide == 0
    with pytest.raises(ValueError):
        sp.region_spans(regions, GRID | {"b": 0.1})
