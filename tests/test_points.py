"""Samples and distances against counts and brute force."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from landstat.operators import labels, raster
from landstat.operators import points as p
from landstat.plans import bindings as b
from landstat.plans.places import META


def test_reference_sample_of_clumped_classes_is_exact(spark):
    # eight classes, each a single line of pixels, and one with fewer pixels than are wanted
    lines = spark.range(8_000).select((F.col("id") / 1000).cast("int").alias("value"), (F.floor(F.col("id") / 1000) * 611).cast("int").alias("row"), (F.col("id") % 1000).cast("int").alias("col"))
    small = spark.range(7).select(F.lit(8).alias("value"), F.lit(9_999).alias("row"), F.col("id").cast("int").alias("col"))
    pixels = lines.unionByName(small)
    got = p.reference_sample(pixels, {k: 50 for k in range(9)}, META).collect()
    for k in range(9):
        ids = sorted(r["sample_id"] for r in got if r["value"] == k)
        assert ids == list(range(1, (50 if k < 8 else 7) + 1))
    assert len({(r["row"], r["col"]) for r in got}) == len(got) == 407
    again = p.reference_sample(pixels.repartition(3), {k: 50 for k in range(9)}, META).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def km(p1, p2):
    (a, c), (d, e) = (map(math.radians, x) for x in (p1, p2))
    h = math.sin((d - a) / 2) ** 2 + math.cos(a) * math.cos(d) * math.sin((e - c) / 2) ** 2
    return 6371 * 2 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def test_distances_of_the_whole_table_against_brute_force(spark, sf):
    whole = b.points(spark, sf).select("id", "lat", "lon")
    whole = whole.unionByName(whole.filter("id <= 5").withColumn("id", F.col("id") + 1_000_000))  # places that occur twice
    rows = {r["id"]: (r["lat"], r["lon"]) for r in whole.collect()}
    all_km = {(i, j): km(x, y) for i, x in rows.items() for j, y in rows.items()}
    near = {(r["id_a"], r["id_b"]): r["km"] for r in p.within_distance(whole, whole, 300.0).filter("id_a <> id_b").collect()}
    assert near.keys() == {k for k, d in all_km.items() if d <= 300 and k[0] != k[1]} and all(d == pytest.approx(all_km[k], abs=1e-6) for k, d in near.items())
    frame = p.pairwise_distance(whole, whole, block=20)
    assert "CartesianProduct" not in (plan := frame._jdf.queryExecution().toString()) and "NestedLoop" not in plan
    got = frame.first()
    assert got["avg_km"] == pytest.approx(sum(all_km.values()) / len(all_km)) and got["max_km"] == pytest.approx(max(all_km.values()))
    assert got["min_km"] == pytest.approx(min(d for (i, j), d in all_km.items() if rows[i] != rows[j]))
    halves = whole.withColumn("subset", F.col("id") % 2)
    own = {r["subset"]: r for r in p.pairwise_distance(halves, halves, ["subset"], own=True, block=20).collect()}
    for k in (0, 1):
        among = [d for (i, j), d in all_km.items() if i % 2 == j % 2 == k and i != j]
        assert own[k]["avg_km"] == pytest.approx(sum(among) / len(among)) and own[k]["max_km"] == pytest.approx(max(among))
    next_ = {r["id_a"]: (r["km"], r["id_b"]) for r in p.nearest(whole, whole, other=True).collect()}
    assert next_.keys() == rows.keys() and all(d == pytest.approx(min(all_km[i, x] for x in rows if x != i), abs=1e-6) and j != i for i, (d, j) in next_.items())


def test_many_boxes_meet_points_by_cells(spark, sf):
    from landstat.operators.labels import join_bbox

    points = b.points(spark, sf).select("id", "lat", "lon")
    boxes = spark.createDataFrame([(f"b{i}", -70.0 + i, -66.5 + i, -180.0 + 2 * i, -150.0 + 2 * i) for i in range(120)] + [("point", 0.0, 0.0, 0.0, 0.0), ("none", 5.0, 4.0, 0.0, 1.0)], "name string, min_lat double, max_lat double, min_lon double, max_lon double")
    cells = join_bbox(points, boxes, most=1)
    assert "NestedLoop" not in (plan := cells._jdf.queryExecution().toString()) and "Cartesian" not in plan
    assert sorted(map(tuple, cells.select("id", "name").collect())) == sorted(map(tuple, join_bbox(points, boxes).select("id", "name").collect()))


def test_crowded_cells_are_cut_and_lose_no_pair(spark, sf):
    from landstat.operators.cells import meet
    from landstat.operators.labels import join_bbox

    left = spark.range(300).select(F.when(F.col("id") < 200, 0).when(F.col("id") < 290, F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    right = spark.range(120).select(F.when(F.col("id") < 70, 0).when(F.col("id") < 110, F.col("id") % 9).alias("k"), F.col("id").alias("b")).unionAll(spark.sql("select 0 as k, 5L as b from range(3)"))
    want = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    for most_hot in (50_000, 1):  # with one cut key at most, the bound on rows is raised
        cut = meet(left, right, ["k"], 20, most_hot)
        assert sorted(map(tuple, cut.select("k", "a", "b").collect())) == want and cut.columns == ["k", "a", "b"]
    points = b.points(spark, sf).select("id", "lat", "lon")
    clump = points.unionByName(points.selectExpr("id + 1000000 as id", "1 + id % 50 / 100 as lat", "2 + id % 30 / 100 as lon"))
    pairs = lambda most: sorted((r["id_a"], r["id_b"], round(r["km"], 6)) for r in p.within_distance(clump, clump, 40.0, most).collect())
    assert pairs(30) == pairs(10**9) and len(pairs(30)) > 5_000
    boxes = spark.range(60).selectExpr("concat('b', id) as name", "0.5 + id / 100 as min_lat", "1.5D as max_lat", "1.5 + id / 100 as min_lon", "9.0D as max_lon")
    held = lambda **how: sorted(map(tuple, join_bbox(clump, boxes, **how).select("id", "name").collect()))
    assert held(most=1, most_rows=25) == held()


def test_a_region_of_any_size_streams_through_one_call(spark):
    from landstat.operators.ml import per_region

    df = spark.range(10_000).select(F.when(F.col("id") % 10 > 0, "big").otherwise(F.when(F.col("id") % 20 > 0, "small")).alias("region"), "id")

    def size(frames):
        region, sizes, total = None, [], 0
        for f in frames:
            region, total = f["region"].iloc[0], total + int(f["id"].sum())
            sizes.append(len(f))
        yield pd.DataFrame({"region": [region], "n": [sum(sizes)], "most": [max(sizes)], "frames": [len(sizes)], "total": [total]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        got = {r["region"]: r for r in per_region(df, size, "region string, n long, most long, frames long, total long", "region").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {k: [i for i in range(10_000) if ("big" if i % 10 else "small" if i % 20 else None) == k] for k in ("big", "small", None)}
    assert {k: (r["n"], r["total"]) for k, r in got.items()} == {k: (len(v), sum(v)) for k, v in want.items()}
    assert got["big"]["frames"] >= 45 and got["big"]["most"] <= 200


@pytest.mark.parametrize(("k", "other", "sample"), [(1, False, 50_000), (3, True, 50_000), (3, False, 80), (2, True, 0)])
def test_nearest_of_clumped_places(spark, monkeypatch, k, other, sample):
    """Clumps of very different density, equal places, poles and the date line, against all distances."""
    import numpy as np

    from landstat.operators import neighbours

    monkeypatch.setattr(neighbours, "MOST", 50)
    rng = np.random.default_rng(k)
    clumps = [rng.normal(c, s, (n, 2)) for c, s, n in (((10, 10), 1e-3, 300), ((10.01, 10.01), 1e-6, 200), ((-40, 179.999), 0.01, 80), ((89.9, 0), 0.05, 40), ((0, 0), 30, 60))]
    at = np.concatenate([*clumps, np.repeat([[20.0, 20.0]], 50, 0)])
    at[:, 0] = np.clip(at[:, 0], -90, 90)
    at[:, 1] = (at[:, 1] + 180) % 360 - 180
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(at)] + [(10_000, None, 3.0)]
    places = spark.createDataFrame(rows, "id long, lat double, lon double")
    asking = places if other else spark.createDataFrame(rows[::3] + [(-1, 10.0005, 10.0005), (-2, 90.0, 0.0)], "id long, lat double, lon double")
    got = {}
    for r in neighbours.nearest(asking, places, k, other, sample).collect():
        got.setdefault(r["id_a"], []).append((r["km"], r["id_b"]))
    xyz = neighbours.unit(at[:, 0], at[:, 1])
    asked = [r for r in asking.collect() if r["lat"] is not None]
    assert set(got) == {r["id"] for r in asked}
    for r in asked:
        d = np.linalg.norm(xyz - neighbours.unit(np.array([r["lat"]]), np.array([r["lon"]])), axis=1)
        if other:
            d[r["id"]] = np.inf
        want = np.sort(d)[:k] * 6371
        found = sorted(got[r["id"]])
        assert len(found) == k and [x for x, _ in found] == pytest.approx(2 * 6371 * np.arcsin(want / 2 / 6371), abs=1e-6)
        ties = [j for x, j in found if x == 0]
        assert ties == [j for j in np.flatnonzero(d == 0).tolist()][: len(ties)]
    few = spark.createDataFrame([(7, 1.0, 1.0)], "id long, lat double, lon double")
    assert [(r["id_a"], r["id_b"]) for r in neighbours.nearest(few, few, 3).collect()] == [(7, 7)] and neighbours.nearest(places.limit(0), few).count() == neighbours.nearest(few, places.limit(0)).count() == 0


def test_few_cells_are_asked(spark):
    """Dense clumps far apart: a place asks a few cells, however dense its own is, and a cell holds a bounded share."""
    import numpy as np

    from landstat.operators import neighbours

    rng = np.random.default_rng(1)
    at = np.concatenate([rng.normal(0, 1e-5, (3_000, 2)), rng.normal(40, 5, (1_000, 2))])
    xyz = neighbours.unit(at[:, 0], at[:, 1])
    tree = neighbours.Tree(xyz, 16)
    assert max(map(len, tree.leaves)) <= 16
    cells = neighbours.Tree(xyz[::10], 16)
    own = cells.owner(xyz)
    assert np.bincount(own).max() <= 400
    far, _ = neighbours.best(tree, xyz, np.arange(len(xyz)), xyz, 4, np.full(len(xyz), 4.0))
    low = np.array([xyz[own == c].min(0) for c in range(len(cells.leaves))])
    high = np.array([xyz[own == c].max(0) for c in range(len(cells.leaves))])
    cells.fit(low, high)
    assert sum(len(rows) for _, rows in cells.within(xyz, far[:, -1])) <= 4 * len(xyz)


def test_checks_before_a_run(spark):
    maps = spark.createDataFrame([("a", 0.5, None), ("b", None, [1]), ("c", 0.5, [1]), ("d", None, None), ("e", None, []), ("f", 0.5, [])], "title string, threshold double, crop_classes array<int>")
    assert {r["title"]: r["problem"] for r in labels.bad_maps(maps).collect()} == {"c": "both", "d": "neither", "e": "neither"}
    splits = spark.createDataFrame([(1, 0.8, 0.1, 0.1), (2, 0.8, 0.1, 0.2), (3, None, 0.5, 0.5), (4, 1.2, -0.1, -0.1), (5, 0.7, 0.2, 0.1)], "id int, train double, val double, test double")
    assert sorted(r["id"] for r in labels.bad_splits(splits).collect()) == [2, 3, 4]


def test_points_against_a_map(spark):
    pixels = spark.createDataFrame([(0, 0, 0.9), (0, 1, 0.5), (1, 0, 0.1)], "row int, col int, value double")
    points = spark.createDataFrame([(1, 0.5, 9.5, 1.0, "maize", "x"), (2, 1.5, 9.5, 0.0, None, "y"), (3, 0.5, 8.5, 0.5, "teff", None), (4, 5.5, 5.5, 1.0, "maize", "x"), (5, None, 9.5, None, "maize", "x")], "id int, lon double, lat double, class_probability double, crop_type string, eo_data string")
    got = {r["id"]: tuple(r)[1:] for r in raster.compare_points(points, pixels, {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -1.0, "f": 10.0}, keep=["crop_type", "eo_data"]).collect()}
    assert got == {1: (1.0, 1, 0.9, "maize", "x"), 2: (0.0, 0, 0.5, None, "y"), 3: (0.5, 0, 0.1, "teff", None), 4: (1.0, None, None, "maize", "x"), 5: (None, None, None, "maize", "x")}


def test_all_pairs_meet_as_tiles_of_blocks(spark):
    # clumps within metres of each other and of their antipodes, places that repeat, groups of one row, without a name, without places
    rows = [(i, 10 + i * 1e-6, 20 + (i % 7) * 1e-6, "near") for i in range(30)] + [(40 + i, -10 - i * 1e-6, -160.0, "near") for i in range(9)]
    rows += [(100 + i, (i * 37) % 160 - 80.0, (i * 71) % 360 - 180.0, "far") for i in range(50)] + [(200 + i, 1.5, 2.5, "far") for i in range(4)]
    rows += [(300, 5.0, 5.0, "single"), (301, None, 5.0, "unplaced"), (302, 1.0, None, "unplaced"), (303, 1.0, 1.0, None), (304, 2.0, 2.0, None)]
    frame = spark.createDataFrame(rows, "id int, lat double, lon double, grp string")
    known = [r for r in rows if r[1] is not None and r[2] is not None and r[3]]
    for block in (2_000, 7):
        own = p.pairwise_distance(frame, frame, ["grp"], own=True, block=block)
        assert "MapInArrow" in own._jdf.queryExecution().toString()
        got = {r["grp"]: r for r in own.collect()}
        assert got.keys() == {"near", "far", "unplaced"} and [got["unplaced"][c] for c in ("avg_km", "min_km", "max_km")] == [None] * 3
        other = frame.filter("id % 3 = 0")
        two = {r["grp"]: r for r in p.pairwise_distance(frame, other, ["grp"], block=block).collect()}
        for g in ("near", "far"):
            pairs = lambda keep: [(x[1:3] == y[1:3], km(x[1:3], y[1:3])) for x in known for y in known if x[3] == y[3] == g and keep(x, y)]
            for found, among in ((got[g], pairs(lambda x, y: x[0] != y[0])), (two[g], pairs(lambda x, y: y[0] % 3 == 0))):
                assert found["avg_km"] == pytest.approx(sum(d for _, d in among) / len(among), abs=1e-6)
                assert found["min_km"] == pytest.approx(min(d for same, d in among if not same), abs=1e-9)
                assert found["max_km"] == pytest.approx(max(d for _, d in among), abs=1e-3 if g == "near" else 1e-6)
    none = p.pairwise_distance(frame, frame.filter("id < 0")).collect()
    assert [tuple(r) for r in none] == [(None, None, None)]


def test_rows_of_one_place_meet_as_one(spark):
    rows = [(i if i else None, 10.0, 20.0) for i in range(120)] + [(1_000 + i, 10.5, 20.5) for i in range(45)] + [(2_000, 10.2, 20.2), (2_001, 50.0, 20.0), (2_001, 50.0, 20.0), (2_002, None, 20.0)]
    frame = spark.createDataFrame(rows, "id int, lat double, lon double")
    want = sorted((x[0] or 0, y[0] or 0, round(km(x[1:], y[1:]), 4)) for x in rows for y in rows if x[1] and y[1] and km(x[1:], y[1:]) <= 60)
    for copies in (1_000, 50, 7):
        near = p.within_distance(frame, frame, 60.0, digits=4, copies=copies)
        assert sorted((r["id_a"] or 0, r["id_b"] or 0, r["km"]) for r in near.collect()) == want
    assert p._with_copies(frame, "a").count() == 4  # the distances of a pair of places are computed once, however many rows they have
