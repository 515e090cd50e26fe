"""Area estimates from end to end, geometry with holes and parts, and clips by blocks, against plain Python."""

import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.operators import areas as ar
from landstat.operators import metrics as m
from landstat.operators import points as p
from landstat.operators import raster as r
from landstat.plans import registry
from landstat.sources import files

META = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -1.0, "f": 20.0}
RING = "array<struct<x:double,y:double>>"


def box(x0, y0, x1, y1):
    return [(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]


def inside(part, x, y):
    odd = 0
    for ring in part:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            odd += (ay <= y) != (by <= y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
    return odd % 2 == 1


PARTS = [[box(1, 1, 12, 12), box(3, 3, 7, 7)], [[(14.0, 2.0), (19.0, 9.0), (15.0, 17.0)]]]  # a box with a hole, and a triangle


def grid(spark, n=20, name="A"):
    return spark.range(n * n).select(F.lit(name).alias("map"), F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), F.when(F.col("id") % 17 == 0, 255.0).when(F.col("id") % 3 == 0, 1.0).otherwise(0.0).alias("value"))


@pytest.mark.parametrize(("size", "most"), [(64, 10**6), (4, 10**6), (4, 0), (1, 0)])
def test_clip_takes_holes_and_parts_by_blocks(spark, size, most):
    regions = spark.createDataFrame([("r", PARTS), ("none", [])], f"roi string, parts array<array<{RING}>>")
    got = {(x["row"], x["col"]) for x in r.clip_pixels(grid(spark), META, regions, size, most).collect()}
    assert got == {(i, j) for i in range(20) for j in range(20) if any(inside(q, j + 0.5, 20 - i - 0.5) for q in PARTS)}


@pytest.mark.parametrize("most", [10**6, 0])
def test_points_meet_holes_and_parts(spark, most):
    regions = spark.createDataFrame([("r", PARTS)], f"roi string, parts array<array<{RING}>>")
    points = spark.range(1600).select("id", ((F.col("id") % 40) / 2 + 0.25).alias("lon"), (F.floor(F.col("id") / 40) / 2 + 0.25).alias("lat"))
    frame = p.join_regions(points, regions, most=most)
    assert "NestedLoop" not in (plan := frame._jdf.queryExecution().toString()) and "Cartesian" not in plan
    want = {i for i in range(1600) if any(inside(q, i % 40 / 2 + 0.25, i // 40 / 2 + 0.25) for q in PARTS)}
    assert sorted(x["id"] for x in frame.collect()) == sorted(want)


def blob(n, cx, cy, r):
    import math

    return [{"x": cx + r * (1 + 0.3 * math.sin(5 * k)) * math.cos(2 * math.pi * k / n), "y": cy + r * (1 + 0.3 * math.sin(5 * k)) * math.sin(2 * math.pi * k / n)} for k in range(n)]


def crowded(spark):
    """A third of all places within a small spot, a tenth at one place, the rest wide; one without a place."""
    import random

    rng = random.Random(3)
    rows = [(i, rng.gauss(10.3, 0.01), rng.gauss(-5.2, 0.01)) for i in range(1000)] + [(1000 + i, 10.0, -5.0) for i in range(300)] + [(1300 + i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(1700)]
    return rows, spark.createDataFrame(rows + [(9000, None, 1.0)], "id long, lon double, lat double")


def test_crowded_cells_are_cut(spark):
    rows, points = crowded(spark)
    cells = [r.asDict() for r in p.leaf_cells(points, "lon", "lat", 2.0, 100).collect()]
    assert sum(c["n"] for c in cells) == len(rows)
    for c in cells:
        size = 2.0 / 2 ** c["level"]
        assert c["n"] == sum(c["cx"] * size <= x < (c["cx"] + 1) * size and c["cy"] * size <= y < (c["cy"] + 1) * size for _, x, y in rows)
        assert c["n"] <= 100 or c["level"] == p.LEVELS
        assert c["n"] <= 100 * c["pieces"] < c["n"] + 100
    assert len({(c["level"], c["cx"], c["cy"]) for c in cells}) == len(cells) and max(c["level"] for c in cells) > 3
    few = p.leaf_cells(points, "lon", "lat", 2.0, 100, splits=20).filter("level > 0").count()
    assert few <= 4 * 20
    assert p.leaf_cells(points.filter("false"), "lon", "lat").count() == 0


@pytest.mark.parametrize("most", [10**6, 0])
def test_crowded_places_meet_regions(spark, most):
    rows, points = crowded(spark)
    shapes = {"wide": blob(40, 3, 2, 18), "spot": blob(9, 10.3, -5.2, 0.012), "near": blob(12, 11, -6, 2.5), "far": blob(5, 100, 60, 1)}
    regions = spark.createDataFrame([(k, len(v), v) for k, v in shapes.items()], f"roi string, level int, ring array<{'struct<x:double,y:double>'}>")
    want = sorted((i, k) for i, x, y in rows for k, ring in shapes.items() if inside([[(q["x"], q["y"]) for q in ring]], x, y))
    got = p.join_regions(points, regions, most=most, most_points=50)
    assert got.columns == ["id", "lon", "lat", "roi", "level", "ring"]
    assert sorted((r["id"], r["roi"]) for r in got.collect()) == want
    held = {i for i, _ in want}
    assert sorted(r["id"] for r in p.join_regions(points, regions, "left_semi", most=most, most_points=50).collect()) == sorted(held)
    assert sorted(r["id"] for r in p.join_regions(points, regions, "left_anti", most=most, most_points=50).collect()) == sorted({i for i, _, _ in rows} - held | {9000})


def test_cells_carry_only_edges_ahead(spark):
    ring = blob(400, 0, 0, 20)
    one = spark.createDataFrame([(ring,)], "ring array<struct<x:double,y:double>>").select(F.array(F.array("ring")).alias("parts"))
    cut = one.select(geo.edges_right(F.col("parts"), F.lit(10.0), F.lit(0.0), F.lit(2.0)).alias("e")).first()["e"]
    assert 0 < len(cut[0]) < 40 and all(max(e["p"]["x"], e["q"]["x"]) >= 10 for e in cut[0])


def test_geojson_parts_and_dissolve(spark, tmp_path):
    closed = lambda ring: [list(q) for q in (*ring, ring[0])]
    many = [[closed(ring) for ring in part] for part in PARTS]
    features = [{"properties": {"n": n}, "geometry": {"type": t, "coordinates": c}} for n, t, c in (("m", "MultiPolygon", many), ("p", "Polygon", many[0]), ("x", "Point", [1.0, 2.0]))]
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = files.read_geojson(spark, str(tmp_path), spark.createDataFrame([], "n string").schema)
    rows = rows.withColumn("parts", files.parts(F.col("coordinates"), F.col("geometry_type")))
    plain = lambda parts: [[[(q["x"], q["y"]) for q in ring] for ring in part] for part in parts]
    got = {x["n"]: x["parts"] for x in rows.collect()}
    assert plain(got["m"]) == PARTS and plain(got["p"]) == PARTS[:1] and got["x"] is None
    whole = geo.dissolve(rows.filter("parts is not null").withColumn("g", F.lit(1)), "g")
    point = spark.createDataFrame([(2.0, 2.0), (5.0, 5.0), (15.5, 8.0)], "lon double, lat double")
    assert sorted(x["lon"] for x in p.join_regions(point, whole).collect()) == [2.0, 15.5]


def first_answers(rows):
    out = {}
    for k, lon, lat, a, o in sorted(rows, key=lambda x: x[4]):
        out.setdefault(k, (lon, lat, {"Crop": 1, "Non-crop": 0}.get(a)))
    return out


def annotations(seed):
    answers = ["Crop", "Non-crop", "Crop", None, "Crop"]
    return [(k % 150, k % 150 % 20 + 0.5, k % 150 * 7 % 20 + 0.5, answers[(k * seed + k // 7) % 5], k * 13 % 401) for k in range(300)]


def test_jobs_by_region_and_year(spark, tmp_path):
    sets = {k: annotations(k) for k in (1, 2, 3)}
    frame = spark.createDataFrame([(k, *row) for k, rows in sets.items() for row in rows], "set_id int, plotid int, lon double, lat double, answer string, file_ord int")
    regions = spark.createDataFrame([("left", box(0, 0, 10, 20)), ("right", box(10, 0, 20, 20))], f"roi string, ring {RING}")
    maps = grid(spark).unionByName(grid(spark, name="B").withColumn("value", F.when(F.col("value") == 255.0, 0.0).otherwise(1 - F.col("value"))))
    rows = [{"roi": "left", "year": 2019, "map": "A", "set1": 1, "set2": 2}, {"roi": "left", "year": 2020, "map": "B", "set1": 2, "set2": 3}, {"roi": "right", "year": 2020, "map": "A", "set1": 3, "set2": 1}]
    with pytest.raises(ValueError, match="twice"):
        ar.area_jobs(spark, [*rows, rows[0]])
    got = {(x["roi"], x["year"], x["class"]): x for x in ar.estimate_areas(ar.area_jobs(spark, rows), maps, META, regions, frame, 30.0).collect()}
    value = {(x["map"], x["row"], x["col"]): x["value"] for x in maps.collect()}
    assert len(got) == 6
    for job in rows:
        one, two = first_answers(sets[job["set1"]]), first_answers(sets[job["set2"]])
        mine = lambda x, roi=job["roi"]: (x < 10) == (roi == "left")
        n = [[0, 0], [0, 0]]
        for k, (lon, lat, c) in one.items():
            at = value.get((job["map"], math.floor(20 - lat), math.floor(lon)))
            if c is not None and k in two and two[k][2] == c and at is not None and at != 255 and mine(lon):
                n[c][int(at)] += 1
        px = [sum(1 for (name, _, j), v in value.items() if name == job["map"] and v == c and mine(j)) for c in (0, 1)]
        total, nj = sum(px), [n[0][c] + n[1][c] for c in (0, 1)]
        for c in (0, 1):
            share = [px[j] / total * n[c][j] / nj[j] for j in (0, 1)]
            se = math.sqrt(sum((px[j] / total * share[j] - share[j] ** 2) / (nj[j] - 1) for j in (0, 1)))
            x = got[job["roi"], job["year"], c]
            assert x["area_ha"] == pytest.approx(sum(share) * total * 0.09) and x["ci_ha"] == pytest.approx(1.96 * se * total * 0.09)
    # one region and year alone gives the same
    own = [frame.filter(F.col("set_id") == k) for k in (1, 2)]
    alone = ar.estimate_area(maps.filter("map = 'A'"), META, regions.withColumnRenamed("roi", "region"), *own, 30.0).filter("region = 'left' and class = 1").first()
    assert alone["area_ha"] == pytest.approx(got["left", 2019, 1]["area_ha"]) and alone["ci_ha"] == pytest.approx(got["left", 2019, 1]["ci_ha"])
    estimates = ar.estimate_areas(ar.area_jobs(spark, rows), maps, META, regions, frame, 30.0)
    ar.write_area_results(estimates, str(tmp_path / "out"), ["left", "right"])
    table = [dict(x.asDict()) for x in spark.read.csv(str(tmp_path / "out"), header=True, inferSchema=True).collect()]
    assert [x["Year"] for x in table] == [2019, 2020] and table[0]["right crop area"] is None and len(table[0]) == 9
    assert table[1]["left crop area"] == pytest.approx(got["left", 2020, 1]["area_ha"], abs=0.006)
    summary = {x["metric"]: x for x in ar.area_summary(estimates.filter("roi = 'right'")).collect()}
    assert len(summary) == 6 and summary["Estimated area [ha]"]["Crop"] == pytest.approx(got["right", 2020, 1]["area_ha"])


def test_resample_from_a_utm_zone(spark):
    # a grid of 20 km in zone 36 over cells of a tenth of a degree
    source = {"a": 0.1, "b": 0.0, "c": 30.0, "d": 0.0, "e": -0.1, "f": 2.0}
    pixels = spark.range(60 * 20).select(F.floor(F.col("id") / 60).cast("int").alias("row"), (F.col("id") % 60).cast("int").alias("col"), F.col("id").cast("double").alias("value"))
    target = {"a": 20_000.0, "b": 0.0, "c": 300_000.0, "d": 0.0, "e": -20_000.0, "f": 200_000.0}
    got = r.resample(pixels, source, target, 10, 10, lambda x, y: geo.utm_to_wgs84(x, y, 32636)[::-1])
    rows = {(x["row"], x["col"]): x["value"] for x in got.collect()}
    centres = got.select("row", "col", *[c.alias(n) for c, n in zip(geo.utm_to_wgs84(*geo.pixel_center(F.col("row"), F.col("col"), target), 32636), ("lat", "lon"))]).collect()
    assert len(rows) == 100
    for x in centres:
        i, j = math.floor((2.0 - x["lat"]) / 0.1), math.floor((x["lon"] - 30.0) / 0.1)
        assert rows[x["row"], x["col"]] == (float(i * 60 + j) if 0 <= i < 20 and 0 <= j < 60 else None)


def test_quantile_of_counted_values(spark):
    import numpy as np

    values = [float((k * 37) % 211) ** 1.5 for k in range(1000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        assert m.quantile(df, "v", q).first()["value"] == pytest.approx(float(np.quantile(values, q)))
    assert m.quantile(df.filter("v is null"), "v", 0.5).first()["value"] is None
    assert m.quantile(spark.createDataFrame([(4.0,)], "v double"), "v", 0.9).first()["value"] == 4.0


@pytest.mark.parametrize(("pos", "neg"), [(30, 100), (100, 30), (1, 7), (50, 50), (0, 5), (20, 60)])
def test_upsampling_makes_classes_equal(spark, pos, neg):
    df = spark.range(pos + neg + 40).select("id", (F.col("id") < pos + neg).alias("is_local"), (F.col("id") < pos).cast("int").alias("is_crop"))
    got = p.upsample_local(df)
    counts = {(x["is_local"], x["is_crop"]): x["n"] for x in got.groupBy("is_local", "is_crop").agg(F.count("*").alias("n")).collect()}
    most = max(pos, neg)
    assert counts.get((True, 0), 0) == (most if neg else 0) and counts.get((True, 1), 0) == (most if pos else 0) and counts[False, 0] == 40
    assert got.select("id").distinct().count() == df.count()


@pytest.mark.parametrize("known", [True, False])
def test_area_results_have_no_row_for_a_year_without_estimates(spark, sf, tmp_path, known):
    # with nodata in every pixel no plot is agreed on, and the year has no row, in the query and in its SQL
    spark.read.parquet(f"{sf}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    (lines if known else lines.withColumn("l_tax", F.lit(0.08))).write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    for t in ("nation", "lineitem"):
        duck.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    queries, sql = registry.load()
    got, want = queries["A8_area_results"](spark, str(tmp_path)).toPandas(), duck.execute(sql["A8_area_results"]).df()
    assert len(got) == len(want) == known and list(got.columns) == list(want.columns)
    assert got.fillna(-1).to_numpy().tolist() == want.fillna(-1).to_numpy().tolist()
