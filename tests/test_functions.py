"""Geometry, series and label rules on small inputs."""

import math

import pytest
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.operators import labels as l
from landstat.operators import metrics as m
from landstat.operators import points as p
from landstat.operators import raster as r
from landstat.operators import timeseries as ts


def test_concave_ring_and_shared_edges(spark):
    ring = "cast(array(struct(0d, 0d), struct(4d, 0d), struct(4d, 2d), struct(2d, 2d), struct(2d, 4d), struct(0d, 4d)) as array<struct<x:double,y:double>>)"
    at = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (0.0, 0.0), (4.0, 1.0), (5.0, 5.0)], "x double, y double").withColumn("ring", F.expr(ring))
    assert [v[0] for v in at.select(geo.contains(F.col("ring"), F.col("x"), F.col("y"))).collect()] == [True, False, True, True, False, False]
    assert at.select(geo.ring_area(F.col("ring"))).first()[0] == 12.0


def test_utm_of_known_places(spark):
    one = spark.range(1)
    e, n = one.select(*geo.wgs84_to_utm(F.lit(48.858222), F.lit(2.2945), 32631)).first()
    assert (e, n) == (pytest.approx(448252, abs=2), pytest.approx(5411938, abs=15))
    lat, lon = one.select(*geo.utm_to_wgs84(F.lit(float(e)), F.lit(float(n)), 32631)).first()
    assert (lat, lon) == (pytest.approx(48.858222, abs=1e-7), pytest.approx(2.2945, abs=1e-7))
    with pytest.raises(ValueError):
        geo.wgs84_to_utm(F.lit(0.0), F.lit(0.0), 4326)


def test_distance_join_over_the_date_line_and_near_a_pole(spark):
    a = spark.createDataFrame([(1, 0.0, 179.9), (2, 89.5, 10.0), (3, 20.0, 20.0)], "id long, lat double, lon double")
    b = spark.createDataFrame([(7, 0.0, -179.9), (8, 89.5, -170.0), (9, 21.0, 20.0)], "id long, lat double, lon double")
    got = {(x["id_a"], x["id_b"]): x["km"] for x in p.within_distance(a, b, 120.0).collect()}
    assert set(got) == {(1, 7), (2, 8), (3, 9)} and got[(3, 9)] == pytest.approx(6371 * math.pi / 180)
    assert {(x["id_a"], x["id_b"]) for x in p.nearest(a, b).collect()} == {(1, 7), (2, 8), (3, 9)}


def test_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 0, 0.5), ("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.3)], "g string, y_true int, score double")
    assert {x["g"]: x["auc"] for x in m.roc_auc(df, ["g"]).collect()} == {"a": 0.875, "b": None}


def test_binarize_keeps_nodata_and_nulls(spark):
    df = spark.createDataFrame([(255.0,), (None,), (0.5,), (0.4,)], "v double")
    assert [x[0] for x in df.select(r.binarize(F.col("v"))).collect()] == [None, None, 1, 0]


def test_points_outside_the_raster_have_no_value(spark):
    meta = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -1.0, "f": 2.0}
    px = spark.createDataFrame([(0, 0, 7.0), (1, 1, 9.0)], "row int, col int, value double")
    pts = spark.createDataFrame([(1, 0.5, 1.5), (2, -0.5, 1.5), (3, 1.5, 0.5)], "id int, lon double, lat double")
    assert {x["id"]: x["value"] for x in r.sample_raster(pts, px, meta).collect()} == {1: 7.0, 2: None, 3: 9.0}


def test_online_statistics_example(spark):
    rows = [(i, b, float(v)) for i, vs in enumerate([[1, 2, 3], [2, 3, 4], [3, 4, 5], [4, 5, 6]]) for b, v in enumerate(vs)]
    got = {x["band"]: x for x in ts.band_stats(spark.createDataFrame(rows, "id int, band int, value double")).collect()}
    assert [got[b]["mean"] for b in range(3)] == [2.5, 3.5, 4.5] and all(got[b]["std"] ** 2 * 3 == pytest.approx(5.0) for b in range(3))


def test_probabilities_must_be_numbers_and_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"), "x")], "p double, t string")
    assert l.with_class_prob(df, F.col("p")).first()["class_probability"] is None
    with pytest.raises(ValueError):
        l.with_class_prob(df, F.col("t"))


def test_seasons_moved_by_a_year(spark):
    df = spark.createDataFrame([(1, "2015-06-01", "2015-03-01"), (2, "2015-06-01", "unknown"), (3, "2015-06-01", "2015-09-01"), (4, "2015-06-01", "bad")], "id int, planting string, harvest string")
    assert {x["id"] for x in l.clean_seasons(df, [2015]).collect()} == {1, 3}
    assert {x["id"] for x in l.clean_seasons(df, [2015], strict_reference=True).collect()} == {3}


def test_upsampling_balances_local_classes(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 10 = 0 as int) as is_crop", "id < 200 as is_local")
    out = p.upsample_local(df).filter("is_local").groupBy("is_crop").count().collect()
    n = {x["is_crop"]: x["count"] for x in out}
    assert n[0] == 180 and abs(n[1] - 180) <= 12
