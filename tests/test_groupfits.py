"""Many models in one plan against single fits, plain numpy and brute force."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from landstat.operators import groupfits as gf
from landstat.operators import ml

SCHEMA = "id long, dataset string, region string, features array<double>, is_crop int"


def made(spark, groups=3, n=120, p=4, seed=0):
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        beta = rng.normal(size=p)
        x = rng.normal(size=(n, p)) * [1, 5, 0.1, 20][:p] + [0, 3, -1, 50][:p]
        y = (rng.random(n) < 1 / (1 + np.exp(-((x - x.mean(axis=0)) / x.std(axis=0)) @ beta))).astype(int)
        rows += [(g * n + i, f"d{g}", f"r{g}", [float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_model(models):
    return {r["model"]: r for r in models.collect()}


@pytest.mark.parametrize("balanced", [True, False])
def test_logistic_equals_single_fits(spark, balanced):
    df = made(spark).cache()
    got = by_model(gf.logistic(df, "region", ridge=0.02, balanced=balanced))
    assert set(got) == {"r0", "r1", "r2"}
    for r, m in got.items():
        own = df.filter(F.col("region") == r)
        own = ml.with_balance(own) if balanced else own.withColumn("weight", F.lit(1.0))
        one = LogisticRegression(featuresCol="vector", labelCol="is_crop", weightCol="weight", regParam=0.02, tol=1e-12, maxIter=500).fit(ml.vectors(own))
        assert m["converged"] and m["n"] == 120
        np.testing.assert_allclose(m["coefficients"], one.coefficients.toArray(), rtol=1e-4, atol=1e-6)
        assert m["intercept"] == pytest.approx(one.intercept, rel=1e-4, abs=1e-5)


def test_sets_of_groups_and_pieces(spark, monkeypatch):
    df = made(spark).cache()
    sets = {"a": ["d0"], "b": ["d0", "d1"], "all": ["d2", "d0", "d1", "d0"]}
    members = gf.members_of(df, "dataset", sets)
    whole = by_model(gf.logistic(df, "dataset", members))
    for name, datasets in sets.items():
        one = by_model(gf.logistic(df.filter(F.col("dataset").isin(*datasets)).withColumn("dataset", F.lit(name)), "dataset"))[name]
        np.testing.assert_allclose(whole[name]["coefficients"], one["coefficients"], rtol=1e-6, atol=1e-9)
    for name, value in (("PIECE", 7), ("CHUNK", 3), ("HELD", 10), ("MOST_NUMBERS", 0)):  # small pieces, rows and tasks, and no broadcast
        monkeypatch.setattr(gf, name, value)
    for name, m in by_model(gf.logistic(df, "dataset", members)).items():
        np.testing.assert_allclose(whole[name]["coefficients"], m["coefficients"], rtol=1e-6, atol=1e-9)


@pytest.mark.parametrize("chunk", [1_024, 3])
def test_least_squares_equals_numpy(spark, monkeypatch, chunk):
    monkeypatch.setattr(gf, "CHUNK", chunk)
    df = made(spark).cache()
    sums, frame = gf.grams(df, "dataset"), df.toPandas()
    sets = {"one": ["d1"], "two": ["d1", "d2"]}
    alone, joint = by_model(gf.least_squares(sums, "dataset")), by_model(gf.least_squares(sums, "dataset", gf.members_of(df, "dataset", sets)))
    for name, datasets, m in [("d0", ["d0"], alone["d0"])] + [(k, v, joint[k]) for k, v in sets.items()]:
        own = frame[frame["dataset"].isin(datasets)]
        a = np.column_stack([np.ones(len(own)), np.stack(own["features"])])
        want = np.linalg.lstsq(a, own["is_crop"].to_numpy(float), rcond=None)[0]
        assert m["n"] == len(own), name
        np.testing.assert_allclose([m["intercept"], *m["coefficients"]], want, rtol=1e-6, atol=1e-9)


def jobs(spark, run):
    group = f"count-{np.random.default_rng().integers(1 << 40)}"
    spark.sparkContext.setJobGroup(group, "")
    run()
    spark.sparkContext.setJobGroup("rest", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_models(spark):
    few, many = made(spark, groups=2, n=40).cache(), made(spark, groups=24, n=40).cache()
    few.count(), many.count()
    fit = lambda df: gf.logistic(df, "region", steps=3).collect()
    assert jobs(spark, lambda: fit(many)) <= jobs(spark, lambda: fit(few)) + 2  # what adaptive plans may add
    wide = lambda df, k: gf.logistic(df, "dataset", gf.members_of(df, "dataset", {f"m{i}": ["d0", f"d{i}"] for i in range(k)}), steps=3).collect()
    assert jobs(spark, lambda: wide(many, 20)) <= jobs(spark, lambda: wide(many, 2)) + 2


def test_odd_rows(spark):
    df = made(spark, groups=1, n=60)
    odd = spark.createDataFrame(
        [(900, None, None, [1.0, 2.0, 3.0, 4.0], 1), (901, "d0", "r0", None, 1), (902, "d0", "r0", [1.0, 2.0, 3.0, None], 0), (903, "d0", "r0", [1.0, float("nan"), 3.0, 4.0], 1), (904, "d0", "r0", [1.0, float("inf"), 3.0, 4.0], 1), (905, "d0", "r0", [1.0, 2.0, 3.0, 4.0], None)]
        + [(906 + i, "one", "one", [1.0, 2.0, 3.0, float(i)], 1) for i in range(3)] + [(910 + i, "same", "same", [1.0, 2.0, 3.0, 4.0], i % 2) for i in range(6)],
        SCHEMA,
    )
    clean, got = by_model(gf.logistic(df, "region")), by_model(gf.logistic(df.unionByName(odd), "region"))
    np.testing.assert_allclose(got["r0"]["coefficients"], clean["r0"]["coefficients"], rtol=1e-9)
    assert got["r0"]["n"] == 60 and set(got) == {"r0", "one", "same"}
    assert got["one"]["intercept"] == float("inf") and got["one"]["coefficients"] == [0.0] * 4
    assert got["same"]["intercept"] == pytest.approx(0.0, abs=1e-9) and got["same"]["coefficients"] == [0.0] * 4
    scored = gf.score_groups(gf.logistic(df.unionByName(odd), "region"), odd.filter("region = 'one'"), "region")
    assert {r["score"] for r in scored.collect()} == {1.0}
    empty = df.filter("false")
    assert gf.logistic(empty, "region").count() == 0 and gf.least_squares(gf.grams(empty, "region"), "region").count() == 0
    assert ml.region_maps(empty, df).count() == 0


@pytest.mark.parametrize("kind", ["linear", "logistic"])
def test_growth_equals_one_fit_a_candidate(spark, kind):
    train, valid = made(spark, groups=4, seed=1).cache(), made(spark, groups=4, n=50, seed=1).cache()
    got = {(r["round"], r["added"]): r["f1"] for r in ml.plus_one(train, valid, ["d0"], ["d1", "d2", "d3"], kind, rounds=2 if kind == "linear" else 1).collect()}
    first = {c: f for (k, c), f in got.items() if k == 1}
    assert set(first) == {"d1", "d2", "d3"} and len(got) == (5 if kind == "linear" else 3)
    best = max(first, key=lambda c: (first[c], c))
    for (k, c), f1 in got.items():
        own = train.filter(F.col("dataset").isin("d0", c, *([best] if k == 2 else []))).withColumn("dataset", F.lit("x"))
        one = gf.least_squares(gf.grams(own, "dataset"), "dataset", ridge=0.01) if kind == "linear" else gf.logistic(own, "dataset")
        m, v = one.first(), valid.toPandas()
        said = m["intercept"] + np.stack(v["features"]) @ np.array(m["coefficients"]) > (0.5 if kind == "linear" else 0.0)
        y = v["is_crop"].to_numpy() == 1
        assert f1 == pytest.approx(2 * (said & y).sum() / (said.sum() + y.sum()))


def test_grid_draws_rows(spark):
    df = made(spark, groups=2).cache()
    sets = {"one": ["d0"], "a/b": ["d0", "d1"]}
    got = ml.grid(df, df, sets, [0, 1], kind="logistic")
    rows = {(r["training_set"], r["seed"]): r["accuracy"] for r in got.collect()}
    assert set(rows) == {(s, k) for s in sets for k in (0, 1)}
    again = {(r["training_set"], r["seed"]): r["accuracy"] for r in ml.grid(df.repartition(3), df, sets, [0, 1], kind="logistic").collect()}
    assert rows == again
    drawn = df.withColumn("seed", F.lit(5)).select(gf._draws("id").alias("k")).toPandas()["k"]
    assert 0.6 < drawn.mean() < 1.4 and drawn.max() > 1 and (drawn == 0).any()
    with pytest.raises(ValueError):
        gf.logistic(df, "dataset", gf.members_of(df, "dataset", None).withColumn("seed", F.lit(1)))
