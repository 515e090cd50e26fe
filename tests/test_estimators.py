"""Published worked examples and edge cases of the estimators."""

import pytest

from landstat.operators import confusion as c
from landstat.operators import estimators as e


def tables(spark, matrix, mapped):
    cm = spark.createDataFrame([(i, j, n) for i, row in enumerate(matrix) for j, n in enumerate(row)], "ref_class int, map_class int, n long")
    return cm, spark.createDataFrame(list(enumerate(mapped)), "map_class int, px long")


def test_four_class_change_example(spark):
    cm, px = tables(spark, [[66, 0, 1, 2], [0, 55, 0, 1], [5, 8, 153, 9], [4, 12, 11, 313]], [200000, 150000, 3200000, 6450000])
    rows = {r["class"]: r for r in e.area_estimate(cm, px, 30.0).collect()}
    expect = {
        "u": [0.88, 0.7333, 0.9274, 0.9631], "ci_u": [0.0740, 0.1008, 0.0398, 0.0205], "p": [0.7487, 0.8472, 0.9345, 0.9616], "ci_p": [0.2133, 0.2544, 0.0343, 0.0184],
    }
    for k, values in expect.items():
        assert [rows[i][k] for i in range(4)] == pytest.approx(values, abs=1.5e-4)
    assert [rows[i]["area_ha"] for i in range(4)] == pytest.approx([21158, 11686, 285770, 581386], abs=1.5)
    assert [rows[i]["ci_ha"] for i in range(4)] == pytest.approx([6158, 3756, 15510, 16282], abs=1.5)
    assert rows[0]["acc"] == pytest.approx(0.9465, abs=1.5e-4) and rows[0]["ci_acc"] == pytest.approx(0.0185, abs=1.5e-4)


def test_two_class_example(spark):
    cm, px = tables(spark, [[248, 15], [26, 179]], [556725045, 909501053])
    rows = {r["class"]: r for r in e.area_estimate(cm, px, 10.0).collect()}
    assert [rows[i]["area_ha"] for i in range(2)] == pytest.approx([5742194, 8920067], abs=1.5)
    assert [round(rows[i]["u"], 2) for i in range(2)] == [0.91, 0.92]


def test_required_samples_with_the_reference_quirk(spark):
    f = spark.createDataFrame([(2642505 / 60128016, 57485511 / 60128016, 0.8, 0.7)], "f_crop double, f_noncrop double, u_crop double, u_noncrop double")
    strict = e.required_samples(f, strict_reference=True).first()
    assert (strict["n_crop"] + strict["n_noncrop"]) == strict["n"] and abs(strict["n_crop"] - strict["n_noncrop"]) <= 1
    assert (e.required_samples(f).first()["n"], strict["n"]) == (519, 352)


def test_class_with_one_sample_has_no_variance_and_an_unsampled_one_none_of_its_area(spark):
    cm, px = tables(spark, [[3, 0], [1, 0]], [100, 100])
    rows = {r["class"]: r for r in e.area_estimate(cm, px, 10.0).collect()}
    assert rows[1]["u"] == 0.0 and rows[0]["area_pr"] == pytest.approx(0.375)
    cm, px = tables(spark, [[3, 1], [1, 0]], [100, 100])
    assert {r["class"]: r for r in e.area_estimate(cm, px, 10.0).collect()}[1]["ci_u"] is None


def test_confusion_completes_zeros_and_empty_input(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 0, 0), ("b", 1, 1), ("b", None, 1)], "g string, ref_class int, map_class int")
    got = {(r["g"], r["ref_class"], r["map_class"]): r["n"] for r in c.confusion(df, by=["g"]).collect()}
    assert got[("a", 0, 0)] == 2 and got[("b", 1, 1)] == 1 and sum(got.values()) == 3 and len(got) == 8
    assert c.confusion(df.limit(0), by=["g"]).count() == 0


def test_queries_and_sql_load_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) > 150, set(e.oracle_sql()) <= set(e.queries()))"], cwd=root, capture_output=True, text=True)
    assert done.stdout.split() == ["True", "True"], done.stderr
