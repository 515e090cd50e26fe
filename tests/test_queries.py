"""Every registered query against its DuckDB SQL on the smallest tables, and independence of partitioning."""

import os

import duckdb
import pytest

from landstat.plans import registry

QUERIES, SQL = registry.load()
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    cols = sorted(frame.columns)
    text = frame[cols].astype(object).where(frame[cols].notna(), None).map(lambda v: repr(float(v)) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v))
    return cols, sorted(map(tuple, text.to_numpy().tolist()))


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in NAMES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


SAMPLED = sorted(SQL) if os.environ.get("ALL_QUERIES") else sorted(SQL)[::4]


@pytest.mark.parametrize("name", SAMPLED)
def test_against_sql(spark, sf, duck, name):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(duck.execute(SQL[name]).df())


@pytest.mark.parametrize("name", ["E8_area_estimate", "E22_consensus", "F1_keep_first", "D20_roc_auc"])
def test_partitioning_changes_nothing(spark, sf, name):
    first = rows(QUERIES[name](spark, sf).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        assert rows(QUERIES[name](spark, sf).toPandas()) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry_and_oracle_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
