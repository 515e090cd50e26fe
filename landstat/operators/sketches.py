"""Sketches that are stored once a group and united for any range of groups: distinct counts and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14  # of the distinct sketch: a standard error of about 0.8 per cent (1.04 / sqrt(2 ** 14))
K = 400  # of the quantile sketch: ranks are off by under 1 per cent


def sketches(df: DataFrame, by: Sequence[str], distinct: Column | str, value: Column | str) -> DataFrame:
    """(by, n, distinct_sketch, value_sketch): one row a group, to be kept as a table.

    A sketch has a bounded size whatever the group holds; tasks fill their own before the shuffle. Nulls do not count.
    """
    item = F.col(distinct) if isinstance(distinct, str) else distinct
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.hll_sketch_agg(item, F.lit(LG_REGISTERS)).alias("distinct_sketch"), F.kll_sketch_agg_double(number, F.lit(K)).alias("value_sketch"))


def united(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches of many groups as one a coarser group; rows are never read again."""
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch"))


def estimates(stored: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """The number of different items, and the value at each of ``quantiles`` (columns q0, q1, ...), from sketches."""
    at = [F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(q))).alias(f"q{i}") for i, q in enumerate(quantiles)]
    return stored.select(*(c for c in stored.columns if not c.endswith("_sketch")), F.hll_sketch_estimate("distinct_sketch").alias("items"), *at)
