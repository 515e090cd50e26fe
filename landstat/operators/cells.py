"""Joins by cells that may hold very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 200_000  # rows of a side that a task takes from one key
MOST_HOT = 50_000  # keys that are cut; their table is broadcast


def meet(left: DataFrame, right: DataFrame, on: Sequence[str], most: int = CELL_ROWS, most_hot: int = MOST_HOT) -> DataFrame:
    """The inner join of two sides by the columns ``on``, where one key may hold very many rows of either side.

    Rows are counted by key, combined before the shuffle. A key with more than ``most`` rows of a side is cut into pieces by a
    hash of the rows, and each row of the other side goes to all of them; so each pair meets once, and a task takes about ``most``
    rows of a side. ``most`` is raised until at most ``most_hot`` keys are cut. Rows that are equal in all columns share a piece.
    """
    on = list(on)
    each = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    if each.limit(most + 1).count() <= most:
        return left.join(right, on)
    counts = each.dropna(subset=on).groupBy(*on).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr")).filter("_nl > 0 and _nr > 0")
    above = lambda: counts.filter((F.col("_nl") > most) | (F.col("_nr") > most)).limit(most_hot + 1).collect()
    while len(hot := above()) > most_hot:
        most *= 4
    if not hot:
        return left.join(right, on)
    pieces = left.sparkSession.createDataFrame(hot, counts.schema).select(*on, *(F.ceil(F.col(n) / most).cast("long").alias(p) for n, p in (("_nl", "_pl"), ("_nr", "_pr"))))

    def tagged(df: DataFrame, own: str, other: str, piece: str, every: str) -> DataFrame:
        plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
        count = lambda c: F.coalesce(F.col(c), F.lit(1).cast("long"))
        placed = df.join(F.broadcast(pieces), on, "left").withColumn(piece, F.pmod(F.xxhash64(*plain), count(own)))
        return placed.withColumn(every, F.explode(F.sequence(F.lit(0).cast("long"), count(other) - 1))).drop("_pl", "_pr")

    return tagged(left, "_pl", "_pr", "_i", "_j").join(tagged(right, "_pr", "_pl", "_j", "_i"), [*on, "_i", "_j"]).drop("_i", "_j")
