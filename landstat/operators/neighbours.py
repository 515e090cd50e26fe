"""The k nearest places, by a k-d tree over unit vectors that follows the density of the places.

A tree grown on a bounded sample cuts the sphere into cells with about as many places each, small where places are dense. A place first
asks its own cell, whose k-th best distance bounds the search; then it asks the other cells whose boxes, known from all places, lie
within that bound. A task grows a finer tree over each of its cells and answers batches of places with the k best so far, pruning by
boxes. Straight distances between unit vectors rise with those along the sphere, so poles and the date line need no care.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.functions.shared import checkpointed

SAMPLE = 50_000  # places on which the tree is grown; every place is in a cell
LEAF = 32  # places of a leaf inside a cell
MOST = 200_000  # places that one copy of a cell answers
SLACK = 4e-15  # of boxes: the last digits of a unit vector differ from one library to another


def unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], 1)


class Tree:
    """A k-d tree in three dimensions; each node has the box of its points."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.nodes: list[tuple[int, float, int, int]] = []  # dimension, value, children; dimension -1: the value is the leaf
        self.leaves: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), leaf)
        empty = np.full(3, np.inf)
        self.fit(np.array([points[r].min(0) if len(r) else empty for r in self.leaves]), np.array([points[r].max(0) if len(r) else -empty for r in self.leaves]))

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        here = len(self.nodes)
        self.nodes.append((-1, len(self.leaves), 0, 0))
        if len(rows) > leaf:
            own = points[rows]
            dim = int((own.max(0) - own.min(0)).argmax())
            x = own[:, dim]
            if x.max() > x.min():
                value = float(np.median(x))
                value = value if value < x.max() else float(x[x < x.max()].max())
                left = self._grow(points, rows[x <= value], leaf)
                right = self._grow(points, rows[x > value], leaf)
                self.nodes[here] = (dim, value, left, right)
                return here
        self.leaves.append(rows)
        return here

    def fit(self, low: np.ndarray, high: np.ndarray) -> None:
        """Boxes of all nodes from those of the leaves."""
        self.low, self.high = np.full((len(self.nodes), 3), np.inf), np.full((len(self.nodes), 3), -np.inf)
        for k in range(len(self.nodes) - 1, -1, -1):
            dim, value, left, right = self.nodes[k]
            if dim < 0:
                self.low[k], self.high[k] = low[int(value)], high[int(value)]
            else:
                self.low[k], self.high[k] = np.minimum(self.low[left], self.low[right]), np.maximum(self.high[left], self.high[right])

    def owner(self, points: np.ndarray) -> np.ndarray:
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            dim, value, left, right = self.nodes[node]
            if dim < 0:
                out[rows] = int(value)
            elif len(rows):
                goes = points[rows, dim] <= value
                waiting += [(left, rows[goes]), (right, rows[~goes])]
        return out

    def within(self, points: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of points whose squared distance to its box is at most ``bound``, as it is when the leaf comes up)."""
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            gap = np.maximum(0, np.maximum(self.low[node] - points[rows], points[rows] - self.high[node]))
            rows = rows[(gap**2).sum(1) <= bound[rows] * (1 + 1e-9)]
            if not len(rows):
                continue
            dim, value, left, right = self.nodes[node]
            if dim < 0:
                yield int(value), rows
            else:  # the child that most of the rows are in comes up first
                near_left = (points[rows, dim] <= value).mean() >= 0.5
                waiting += [(right, rows), (left, rows)] if near_left else [(left, rows), (right, rows)]


def best(tree: Tree, places: np.ndarray, ids: np.ndarray, asked: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to the k nearest ``places`` of each of ``asked``, and their rows (-1 where there are fewer); ties by id."""
    far, which = np.full((len(asked), k), np.inf), np.full((len(asked), k), -1)
    key = np.full((len(asked), k), np.iinfo(np.int64).max)
    bound = bound.copy()
    for leaf, all_rows in tree.within(asked, bound):
        held = tree.leaves[leaf]
        for a in range(0, len(all_rows), 4_096):
            rows = all_rows[a : a + 4_096]
            d = ((asked[rows, None] - places[held]) ** 2).sum(2)
            d2 = np.concatenate([far[rows], d], 1)
            i2 = np.concatenate([which[rows], np.broadcast_to(held, d.shape)], 1)
            k2 = np.concatenate([key[rows], np.broadcast_to(ids[held], d.shape)], 1)
            order = np.lexsort((k2, d2), axis=1)[:, :k]
            far[rows], which[rows], key[rows] = (np.take_along_axis(x, order, 1) for x in (d2, i2, k2))
            bound[rows] = np.minimum(bound[rows], far[rows, -1])
    return far, which


def _answer(k: int):
    """Cells one after the other: the places of a cell (kind 0) come before those that ask (kind 1)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, cell = None, [], None
        for frame in frames:
            keys = frame[["cell", "part", "kind"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(frame)]
            for a, b in zip(cuts, cuts[1:]):
                part = frame.iloc[a:b]
                if not len(part):
                    continue
                if tuple(keys[a, :2]) != at:
                    at, held, cell = tuple(keys[a, :2]), [], None
                if keys[a, 2] == 0:
                    held.append(part[["id", "lat", "lon"]])
                    continue
                if not held:
                    continue
                if cell is None:
                    rows = pd.concat(held)
                    places = unit(rows["lat"].to_numpy(), rows["lon"].to_numpy())
                    cell = (rows, places, rows["id"].to_numpy(np.int64), Tree(places, LEAF))
                rows, places, ids, tree = cell
                far, which = best(tree, places, ids, unit(part["lat"].to_numpy(), part["lon"].to_numpy()), k, part["bound"].to_numpy())
                q, j = np.nonzero(which >= 0)
                found = rows.iloc[which[q, j]]
                yield pd.DataFrame({"lat": part["lat"].to_numpy()[q], "lon": part["lon"].to_numpy()[q], "id_b": ids[which[q, j]], "lat_b": found["lat"].to_numpy(), "lon_b": found["lon"].to_numpy(), "far": far[q, j]})

    return run


def first_of_place(b: DataFrame, k: int) -> DataFrame:
    """Of each place of ``b`` (id, lat, lon) the k smallest ids: no other can be among the k nearest. A place may hold most rows."""
    known = b.select(F.col("id").cast("long").alias("id"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).dropna().distinct()
    part = F.row_number().over(Window.partitionBy("lat", "lon", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id"))
    some = known.withColumn("_r", part).filter(F.col("_r") <= k)
    return some.withColumn("_r", F.row_number().over(Window.partitionBy("lat", "lon").orderBy("id"))).filter(F.col("_r") <= k).drop("_r")


def cells_asked(asking: DataFrame, tree, wide: bool) -> DataFrame:
    """(cell, lat, lon, bound): each place with its own cell or, with ``wide``, with the other cells within its bound."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points, bound = unit(frame["lat"].to_numpy(), frame["lon"].to_numpy()), frame["bound"].to_numpy()
            own = tree.value.owner(points)
            if not wide:
                yield frame.assign(cell=own)[["cell", "lat", "lon", "bound"]]
                continue
            for leaf, rows in tree.value.within(points, bound):
                rows = rows[own[rows] != leaf]
                if len(rows):
                    yield frame.iloc[rows].assign(cell=leaf)[["cell", "lat", "lon", "bound"]]

    return asking.mapInPandas(run, "cell long, lat double, lon double, bound double")


def nearest(a: DataFrame, b: DataFrame, k: int = 1, other: bool = False, sample: int = SAMPLE) -> DataFrame:
    """For each place of ``a`` (id, lat, lon) the ``k`` nearest of ``b``: id_a, id_b, km; ties by the smaller id.

    With ``other``, those of another id only. Ids of ``b`` are whole numbers. Rows without a place have no partner, and there are fewer than k
    where ``b`` has fewer. Equal places of ``a`` ask once, and of equal places of ``b`` only those that can be among the nearest take part.
    A cell holds about 16 / ``sample`` of the places of ``b``, and a task one cell at a time.
    """
    want = k + other
    spark = a.sparkSession
    places = checkpointed(first_of_place(b, want))
    drawn = places.orderBy(F.xxhash64("lat", "lon", "id")).limit(sample).select("lat", "lon").toPandas()
    tree = Tree(unit(drawn["lat"].to_numpy(), drawn["lon"].to_numpy()), max(16, 2 * want))
    assigned = checkpointed(cells_asked(places.select("lat", "lon").distinct().withColumn("bound", F.lit(4.0)), spark.sparkContext.broadcast(tree), False).join(places, ["lat", "lon"]))
    vector = geo.unit_xyz(F.col("lat"), F.col("lon"))
    sides = [f(vector[c]).alias(f"{n}_{c}") for n, f in (("low", F.min), ("high", F.max)) for c in ("x", "y", "z")]
    low, high = np.full((len(tree.leaves), 3), np.inf), np.full((len(tree.leaves), 3), -np.inf)
    for r in assigned.groupBy("cell").agg(*sides).collect():  # one row a cell, at most one for eight places of the sample
        low[r["cell"]], high[r["cell"]] = r[1:4], r[4:7]
    tree.leaves = [None] * len(tree.leaves)
    tree.fit(low - SLACK, high + SLACK)
    shared = spark.sparkContext.broadcast(tree)
    columns = ["cell", "part", "kind", "id", "lat", "lon", "bound"]
    held = assigned.select("cell", F.lit(0).alias("kind"), "id", "lat", "lon", F.lit(0.0).alias("bound"))

    def ask(asked: DataFrame) -> DataFrame:
        # a cell that very many ask is copied, and each copy answers a part of them; one row a cell here
        parts = F.broadcast(asked.groupBy("cell").agg(F.ceil(F.count("*") / MOST).cast("int").alias("parts")))
        copies = held.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        asking = asked.join(parts, "cell").withColumns({"part": F.pmod(F.xxhash64("lat", "lon"), F.col("parts")).cast("int"), "kind": F.lit(1), "id": F.lit(None).cast("long")})
        rows = copies.select(*columns).unionByName(asking.select(*columns)).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
        return rows.mapInPandas(_answer(want), "lat double, lon double, id_b long, lat_b double, lon_b double, far double")

    asking = a.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).dropna().distinct().withColumn("bound", F.lit(4.0))
    first = checkpointed(ask(cells_asked(asking, shared, False)))
    known = first.groupBy("lat", "lon").agg(F.when(F.count("*") >= want, F.max("far")).alias("known"))
    bounded = asking.drop("bound").join(known, ["lat", "lon"], "left").select("lat", "lon", F.coalesce("known", F.lit(4.0)).alias("bound"))
    found = first.unionByName(ask(cells_asked(bounded, shared, True)))
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat_b"), F.col("lon_b"))
    ranked = found.groupBy("lat", "lon").agg(F.slice(F.array_sort(F.collect_list(F.struct(km.alias("km"), "id_b"))), 1, want).alias("near"))
    out = a.select(F.col("id").alias("id_a"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).join(ranked, ["lat", "lon"])
    if other:
        out = out.withColumn("near", F.filter("near", lambda n: n["id_b"] != F.col("id_a")))
    return out.select("id_a", F.explode(F.slice("near", 1, k)).alias("n")).select("id_a", "n.id_b", "n.km")
