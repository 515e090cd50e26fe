"""Table functions that SQL can call."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


class TileGrid:
    """Tiles of a box: one row a tile."""

    def eval(self, x0: float, y0: float, x1: float, y1: float, rows: int, cols: int) -> Iterator[tuple]:
        if None in (x0, y0, x1, y1, rows, cols):
            return
        w, h = (x1 - x0) / cols, (y1 - y0) / rows
        for i in range(rows):
            for j in range(cols):
                yield i, j, x0 + j * w, y0 + i * h, x0 + (j + 1) * w, y0 + (i + 1) * h


def register(spark: SparkSession) -> None:
    """Makes ``tile_grid(x0, y0, x1, y1, rows, cols)`` known to SQL."""
    spark.udtf.register("tile_grid", udtf(TileGrid, returnType="tile_row int, tile_col int, tx0 double, ty0 double, tx1 double, ty1 double"))
