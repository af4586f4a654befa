"""Rasters as cells: who meets whom, nearest cells, burning boxes, extents, metadata.

All of it is equi-joins on cell numbers. Edge cases: rows with a null coordinate meet nothing, repeated
rows count each, empty tables give no rows (extents of nothing are null, and so give no cells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxes_meet(left: DataFrame, right: DataFrame, cell: float = 16.0) -> DataFrame:
    """Pairs of boxes (x0, y0, x1, y1) and (bx0, by0, bx1, by1) that share a point.

    Both are spread over the cells they cover; a pair is kept in the one cell that holds the lower
    corner of what both share, so that none comes twice.
    """

    def spread(df: DataFrame, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
        for name, lo, hi in (("cell_x", x0, x1), ("cell_y", y0, y1)):
            whole = (F.col(lo) <= F.col(hi)) & F.col(lo).isNotNull()
            df = df.where(whole).withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))))
        return df

    pairs = spread(left, "x0", "y0", "x1", "y1").join(spread(right, "bx0", "by0", "bx1", "by1"), ["cell_x", "cell_y"])
    first = (F.col("cell_x") == F.floor(F.greatest("x0", "bx0") / cell)) & (F.col("cell_y") == F.floor(F.greatest("y0", "by0") / cell))
    return pairs.where(first & F.expr("x0 <= bx1 AND x1 >= bx0 AND y0 <= by1 AND y1 >= by0")).drop("cell_x", "cell_y")


def nearest_cell(points: DataFrame, cells: DataFrame, x: Column, y: Column, value: str, side: float = 1.0) -> DataFrame:
    """``points`` with ``value`` of the cell (cx, cy; lower corners at multiples of ``side``) that holds (x, y), null where there is none.

    Resampling, reprojection (x and y being the inverse mapping of an output cell's centre) and the
    lookup in a coarser raster are this one join.
    """
    sought = points.withColumn("cell_x", F.floor(x / side)).withColumn("cell_y", F.floor(y / side))
    held = cells.select(F.col("cx").alias("cell_x"), F.col("cy").alias("cell_y"), value)
    return sought.join(held, ["cell_x", "cell_y"], "left").drop("cell_x", "cell_y")


def burn(pixels: DataFrame, hits: DataFrame, order: str, value: str) -> DataFrame:
    """``pixels`` (cx, cy) with ``mask`` (1 where any feature hit, else 0) and the ``value`` of the last feature in ``order``."""
    last = hits.groupBy("cx", "cy").agg(F.max_by(value, order).alias(value))
    return pixels.select("cx", "cy").join(last.withColumn("mask", F.lit(1)), ["cx", "cy"], "left").select("cx", "cy", F.coalesce("mask", F.lit(0)).alias("mask"), value)


def extent(pixels: DataFrame, buffer: int = 0) -> DataFrame:
    """One row: the cells' bounding box, grown by ``buffer`` cells."""
    return pixels.agg((F.min("cx") - buffer).alias("x0"), (F.max("cx") + buffer).alias("x1"), (F.min("cy") - buffer).alias("y0"), (F.max("cy") + buffer).alias("y1"))


def crop_or_expand(pixels: DataFrame, extent: DataFrame, value: str = "z") -> DataFrame:
    """The cells of an ``extent`` (x0, x1, y0, y1 inclusive), with the pixels' value or null."""
    grid = extent.where("x0 <= x1 AND y0 <= y1").select(F.explode(F.sequence("x0", "x1")).alias("cx"), "y0", "y1")
    grid = grid.select("cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    return grid.join(pixels.select("cx", "cy", value), ["cx", "cy"], "left")


def grid_cells(boxes: DataFrame, size: float, start: str = "origin") -> DataFrame:
    """Boxes spread over the cells (``cell_e``, ``cell_n``: lower corners) of ``size`` that they meet.

    The grid begins at the origin's multiples or (``bounds``) at each box's own lower corner. As cells are
    taken from the one that holds the lower corner to the one that begins at or before the upper
    corner, a cell that is only touched from its right or top is left out.
    """
    if start not in ("origin", "bounds"):
        raise ValueError(f"unknown start of the grid: {start}")
    for name, lo, hi in (("cell_e", "x0", "x1"), ("cell_n", "y0", "y1")):
        if start == "origin":
            places = F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))
            corner = F.col(name) * size
        else:
            places = F.sequence(F.lit(0).cast("long"), F.floor((F.col(hi) - F.col(lo)) / size))
            corner = F.col(lo) + F.col(name) * size
        boxes = boxes.withColumn(name, F.explode(places)).withColumn(name, corner)
    return boxes


def check_tiles(tiles: DataFrame) -> DataFrame:
    """Resolution and alignment of tiles (file, ulx, uly, xres, yres), against the first one by name.

    res is the resolution to ten places, null where x and y differ; fixed the resolution that the
    file should have (rounded to half metres); aligned tells if the corner lies on the first one's grid.
    """
    first = tiles.agg(F.min_by(F.struct("ulx", "uly", "xres"), "file").alias("r"))
    res = F.when(F.round(F.abs("xres"), 10) == F.round(F.abs("yres"), 10), F.round(F.abs("xres"), 10))
    off = [F.abs((F.col(c) - F.col(f"r.{c}")) / F.col("r.xres") - F.round((F.col(c) - F.col(f"r.{c}")) / F.col("r.xres"))) < 1e-6 for c in ("ulx", "uly")]
    return tiles.join(F.broadcast(first)).select("file", res.alias("res"), (F.round(F.abs(F.col("xres")) * 2) / 2).alias("fixed"), (off[0] & off[1]).alias("aligned"))


def block_maxima(pixels: DataFrame, side: int, value: str = "z") -> DataFrame:
    """Largest value of each block of side x side cells: a block whose maximum stands below a ray cannot shade it."""
    return pixels.groupBy(F.floor(F.col("cx") / side).alias("bx"), F.floor(F.col("cy") / side).alias("by")).agg(F.max(value).alias("top"))
