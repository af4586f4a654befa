"""Spatial joins of boxes, pixels and bounds, as equi-joins on grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boxes are cut into cells of so many metres; a cell meets few boxes and few pixels.
CELL = 8.0


def overlap(a0: str, a1: str, b0: str, b1: str) -> str:
    """Length that two intervals share."""
    return f"greatest(0e0, least({a1}, {b1}) - greatest({a0}, {b0}))"


def _cells(lo: str, hi: str):
    return F.explode(F.sequence(F.floor(F.col(lo) / CELL), F.floor(F.col(hi) / CELL)))


def box_pixel_join(boxes: DataFrame, pixels: DataFrame) -> DataFrame:
    """Pairs of boxes (x0, y0, x1, y1) and unit pixels (px, py: lower corners) with a shared area ``w``.

    A pixel lies in one cell and a box is exploded into the cells that its pixels can lie in, so that
    no pair is found twice; touching pixels come with w = 0.
    """
    spread = boxes.withColumn("bx0", F.col("x0") - 1).withColumn("by0", F.col("y0") - 1)
    spread = spread.withColumn("cell_x", _cells("bx0", "x1")).withColumn("cell_y", _cells("by0", "y1")).drop("bx0", "by0")
    put = pixels.withColumn("cell_x", F.floor(F.col("px") / CELL)).withColumn("cell_y", F.floor(F.col("py") / CELL))
    pairs = spread.join(put, ["cell_x", "cell_y"]).where("px <= x1 and px + 1 >= x0 and py <= y1 and py + 1 >= y0").drop("cell_x", "cell_y")
    return pairs.withColumn("w", F.expr(f"{overlap('px', 'px + 1', 'x0', 'x1')} * {overlap('py', 'py + 1', 'y0', 'y1')}"))


def inside_bounds(boxes: DataFrame, bounds: DataFrame) -> DataFrame:
    """Boxes that belong to bounds (bx0, by0, bx1, by1; same ``area`` key).

    A box belongs if it and its centre meet the bounds and, the centre being on their edge, it lies
    below their top or right of their left side: neighbouring bounds share no box.
    """
    cx, cy = F.expr("(x0 + x1) / 2"), F.expr("(y0 + y1) / 2")
    joined = boxes.join(bounds, "area").withColumn("mx", cx).withColumn("my", cy)
    meets = F.expr("x0 <= bx1 and x1 >= bx0 and y0 <= by1 and y1 >= by0 and mx between bx0 and bx1 and my between by0 and by1")
    on_edge = F.expr("mx = bx0 or mx = bx1 or my = by0 or my = by1")
    return joined.where(meets & (~on_edge | F.expr("y1 <= by1 or x0 >= bx0"))).drop("mx", "my")


def pixels_of_boxes(boxes: DataFrame, layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """Pixels whose centre lies in a box and that every layer has, one column per layer; boxes without any stay, with nulls.

    layers: name and (px, py, v). Layers are stacked and pivoted, one shuffle however many there are.
    """
    stacked = None
    for name, rows in layers:
        rows = rows.select("px", "py", F.lit(name).alias("layer"), "v")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    wide = stacked.groupBy("px", "py").agg(*[F.max(F.when(F.col("layer") == n, F.col("v"))).alias(n) for n, _ in layers]).dropna()
    hit = box_pixel_join(boxes, wide).where("px + 0.5 between x0 and x1 and py + 0.5 between y0 and y1")
    return boxes.select("box_id").join(hit.select("box_id", "px", "py", *[n for n, _ in layers]), "box_id", "left")
