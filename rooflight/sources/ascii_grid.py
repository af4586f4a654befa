"""Text rasters (ESRI ASCII grids): one file a tile, read with built-in functions only.

A file is one row until its lines are exploded, so that memory is bounded by a tile's size; tiles are
read in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEYS = ("ncols", "nrows", "xllcorner", "yllcorner", "xllcenter", "yllcenter", "cellsize", "nodata_value")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Pixels of all grids below ``path``: file, row (from the north, 0), col, x, y (centres), v (null where there is no data).

    A header gives the outer corner or the centre of the south-western cell. Rows may be broken over
    several lines: values are numbered by their order. Empty files and headers without data give no pixels.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content"))
    number = {k: F.regexp_extract("content", rf"(?i)(?:^|\s){k}\s+(\S+)", 1) for k in _KEYS}
    heads = whole.select("file", *[F.when(n != "", n).cast("double").alias(k) for k, n in number.items()], F.regexp_replace("content", r"(?i)(?:^|\s)[a-z_]+\s+[-+.\w]+(?=\s)", " ").alias("body"))
    side = F.col("cellsize")
    tiles = heads.select(
        "file", F.col("ncols").cast("int").alias("n"), "nrows", side, "nodata_value",
        F.coalesce("xllcenter", F.col("xllcorner") + side / 2).alias("west"), F.coalesce("yllcenter", F.col("yllcorner") + side / 2).alias("south"),
        F.filter(F.split("body", r"\s+"), lambda v: v != "").alias("values"),
    )
    pixels = tiles.select(*[c for c in tiles.columns if c != "values"], F.posexplode("values").alias("i", "text")).withColumn("v", F.col("text").cast("double"))
    row, col = F.floor(F.col("i") / F.col("n")), F.col("i") % F.col("n")
    return pixels.select(
        "file", row.cast("int").alias("row"), col.cast("int").alias("col"),
        (F.col("west") + col * side).alias("x"), (F.col("south") + (F.col("nrows") - 1 - row) * side).alias("y"),
        F.when(F.col("nodata_value").isNull() | (F.col("v") != F.col("nodata_value")), F.col("v")).alias("v"),
    )
