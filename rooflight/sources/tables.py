"""Tables in and out: delimited files, tiles by resolution, results by job.

Results are partitioned by job; a job that runs again replaces its own partition and no other, so that
loading is idempotent. Everything is written by the executors, nothing passes the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str = "\t") -> DataFrame:
    r"""Rows of TSV (null is ``\N``) or, with a comma, of CSV files with a header (null is empty)."""
    csv = separator == ","
    return spark.read.schema(schema).csv(path, sep=separator, header=csv, nullValue="" if csv else r"\N", multiLine=csv, escape='"')


def write_csv(rows: DataFrame, path: str, compressed: bool = False) -> None:
    """CSV with a header, gzipped if asked; one file a partition."""
    rows.write.mode("overwrite").csv(path, header=True, escape='"', compression="gzip" if compressed else "none")


def write_tiles(pixels: DataFrame, path: str, size: float) -> None:
    """Pixels (res, x, y, ...) by resolution and tile of ``size`` metres: each tile is one file below its resolution."""
    tiled = pixels.withColumn("tile_x", F.floor(F.col("x") / size)).withColumn("tile_y", F.floor(F.col("y") / size))
    tiled.repartition("res", "tile_x", "tile_y").write.mode("overwrite").partitionBy("res", "tile_x", "tile_y").parquet(path)


def write_job(rows: DataFrame, path: str, job_id: int) -> None:
    """Replace the rows of one job; other jobs' rows stay."""
    rows.withColumn("job_id", F.lit(int(job_id))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").parquet(path)


def read_job(spark: SparkSession, path: str, job_id: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("job_id") == int(job_id))


def count_rows(spark: SparkSession, path: str) -> int:
    """How many rows a Parquet table has, 0 if there is none."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise
