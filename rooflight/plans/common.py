"""Shared by the registered queries: tables, and chains of computed columns that also read as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chain(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Add computed columns, each of which may use those before."""
    for name, text in steps:
        df = df.selectExpr("*", f"{text} AS {name}")
    return df


def chain_sql(source: str, steps: list[tuple[str, str]]) -> str:
    """The same as nested SQL."""
    for name, text in steps:
        source = f"(SELECT *, {text} AS {name} FROM {source})"
    return source.replace("AS STRING", "AS VARCHAR").replace("regexp_like", "regexp_matches").replace("regexp_replace_all", "regexp_replace")


#: The terrain that raster queries use: parts as pixels of a grid 40 wide.
GRID = ["p_partkey", "p_partkey % 40 AS cx", "CAST(floor(p_partkey / 40e0) AS BIGINT) AS cy", "p_retailprice / 100e0 AS z", "p_size"]
GRID_SQL = f"(SELECT {', '.join(GRID)} FROM part)"
#: Customers as sites with national grid coordinates.
SITE = ["c_custkey", "c_nationkey", "(c_acctbal + 1000e0) * 50e0 AS e", "c_nationkey * 45000e0 AS n", "c_acctbal", "c_name"]
SITE_SQL = f"(SELECT {', '.join(SITE)} FROM customer)"
#: Embeddings as point clouds of ten buildings.
CLOUD = ["vec_id", "label", "CAST(embedding[0] AS DOUBLE) AS x", "CAST(embedding[1] AS DOUBLE) AS y", "CAST(embedding[2] AS DOUBLE) AS z"]
CLOUD_SQL = "(SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"
#: Events as times of the year with a decimal hour.
CLOCK = ["event_id", "user_id", "value", "CAST(dayofyear(ts) AS INT) AS day", "CAST(hour(ts) AS DOUBLE) + minute(ts) / 60e0 AS hr"]
CLOCK_SQL = f"(SELECT {', '.join(CLOCK)} FROM events)"


def grid(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*GRID)


def site(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(*SITE)


def cloud(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").selectExpr(*CLOUD)


def clock(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*CLOCK)
