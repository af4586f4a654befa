"""Sequential steps as windows and folds: batches, perimeter checks, one-dimensional clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def adaptive_batches(rows: DataFrame, part: str, order: list, size: str) -> DataFrame:
    """Number batches along an order within each ``part``: rows of one ``size`` in a row fill batches of that size.

    Islands of equal sizes come from a running sum of changes, so that a size that recurs starts anew.
    """
    w = Window.partitionBy(part).orderBy(*order)
    changed = (F.col(size) != F.lag(size, 1).over(w)).cast("int")
    rows = rows.withColumn("island", F.sum(F.coalesce(changed, F.lit(1))).over(w))
    rank = F.row_number().over(Window.partitionBy(part, "island").orderBy(*order))
    return rows.withColumn("batch", F.floor((rank - 1) / F.col(size)).cast("long"))


def perimeter_check(rows: DataFrame, keys: list[str], order: str, least_drop: float, limit: float) -> DataFrame:
    """Compare heights inside and outside along a perimeter (``inside``, ``outside``), in its order.

    bad_ratio is the share of places with a drop under ``least_drop``; the building is outdated over
    ``limit``. max_ground is the largest outside height, each cut to the least inside height so far.
    """
    ordered = F.array_sort(F.collect_list(F.struct(order, "inside", "outside")))
    g = rows.groupBy(*keys).agg(
        ordered.alias("ring"), F.avg((F.col("inside") - F.col("outside") < least_drop).cast("double")).alias("bad_ratio"),
        F.avg("inside").alias("mean_inside"), F.avg("outside").alias("mean_outside"), F.min("outside").alias("min_ground"),
    )
    start = F.struct(F.lit(float("inf")).alias("low"), F.lit(float("-inf")).alias("high"))

    def step(s, p):
        low = F.least(s.low, p.inside)
        return F.struct(low.alias("low"), F.greatest(s.high, F.least(p.outside, low)).alias("high"))

    folded = F.aggregate("ring", start, step).high
    return g.select(*keys, "bad_ratio", (F.col("bad_ratio") > limit).alias("outdated"), (F.col("mean_inside") - F.col("mean_outside")).alias("height"), "min_ground", folded.alias("max_ground"))


def dbscan_1d(rows: DataFrame, part: str, value: str, key: str, eps: float, least: int) -> DataFrame:
    """Density clusters of a number: ``cluster`` counts from 1 in order of value, 0 is noise.

    A row with at least ``least`` rows within eps is a core; cores closer than eps are one cluster; a
    border row joins the core below it if within eps, else the one above. Rows without a value are noise.
    """
    near = f"PARTITION BY {part} ORDER BY {value} RANGE BETWEEN {eps}D PRECEDING AND {eps}D FOLLOWING"
    rows = rows.withColumn("core", F.col(value).isNotNull() & (F.expr(f"count(*) OVER ({near})") >= least))
    up, down = Window.partitionBy(part).orderBy(value, key), Window.partitionBy(part).orderBy(F.desc(value), F.desc(key))
    here = F.when(F.col("core"), F.col(value))
    below = F.last(here, ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("below", below).withColumn("above", F.last(here, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1)))
    first = F.col("core") & (F.col("below").isNull() | (F.col(value) - F.col("below") > eps))
    rows = rows.withColumn("upto", F.sum(first.cast("int")).over(up))
    cluster = F.when(F.col("core") | (F.col(value) - F.col("below") <= eps), F.col("upto")).when(F.col("above") - F.col(value) <= eps, F.col("upto") + 1).otherwise(0)
    return rows.withColumn("cluster", cluster.cast("long"))
