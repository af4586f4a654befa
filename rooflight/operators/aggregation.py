"""Weighted, planar and circular aggregations; each is one shuffle with partial sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.functions import angles


def weighted_mean(pixels: DataFrame, keys: list[str], values: list[str], weight: str) -> DataFrame:
    """Mean of each value weighted by ``weight``, the weights' sum, and the number of pixels; null where all weights are 0."""
    total = F.sum(weight)
    means = [F.try_divide(F.sum(F.col(v) * F.col(weight)), total).alias(v) for v in values]
    return pixels.groupBy(*keys).agg(*means, total.alias("weight"), F.count("*").alias("n_pixels"))


def fit_plane(points: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares z = a x + b y + c of each group, from centred moments; null where x and y are collinear."""
    m = points.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"),
        F.var_pop("x").alias("sxx"), F.var_pop("y").alias("syy"), F.covar_pop("x", "y").alias("sxy"),
        F.covar_pop("x", "z").alias("sxz"), F.covar_pop("y", "z").alias("syz"),
    )
    m = m.withColumn("det", F.expr("nullif(sxx * syy - sxy * sxy, 0)"))
    m = m.withColumn("a", F.expr("(sxz * syy - syz * sxy) / det")).withColumn("b", F.expr("(syz * sxx - sxz * sxy) / det"))
    return m.select(*keys, "n", "a", "b", F.expr("mz - a * mx - b * my").alias("c"))


def plane_metrics(points: DataFrame, planes: DataFrame, keys: list[str]) -> DataFrame:
    """How well planes fit their points: mae, mse, rmse, sd of residuals, r2, msle (null if a height or its estimate is negative), mape."""
    r = points.join(planes, keys).withColumn("r", F.expr("z - (a * x + b * y + c)"))
    square = F.avg(F.col("r") * F.col("r"))
    logs = F.when(F.min(F.least("z", F.col("z") - F.col("r"))) >= 0, F.avg(F.expr("power(ln(1 + greatest(z, 0)) - ln(1 + greatest(z - r, 0)), 2)")))
    share = F.avg(F.abs("r") / F.greatest(F.abs("z"), F.lit(2.0**-52)))
    return r.groupBy(*keys).agg(
        F.avg(F.abs("r")).alias("mae"), square.alias("mse"), F.sqrt(square).alias("rmse"), F.stddev_pop("r").alias("sd"),
        (1 - F.try_divide(square, F.var_pop("z"))).alias("r2"), logs.alias("msle"), share.alias("mape"),
    )


def circular(rows: DataFrame, keys: list[str], angle: str) -> DataFrame:
    """Circular mean, variance and standard deviation of angles in radians."""
    g = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.sin(angle)).alias("s"), F.avg(F.cos(angle)).alias("k"))
    g = g.withColumn("r", F.expr("sqrt(s * s + k * k)")).withColumn("m", F.atan2("s", "k"))
    return g.selectExpr(*keys, "n", f"{angles.wrapped('m', '(2e0 * pi())')} AS circ_mean", "1 - r AS circ_var", "sqrt(-2 * ln(r)) AS circ_sd")


def mean_array(rows: DataFrame, keys: list[str], values: str) -> DataFrame:
    """Element-wise mean of arrays as (keys, slice, mean); partial sums leave a row per slice and task."""
    each = rows.select(*keys, F.posexplode(values).alias("slice", "v"))
    return each.groupBy(*keys, "slice").agg(F.avg(F.col("v").cast("double")).alias("mean"))


def monthly_energy(pixels: DataFrame, peak: float = 0.2) -> DataFrame:
    """Energy of planes from pixels (plane, m, wh of the month's day, w, l_discount): months and minimum, maximum, average years.

    The raw geometry, which gives the minimum, has the pixels of a discount of 5 % and more.
    """
    factor = peak * (1 - angles.SYSTEM_LOSS)
    days = F.element_at(F.array(*[F.lit(float(d)) for d in angles.MONTH_DAYS]), F.col("m"))
    month = pixels.groupBy("plane", "m").agg(
        (F.sum(F.col("wh") * F.col("w")) / F.sum("w")).alias("mean"), F.sum("w").alias("w"), F.sum(F.when(F.col("l_discount") >= 0.05, F.col("w"))).alias("raw")
    )
    month = month.withColumn("kwh", F.col("mean") * days * 0.001 * factor)
    wide = [F.coalesce(F.max(F.when(F.col("m") == k, F.col("kwh"))), F.lit(0.0)).alias(f"month_{k:02}") for k in range(1, 13)]
    year = month.groupBy("plane").agg(F.sum("w").alias("area"), F.coalesce(F.sum("raw"), F.lit(0.0)).alias("raw_area"), F.sum("kwh").alias("kwh"), *wide)
    year = year.withColumn("kwp", F.col("area") * peak).withColumn("kwh_min", F.col("kwh") * F.col("raw_area")).withColumn("kwh_max", F.col("kwh") * F.col("area"))
    year = year.withColumn("kwh_avg", (F.col("kwh_min") + F.col("kwh_max")) / 2)
    return year.withColumn("kwh_per_kwp", F.try_divide("kwh_avg", "kwp"))
