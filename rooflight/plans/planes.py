"""Aggregations: areal means, plane fits, circular statistics, roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from rooflight.functions import angles as a
from rooflight.operators import aggregation
from rooflight.plans.common import CLOCK_SQL, CLOUD_SQL, cloud, clock, table

_MONTHS = range(1, 13)


def areal_weighted_mean(spark, sf_dir):
    pixels = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("building"), F.col("l_extendedprice").alias("v"), F.col("l_quantity").alias("w"))
    return aggregation.weighted_mean(pixels, ["building"], ["v"], "w").select("building", F.round("v", 4).alias("mean_value"), F.round("weight", 4).alias("total_weight"), "n_pixels")


def plane_fit(spark, sf_dir):
    fit = aggregation.fit_plane(cloud(spark, sf_dir), ["label"])
    return fit.selectExpr("label", "n", *[f"round({c}, 6) AS {c}" for c in ("a", "b", "c")], f"round({a.slope_deg('a', 'b')}, 6) AS slope", f"round({a.aspect_deg('a', 'b')}, 5) AS aspect")


_FIT_SQL = f"""
    (SELECT *, mz - a * mx - b * my AS c FROM (
      SELECT *, (sxz * syy - syz * sxy) / det AS a, (syz * sxx - sxz * sxy) / det AS b FROM (
        SELECT *, nullif(sxx * syy - sxy * sxy, 0) AS det FROM (
          SELECT label, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS sxx, var_pop(y) AS syy,
                 covar_pop(x, y) AS sxy, covar_pop(x, z) AS sxz, covar_pop(y, z) AS syz
          FROM {CLOUD_SQL} GROUP BY label))))
"""

_LIFTED_SQL = f"(SELECT vec_id, label, x, y, z + 2e0 * (1 - label % 2) AS z FROM {CLOUD_SQL})"


def plane_metrics(spark, sf_dir):
    # even labels are lifted, so that they have a logarithmic error
    points = cloud(spark, sf_dir).withColumn("z", F.expr("z + 2e0 * (1 - label % 2)"))
    return aggregation.plane_metrics(points, aggregation.fit_plane(points, ["label"]), ["label"]).selectExpr("label", *[f"round({c}, 6) AS {c}" for c in ("mae", "mse", "rmse", "sd", "r2", "msle", "mape")])


def circular_stats(spark, sf_dir):
    return aggregation.circular(clock(spark, sf_dir).selectExpr("user_id", "radians(hr * 15e0) AS t"), ["user_id"], "t").selectExpr(
        "user_id", "n", *[f"round({c}, 5) AS {c}" for c in ("circ_mean", "circ_var", "circ_sd")]
    )


def roof_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS plane", "month(l_shipdate) AS m", "l_extendedprice / 1000e0 AS wh", "l_quantity AS w", "l_discount")
    return aggregation.monthly_energy(rows).selectExpr("plane", *[f"round({c}, 4) AS {c}" for c in ("area", "kwp", "kwh_min", "kwh_max", "kwh_avg", "kwh_per_kwp")], *[f"round(month_{m:02}, 4) AS month_{m:02}" for m in _MONTHS])


def _rollup_sql() -> str:
    days = "[" + ", ".join(map(str, a.MONTH_DAYS)) + "]"
    months = ", ".join(f"round(coalesce(max(CASE WHEN m = {m} THEN kwh END), 0), 4) AS month_{m:02}" for m in _MONTHS)
    return f"""
        WITH p AS (SELECT l_suppkey AS plane, month(l_shipdate) AS m, l_extendedprice / 1000e0 AS wh, l_quantity AS w, l_discount FROM lineitem),
        q AS (SELECT plane, m, sum(wh * w) / sum(w) * {days}[m] * 0.001e0 * 0.2e0 * (1 - {a.SYSTEM_LOSS}e0) AS kwh,
                     sum(w) AS w, sum(CASE WHEN l_discount >= 0.05 THEN w END) AS raw FROM p GROUP BY plane, m),
        t AS (SELECT plane, sum(w) AS area, coalesce(sum(raw), 0) AS raw_area, sum(kwh) AS kwh, {months} FROM q GROUP BY plane)
        SELECT plane, round(area, 4) AS area, round(area * 0.2e0, 4) AS kwp, round(kwh * raw_area, 4) AS kwh_min, round(kwh * area, 4) AS kwh_max,
               round((kwh * raw_area + kwh * area) / 2, 4) AS kwh_avg, round((kwh * raw_area + kwh * area) / 2 / (area * 0.2e0), 4) AS kwh_per_kwp,
               {', '.join(f'month_{m:02}' for m in _MONTHS)} FROM t
    """


def horizon_mean_array(spark, sf_dir):
    return aggregation.mean_array(table(spark, sf_dir, "embeddings"), ["label"], "embedding").select("label", "slice", F.round("mean", 6).alias("mean"))


QUERIES = {f.__name__: f for f in (areal_weighted_mean, plane_fit, plane_metrics, circular_stats, roof_rollup, horizon_mean_array)}
SQL = {
    "areal_weighted_mean": """
        SELECT l_suppkey AS building, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) AS mean_value,
               round(sum(l_quantity), 4) AS total_weight, count(*) AS n_pixels FROM lineitem GROUP BY 1
    """,
    "plane_fit": f"SELECT label, n, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c, round({a.slope_deg('a', 'b')}, 6) AS slope, round({a.aspect_deg('a', 'b')}, 5) AS aspect FROM {_FIT_SQL}",
    "plane_metrics": f"""
        SELECT label, round(avg(abs(r)), 6) AS mae, round(avg(r * r), 6) AS mse, round(sqrt(avg(r * r)), 6) AS rmse,
               round(stddev_pop(r), 6) AS sd, round(1 - avg(r * r) / nullif(var_pop(z), 0), 6) AS r2,
               round(CASE WHEN min(least(z, z - r)) >= 0 THEN avg(power(ln(1 + greatest(z, 0)) - ln(1 + greatest(z - r, 0)), 2)) END, 6) AS msle,
               round(avg(abs(r) / greatest(abs(z), power(2e0, -52))), 6) AS mape
        FROM (SELECT p.label, p.z, p.z - (f.a * p.x + f.b * p.y + f.c) AS r FROM {_LIFTED_SQL} p JOIN {_FIT_SQL.replace(CLOUD_SQL, _LIFTED_SQL)} f USING (label)) GROUP BY label
    """,
    "circular_stats": f"""
        SELECT user_id, n, round({a.wrapped('m', '(2e0 * pi())')}, 5) AS circ_mean, round(1 - r, 5) AS circ_var, round(sqrt(-2 * ln(r)), 5) AS circ_sd
        FROM (SELECT user_id, count(*) AS n, atan2(avg(sin(t)), avg(cos(t))) AS m, sqrt(avg(sin(t)) ** 2 + avg(cos(t)) ** 2) AS r
              FROM (SELECT user_id, radians(hr * 15e0) AS t FROM {CLOCK_SQL}) GROUP BY user_id)
    """,
    "roof_rollup": _rollup_sql(),
    "horizon_mean_array": "SELECT label, CAST(i - 1 AS INTEGER) AS slice, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean FROM embeddings, generate_series(1, 64) g(i) GROUP BY ALL",
}
