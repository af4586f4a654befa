"""Rasters, spatial joins, exclusions, batches and the other relational steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from rooflight.functions import angles as a
from rooflight.operators import raster, sequences, spatial
from rooflight.plans.common import GRID_SQL, chain, grid, table

QUERIES, SQL = {}, {}


def _query(sql: str):
    def put(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


_STENCIL_SQL = f"""
    (SELECT cx + ox AS cx, cy + oy AS cy, {', '.join(f"max(CASE WHEN ox = {-dx} AND oy = {-dy} THEN z END) AS {n}" for (dx, dy), n in raster._NAMES.items())}
     FROM {GRID_SQL}, (VALUES (-1), (0), (1)) t1(ox), (VALUES (-1), (0), (1)) t2(oy) GROUP BY 1, 2
     HAVING count(*) = 9)
"""
_DX, _DY = "((c + 2 * f + i) - (a + 2 * d + g)) / 8e0", "((a + 2 * b + c) - (g + 2 * h + i)) / 8e0"
_HORN = [("dzdx", _DX), ("dzdy", _DY), ("slope", a.slope_deg("dzdx", "dzdy")), ("aspect", f"CASE WHEN dzdx = 0 AND dzdy = 0 THEN 0e0 ELSE {a.wrapped('degrees(atan2(-dzdx, -dzdy))')} END")]
_TRI = "(0.7e0 * (abs(a - e) + abs(c - e) + abs(g - e) + abs(i - e)) + abs(b - e) + abs(d - e) + abs(f - e) + abs(h - e)) / 6.8e0"


def _nested(source, steps):
    for n, e in steps:
        source = f"(SELECT *, {e} AS {n} FROM {source})"
    return source


@_query(f"SELECT cx, CAST(cy AS BIGINT) AS cy, round(slope, 5) AS slope, round(aspect, 4) AS aspect, round({_TRI}, 6) AS roughness FROM {_nested(_STENCIL_SQL, _HORN)}")
def slope_aspect_horn(spark, sf_dir):
    return chain(raster.stencil(grid(spark, sf_dir)), _HORN).selectExpr("cx", "cy", "round(slope, 5) AS slope", "round(aspect, 4) AS aspect", f"round({_TRI}, 6) AS roughness")


_PATCH = [
    ("masked", "CASE WHEN p_size > 25 THEN z END"),
    ("inverse", "CASE WHEN p_size > 25 THEN NULL ELSE z END"),
    ("patched", "greatest(z, CASE WHEN p_size % 7 = 0 THEN 15e0 END)"),
    ("slope_used", "coalesce(CASE WHEN p_size % 5 = 0 THEN 10e0 END, CASE WHEN z < 12 THEN 0e0 ELSE z END)"),
    ("corrected", "coalesce(CASE WHEN p_size % 3 = 0 THEN 0.97e0 END, 1e0) * z"),
]


@_query(f"SELECT p_partkey, round(masked, 7) AS masked, round(inverse, 7) AS inverse, round(patched, 7) AS patched, round(slope_used, 7) AS slope_used, round(corrected, 7) AS corrected FROM {_nested(GRID_SQL, _PATCH)}")
def mask_patch_override(spark, sf_dir):
    return chain(grid(spark, sf_dir), _PATCH).selectExpr("p_partkey", *[f"round({c}, 7) AS {c}" for c, _ in _PATCH])


@_query(f"""
    SELECT cx, CAST(cy AS BIGINT) AS cy, v, res FROM (
      SELECT cx, cy, z AS v, 1e0 AS res FROM {GRID_SQL} WHERE p_size > 20 UNION ALL
      SELECT s_suppkey % 40, s_suppkey // 40, s_acctbal, 0.5e0 FROM supplier WHERE s_acctbal > 0)
    QUALIFY row_number() OVER (PARTITION BY cx, cy ORDER BY res) = 1
""")
def mosaic_finest_wins(spark, sf_dir):
    coarse = grid(spark, sf_dir).selectExpr("cx", "cy", "CASE WHEN p_size > 20 THEN z END AS v", "1e0 AS res")
    fine = table(spark, sf_dir, "supplier").selectExpr("s_suppkey % 40 AS cx", "s_suppkey div 40 AS cy", "CASE WHEN s_acctbal > 0 THEN s_acctbal END AS v", "0.5e0 AS res")
    return raster.mosaic(coarse.unionByName(fine))


_COVERAGE = "coalesce(count(CASE WHEN p_size > {0} THEN 1 END) / nullif(count(*), 0), 0)"
_TARGET = "CASE WHEN greatest(c50, c1) < 0.25 AND c2 > greatest(c50, c1) + 0.5 THEN 2e0 WHEN c50 >= c1 THEN 0.5e0 ELSE 1e0 END AS target"


@_query(f"SELECT p_brand, round(c50, 6) AS c50, round(c1, 6) AS c1, round(c2, 6) AS c2, {_TARGET} FROM (SELECT p_brand, {_COVERAGE.format(42)} AS c50, {_COVERAGE.format(38)} AS c1, {_COVERAGE.format(5)} AS c2 FROM part GROUP BY p_brand)")
def coverage_ratio(spark, sf_dir):
    part = table(spark, sf_dir, "part").groupBy("p_brand").agg(*[F.expr(_COVERAGE.format(k)).alias(c) for k, c in ((42, "c50"), (38, "c1"), (5, "c2"))])
    return part.selectExpr("p_brand", "round(c50, 6) AS c50", "round(c1, 6) AS c1", "round(c2, 6) AS c2", _TARGET)


_BOX = "s_suppkey AS box_id, s_suppkey % 37 + abs(s_acctbal) % 1 AS x0, s_suppkey % 43 + abs(s_acctbal) % 3 / 3 AS y0, s_suppkey % 37 + abs(s_acctbal) % 1 + 1 + s_nationkey % 4 AS x1, s_suppkey % 43 + abs(s_acctbal) % 3 / 3 + 2.5e0 AS y1"
_BOX_SQL = f"(SELECT {_BOX} FROM supplier)"


def _boxes(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr(*_BOX.split(", "))


_PIXEL_SQL = f"(SELECT CAST(cx AS DOUBLE) AS px, CAST(cy AS DOUBLE) AS py, z AS v FROM {GRID_SQL})"


def _pixels(spark, sf_dir):
    return grid(spark, sf_dir).selectExpr("CAST(cx AS DOUBLE) AS px", "CAST(cy AS DOUBLE) AS py", "z AS v")


@_query(f"""
    SELECT box_id, round(sum(v * w) / nullif(sum(w), 0), 6) AS mean_v, round(sum(w), 6) AS area, count(*) AS n_pixels
    FROM (SELECT box_id, v, greatest(0, least(px + 1, x1) - greatest(px, x0)) * greatest(0, least(py + 1, y1) - greatest(py, y0)) AS w
          FROM {_BOX_SQL} JOIN {_PIXEL_SQL} ON px <= x1 AND px + 1 >= x0 AND py <= y1 AND py + 1 >= y0) GROUP BY box_id
""")
def rect_overlap_weights(spark, sf_dir):
    pairs = spatial.box_pixel_join(_boxes(spark, sf_dir), _pixels(spark, sf_dir))
    return pairs.groupBy("box_id").agg(F.expr("round(sum(v * w) / nullif(sum(w), 0), 6)").alias("mean_v"), F.expr("round(sum(w), 6)").alias("area"), F.count("*").alias("n_pixels"))


@_query(f"""
    SELECT b.box_id, p.px, p.py, round(p.v, 4) AS elevation, round(p.v * 2, 4) AS slope FROM {_BOX_SQL} b
    LEFT JOIN (SELECT px, py, v FROM {_PIXEL_SQL} WHERE CAST(px + py AS BIGINT) % 3 <> 0) p
    ON p.px + 0.5 BETWEEN x0 AND x1 AND p.py + 0.5 BETWEEN y0 AND y1
""")
def pixels_for_buildings(spark, sf_dir):
    pixels = _pixels(spark, sf_dir)
    second = pixels.where("CAST(px + py AS BIGINT) % 3 <> 0").withColumn("v", F.col("v") * 2)
    return spatial.pixels_of_boxes(_boxes(spark, sf_dir), [("elevation", pixels), ("slope", second)]).selectExpr("box_id", "px", "py", "round(elevation, 4) AS elevation", "round(slope, 4) AS slope")


@_query(f"""
    SELECT box_id, area FROM (SELECT *, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my FROM (SELECT *, box_id % 5 AS area FROM {_BOX_SQL}) b
      JOIN (SELECT r_regionkey AS area, 5e0 * r_regionkey AS bx0, 3e0 * r_regionkey AS by0, 5e0 * r_regionkey + 20 AS bx1, 3e0 * r_regionkey + 25 AS by1 FROM region) USING (area))
    WHERE x0 <= bx1 AND x1 >= bx0 AND y0 <= by1 AND y1 >= by0 AND mx BETWEEN bx0 AND bx1 AND my BETWEEN by0 AND by1
      AND (NOT (mx = bx0 OR mx = bx1 OR my = by0 OR my = by1) OR y1 <= by1 OR x0 >= bx0)
""")
def buildings_in_bounds(spark, sf_dir):
    bounds = table(spark, sf_dir, "region").selectExpr("CAST(r_regionkey AS BIGINT) AS area", "5e0 * r_regionkey AS bx0", "3e0 * r_regionkey AS by0", "5e0 * r_regionkey + 20 AS bx1", "3e0 * r_regionkey + 25 AS by1")
    return spatial.inside_bounds(_boxes(spark, sf_dir).withColumn("area", F.col("box_id") % 5), bounds).select("box_id", "area")


@_query("""
    SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 'OUTDATED_LIDAR_COVERAGE'
      WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'NO_ROOF_PLANES_DETECTED'
      WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') THEN 'ALL_ROOF_PLANES_UNUSABLE' END AS exclusion_reason
    FROM customer
""")
def exclusion_update(spark, sf_dir):
    planes = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.col("o_orderstatus") == "F").alias("usable"))
    both = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").join(planes, "c_custkey", "left")
    reason = F.when(F.col("c_acctbal") < -500, "OUTDATED_LIDAR_COVERAGE").when(F.col("usable").isNull(), "NO_ROOF_PLANES_DETECTED").when(~F.col("usable"), "ALL_ROOF_PLANES_UNUSABLE")
    return both.select("c_custkey", reason.alias("exclusion_reason"))


@_query("""
    SELECT path FROM (SELECT concat('/tiles/', p_brand, '/', p_partkey, '.tif') AS path, concat(p_partkey, '.tif') AS f FROM part)
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE concat(s_suppkey * 3, '.tif') = f)
""")
def new_tiles(spark, sf_dir):
    paths = table(spark, sf_dir, "part").selectExpr("concat('/tiles/', p_brand, '/', p_partkey, '.tif') AS path")
    loaded = table(spark, sf_dir, "supplier").selectExpr("concat(s_suppkey * 3, '.tif') AS filename")
    return paths.join(loaded, F.substring_index("path", "/", -1) == F.col("filename"), "left_anti")


_SIZE = "CASE WHEN o_totalprice > 300000 THEN 1 WHEN o_totalprice > 100000 THEN 5 ELSE 50 END"


@_query(f"""
    SELECT o_orderkey, size, island, CAST(floor((row_number() OVER (PARTITION BY day, island ORDER BY o_totalprice DESC, o_orderkey) - 1) / size) AS BIGINT) AS batch
    FROM (SELECT *, CAST(sum(c) OVER w AS BIGINT) AS island FROM (
      SELECT *, coalesce(CAST(size <> lag(size) OVER w AS INT), 1) AS c FROM (SELECT *, {_SIZE} AS size, CAST(o_orderdate AS DATE) AS day FROM orders)
      WINDOW w AS (PARTITION BY day ORDER BY o_totalprice DESC, o_orderkey))
      WINDOW w AS (PARTITION BY day ORDER BY o_totalprice DESC, o_orderkey))
""")
def adaptive_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.expr(_SIZE).alias("size"))
    return sequences.adaptive_batches(rows, "day", [F.desc("o_totalprice"), F.col("o_orderkey")], "size").select("o_orderkey", "size", "island", "batch")


_RING = "l_orderkey AS building, l_linenumber AS i, l_extendedprice / 10000e0 AS inside, l_quantity / 10e0 AS outside"


@_query(f"""
    WITH r AS (SELECT *, min(inside) OVER (PARTITION BY building ORDER BY i, inside, outside ROWS UNBOUNDED PRECEDING) AS low FROM (SELECT {_RING} FROM lineitem))
    SELECT building, round(avg(CAST(inside - outside < 0.5 AS DOUBLE)), 6) AS bad_ratio, avg(CAST(inside - outside < 0.5 AS DOUBLE)) > 0.52 AS outdated,
           round(avg(inside) - avg(outside), 9) AS height, min(outside) AS min_ground, max(least(outside, low)) AS max_ground
    FROM r GROUP BY building
""")
def perimeter_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(*_RING.split(", "))
    out = sequences.perimeter_check(rows, ["building"], "i", 0.5, 0.52)
    return out.selectExpr("building", "round(bad_ratio, 6) AS bad_ratio", "outdated", "round(height, 9) AS height", "min_ground", "max_ground")


_USABLE = "CASE WHEN abs(x) * 60 > 80 THEN 'SLOPE' WHEN asp < 45 OR asp > 315 THEN 'ASPECT' WHEN abs(z) * 40 < 8 THEN 'AREA' ELSE 'USABLE' END"


@_query(f"SELECT vec_id, {_USABLE} AS verdict FROM (SELECT vec_id, embedding[1] AS x, embedding[3] AS z, {a.aspect_deg('CAST(embedding[1] AS DOUBLE)', 'CAST(embedding[2] AS DOUBLE)')} AS asp FROM embeddings)")
def usability_case(spark, sf_dir):
    asp = a.aspect_deg("CAST(embedding[0] AS DOUBLE)", "CAST(embedding[1] AS DOUBLE)")
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", "embedding[0] AS x", "embedding[2] AS z", f"{asp} AS asp").selectExpr("vec_id", f"{_USABLE} AS verdict")


@_query("""
    WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal, count(*) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal RANGE BETWEEN 900 PRECEDING AND 900 FOLLOWING) >= 3 AS core FROM supplier),
    b AS (SELECT *, (SELECT max(c.s_acctbal) FROM s c WHERE c.core AND c.s_nationkey = s.s_nationkey AND (c.s_acctbal, c.s_suppkey) < (s.s_acctbal, s.s_suppkey)) AS below,
                    (SELECT min(c.s_acctbal) FROM s c WHERE c.core AND c.s_nationkey = s.s_nationkey AND (c.s_acctbal, c.s_suppkey) > (s.s_acctbal, s.s_suppkey)) AS above FROM s),
    u AS (SELECT *, sum(CASE WHEN core AND (below IS NULL OR s_acctbal - below > 900) THEN 1 ELSE 0 END) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS upto FROM b)
    SELECT s_suppkey, core, CAST(CASE WHEN core OR s_acctbal - below <= 900 THEN upto WHEN above - s_acctbal <= 900 THEN upto + 1 ELSE 0 END AS BIGINT) AS cluster FROM u
""")
def dbscan_1d(spark, sf_dir):
    return sequences.dbscan_1d(table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "s_suppkey", 900.0, 3).select("s_suppkey", "core", "cluster")


_DIRS = "(VALUES (0, 1, 0), (1, 1, 1), (2, 0, 1), (3, -1, 1), (4, -1, 0), (5, -1, -1), (6, 0, -1), (7, 1, -1)) d(dir, dx, dy)"


@_query(f"""
    SELECT g.cx, CAST(g.cy AS BIGINT) AS cy, dir, round(atan(greatest(0, max((t.z - g.z - l * l / 12742000e0) / l))), 6) AS height
    FROM (SELECT cx, cy, z, dir, cx + k * dx AS tx, cy + k * dy AS ty, k * sqrt(dx * dx + dy * dy) AS l FROM {GRID_SQL}, {_DIRS}, generate_series(1, 12) s(k)) g
    JOIN {GRID_SQL} t ON t.cx = tx AND t.cy = ty GROUP BY g.cx, g.cy, dir
""")
def horizon_scan(spark, sf_dir):
    return raster.horizon(grid(spark, sf_dir), 12).select("cx", "cy", "dir", F.round("height", 6).alias("height"))


_LEGS = "sqrt(power(x1 - x0, 2) + power(y1 - y0, 2))"


@_query(f"""
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, round(length, 6) AS length, round(azimuth, 4) AS azimuth, round(mx, 6) AS mx, round(my, 6) AS my FROM (
      SELECT *, {_LEGS} AS length, CASE WHEN degrees(atan2(x1 - x0, y1 - y0)) <= 0 THEN degrees(atan2(x1 - x0, y1 - y0)) + 180 ELSE degrees(atan2(x1 - x0, y1 - y0)) END AS azimuth, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my
      FROM (SELECT vec_id, i, CAST(embedding[2 * i - 1] AS DOUBLE) AS x0, CAST(embedding[2 * i] AS DOUBLE) AS y0,
                   CAST(embedding[2 * i + 1] AS DOUBLE) AS x1, CAST(embedding[2 * i + 2] AS DOUBLE) AS y1 FROM (SELECT *, unnest(generate_series(1, len(embedding) // 2 - 1)) AS i FROM embeddings)))
    WHERE length > 0.01
""")
def segments(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").where("size(embedding) >= 4").selectExpr("vec_id", "explode(sequence(0, CAST(size(embedding) div 2 - 2 AS INT))) AS i", "embedding AS v")
    rows = rows.selectExpr("vec_id", "i", *[f"CAST(v[2 * i + {k}] AS DOUBLE) AS {c}" for k, c in enumerate(("x0", "y0", "x1", "y1"))])
    rows = chain(rows, [("length", _LEGS), ("turn", "degrees(atan2(x1 - x0, y1 - y0))")]).where("length > 0.01")
    return rows.selectExpr("vec_id", "i", "round(length, 6) AS length", "round(CASE WHEN turn <= 0 THEN turn + 180 ELSE turn END, 4) AS azimuth", "round((x0 + x1) / 2, 6) AS mx", "round((y0 + y1) / 2, 6) AS my")


@_query("""
    SELECT user_id, event_type, k, n FROM (
      SELECT user_id, event_type, json_extract_string(props, '$.k') AS k, count(*) OVER (PARTITION BY user_id, event_type) AS n,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def json_latest(spark, sf_dir):
    latest = F.max_by(F.get_json_object("props", "$.k"), F.struct("ts", "event_id"))
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(latest.alias("k"), F.count("*").alias("n"))


_PANEL = "(SELECT s_suppkey AS roof, 3e0 + abs(s_acctbal) % 9 AS w, 2e0 + abs(s_acctbal) % 7 AS h, radians(s_nationkey % 3 * 15e0) AS s FROM supplier)"
_OFFSETS = [(0, 0), (0.5, 0), (0, 0.5), (0.5, 0.5), (0.33, 0), (0, 0.33), (0.33, 0.33), (0.66, 0), (0, 0.66), (0.66, 0.66)]
_ROOMS = "greatest(0, floor((w - ox * pw) / pw)) * greatest(0, floor((h - oy * ph) / ph))"


@_query(f"""
    SELECT roof, layout, offset_ix, CAST(panels AS BIGINT) AS panels, round(panels * 0.99e0 * 1.64e0 * cos(s), 6) AS area FROM (
      SELECT *, row_number() OVER (PARTITION BY roof ORDER BY panels DESC, layout, offset_ix) AS r FROM (
        SELECT *, {_ROOMS} AS panels FROM (
          SELECT *, CASE layout WHEN 0 THEN 0.99e0 ELSE 1.64e0 END AS pw, CASE layout WHEN 0 THEN 1.64e0 ELSE 0.99e0 END * cos(s) AS ph
          FROM {_PANEL}, (VALUES (0), (1)) l(layout), (VALUES {', '.join(f'({k}, {x}e0, {y}e0)' for k, (x, y) in enumerate(_OFFSETS))}) o(offset_ix, ox, oy)))) WHERE r = 1
""")
def panel_grid_best(spark, sf_dir):
    roofs = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS roof", "3e0 + abs(s_acctbal) % 9 AS w", "2e0 + abs(s_acctbal) % 7 AS h", "radians(s_nationkey % 3 * 15e0) AS s")
    offsets = F.array(*[F.struct(F.lit(k).alias("offset_ix"), F.lit(float(x)).alias("ox"), F.lit(float(y)).alias("oy")) for k, (x, y) in enumerate(_OFFSETS)])
    tries = roofs.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("layout")).select("*", F.inline(offsets))
    tries = chain(tries, [("pw", "CASE layout WHEN 0 THEN 0.99e0 ELSE 1.64e0 END"), ("ph", "CASE layout WHEN 0 THEN 1.64e0 ELSE 0.99e0 END * cos(s)"), ("panels", f"CAST({_ROOMS} AS BIGINT)")])
    best = tries.groupBy("roof", "s").agg(F.max(F.struct("panels", (-F.col("layout")).alias("l"), (-F.col("offset_ix")).alias("o"))).alias("b"))
    return best.selectExpr("roof", "-b.l AS layout", "-b.o AS offset_ix", "b.panels AS panels", "round(b.panels * 0.99e0 * 1.64e0 * cos(s), 6) AS area")
