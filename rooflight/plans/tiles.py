"""Tiles, cells, texts, pages and reports: the reference's remaining relational steps, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from rooflight.functions import angles as a
from rooflight.functions import grid_reference, texts
from rooflight.operators import grids, spatial
from rooflight.plans.common import CLOCK_SQL, GRID_SQL, SITE_SQL, chain, chain_sql, clock, grid, site, table
from rooflight.plans.scalars import _TEMP
from rooflight.plans.surfaces import _BOX_SQL, _boxes

QUERIES, SQL = {}, {}


def _query(sql: str):
    def put(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


_BOUNDS = ["r_regionkey AS area", "5e0 * r_regionkey AS bx0", "3e0 * r_regionkey AS by0", "5e0 * r_regionkey + 20 AS bx1", "3e0 * r_regionkey + 25 AS by1"]


@_query(f"SELECT box_id, area FROM {_BOX_SQL}, (SELECT {', '.join(_BOUNDS)} FROM region) WHERE x0 <= bx1 AND x1 >= bx0 AND y0 <= by1 AND y1 >= by0")
def tiles_in_bounds(spark, sf_dir):
    return grids.boxes_meet(_boxes(spark, sf_dir), table(spark, sf_dir, "region").selectExpr(*_BOUNDS)).select("box_id", "area")


_POINT = ["s_suppkey", "s_suppkey % 41 + 0.3e0 AS x", "s_suppkey % 29 + 0.7e0 AS y"]


@_query(f"SELECT s_suppkey, round(z, 4) AS z FROM (SELECT {', '.join(_POINT)} FROM supplier) LEFT JOIN {GRID_SQL} ON cx = floor(x) AND cy = floor(y)")
def resample_nearest(spark, sf_dir):
    points = table(spark, sf_dir, "supplier").selectExpr(*_POINT)
    return grids.nearest_cell(points, grid(spark, sf_dir), F.col("x"), F.col("y"), "z").select("s_suppkey", F.round("z", 4).alias("z"))


@_query(f"""
    WITH c AS (SELECT floor(cx / 5e0) AS kx, floor(cy / 5e0) AS ky, avg(z) AS climate FROM {GRID_SQL} WHERE p_size <> 7 GROUP BY 1, 2)
    SELECT cx, CAST(cy AS BIGINT) AS cy, round(climate, 6) AS climate FROM {GRID_SQL} LEFT JOIN c ON kx = floor(cx / 5e0) AND ky = floor(cy / 5e0)
""")
def climate_lookup(spark, sf_dir):
    pixels = grid(spark, sf_dir)
    coarse = pixels.where("p_size <> 7").groupBy(F.floor(F.col("cx") / 5).alias("cx"), F.floor(F.col("cy") / 5).alias("cy")).agg(F.avg("z").alias("climate"))
    found = grids.nearest_cell(pixels, coarse, F.col("cx"), F.col("cy"), "climate", 5.0)
    return found.select("cx", "cy", F.round("climate", 6).alias("climate"))


#: The inverse mapping of an output cell's centre, as SQL: a turn by the angle whose cosine is 0.8, and a shift.
_BACK = ["0.8e0 * (cx + 0.5e0) - 0.6e0 * (cy + 0.5e0) + 12.013e0", "0.6e0 * (cx + 0.5e0) + 0.8e0 * (cy + 0.5e0) - 3.017e0"]


@_query(f"""
    SELECT o.cx, CAST(o.cy AS BIGINT) AS cy, round(s.z, 4) AS z FROM (SELECT cx, cy, floor({_BACK[0]}) AS sx, floor({_BACK[1]}) AS sy FROM {GRID_SQL}) o
    LEFT JOIN {GRID_SQL} s ON s.cx = sx AND s.cy = sy
""")
def reproject_nearest(spark, sf_dir):
    pixels = grid(spark, sf_dir)
    return grids.nearest_cell(pixels.select("cx", "cy"), pixels, F.expr(_BACK[0]), F.expr(_BACK[1]), "z").select("cx", "cy", F.round("z", 4).alias("z"))


@_query(f"""
    SELECT cx, CAST(cy AS BIGINT) AS cy, CASE WHEN max(box_id) IS NULL THEN 0 ELSE 1 END AS mask, max(box_id) AS last_box
    FROM {GRID_SQL} LEFT JOIN {_BOX_SQL} ON cx + 0.5e0 BETWEEN x0 AND x1 AND cy + 0.5e0 BETWEEN y0 AND y1 GROUP BY 1, 2
""")
def rasterize_boxes(spark, sf_dir):
    pixels = grid(spark, sf_dir)
    hits = spatial.box_pixel_join(_boxes(spark, sf_dir), pixels.selectExpr("CAST(cx AS DOUBLE) AS px", "CAST(cy AS DOUBLE) AS py", "cx", "cy"))
    hits = hits.where("px + 0.5 BETWEEN x0 AND x1 AND py + 0.5 BETWEEN y0 AND y1").withColumn("last_box", F.col("box_id"))
    return grids.burn(pixels, hits, "box_id", "last_box")


@_query(f"""
    WITH g AS (SELECT cx, CAST(cy AS BIGINT) AS cy, z FROM {GRID_SQL}), e AS (SELECT min(cx) - 2 AS x0, max(cx) + 2 AS x1, min(cy) - 2 AS y0, max(cy) + 2 AS y1 FROM g),
    c AS (SELECT x, unnest(generate_series(y0, y1)) AS y FROM (SELECT *, unnest(generate_series(x0, x1)) AS x FROM e))
    SELECT x AS cx, y AS cy, round(z, 4) AS z FROM c LEFT JOIN g ON cx = x AND cy = y
""")
def expand_raster(spark, sf_dir):
    pixels = grid(spark, sf_dir)
    return grids.crop_or_expand(pixels, grids.extent(pixels, 2)).select("cx", "cy", F.round("z", 4).alias("z"))


@_query(f"""
    SELECT CAST(x AS BIGINT) AS cx, CAST(y AS BIGINT) AS cy, round(z, 4) AS z FROM range(30, 46) t1(x), range(-3, 3) t2(y) LEFT JOIN {GRID_SQL} ON cx = x AND cy = y
""")
def crop_raster(spark, sf_dir):
    reference = table(spark, sf_dir, "region").where("r_regionkey = 0").selectExpr("30L AS x0", "45L AS x1", "-3L AS y0", "2L AS y1")
    return grids.crop_or_expand(grid(spark, sf_dir), reference).select("cx", "cy", F.round("z", 4).alias("z"))


_TILE = ["s_name AS file", "s_suppkey * 0.5e0 AS ulx", "s_nationkey * 1e0 AS uly", "CASE WHEN s_suppkey % 7 = 0 THEN 1.000002e0 ELSE 1e0 END AS xres", "CASE WHEN s_suppkey % 7 = 0 THEN -1.000002e0 WHEN s_suppkey % 11 = 0 THEN -2e0 ELSE -1e0 END AS yres"]


@_query(f"""
    WITH t AS (SELECT {', '.join(_TILE)} FROM supplier), r AS (SELECT ulx AS rx, uly AS ry, xres AS rr FROM t ORDER BY file LIMIT 1)
    SELECT file, CASE WHEN round(abs(xres), 10) = round(abs(yres), 10) THEN round(abs(xres), 10) END AS res, round(abs(xres) * 2) / 2 AS fixed,
           abs((ulx - rx) / rr - round((ulx - rx) / rr)) < 1e-6 AND abs((uly - ry) / rr - round((uly - ry) / rr)) < 1e-6 AS aligned FROM t, r
""")
def raster_metadata(spark, sf_dir):
    return grids.check_tiles(table(spark, sf_dir, "supplier").selectExpr(*_TILE))


@_query(f"""
    WITH m AS (SELECT cx, CAST(cy AS BIGINT) AS cy, nullif(p_size % 6, 0) AS v FROM {GRID_SQL} WHERE p_size > 25),
    b AS (SELECT min(cx) AS x0, max(cx) AS x1, min(cy) AS y0, max(cy) AS y1, count(*) AS n FROM m WHERE v IS NOT NULL)
    SELECT x0, greatest(x1, x0 + 9) AS x1, y0, greatest(y1, y0 + 9) AS y1, n FROM b
""")
def zoom_region(spark, sf_dir):
    """Zeros as nulls, a mask, and the region of what is left, at least 10 x 10 cells."""
    left = grid(spark, sf_dir).where("p_size > 25").where("nullif(p_size % 6, 0) IS NOT NULL")
    return left.agg(F.count("*").alias("n")).crossJoin(F.broadcast(grids.extent(left))).selectExpr("x0", "greatest(x1, x0 + 9) AS x1", "y0", "greatest(y1, y0 + 9) AS y1", "n")


@_query(f"SELECT p_size % 5 AS kind, count(CASE WHEN floor(z) = 12 THEN 1 END) AS n_equal, round(100e0 * count(CASE WHEN floor(z) = 12 THEN 1 END) / count(*), 6) AS percent FROM {GRID_SQL} GROUP BY 1")
def pixels_equal_to(spark, sf_dir):
    hit = F.count(F.when(F.floor("z") == 12, 1))
    return grid(spark, sf_dir).groupBy(F.expr("p_size % 5").alias("kind")).agg(hit.alias("n_equal"), F.round(100.0 * hit / F.count("*"), 6).alias("percent"))


@_query(f"SELECT CAST(floor(cx / 10e0) AS BIGINT) AS bx, CAST(floor(cy / 10e0) AS BIGINT) AS by, round(max(z), 4) AS top FROM {GRID_SQL} GROUP BY 1, 2")
def block_maxima(spark, sf_dir):
    return grids.block_maxima(grid(spark, sf_dir), 10).select("bx", "by", F.round("top", 4).alias("top"))


_AROUND = ["c_custkey", "e - 2600e0 AS x0", "n - 2600e0 AS y0", "e + 2600e0 AS x1", "n + 2600e0 AS y1"]
_REF = grid_reference.reference("cell_e", "cell_n", 5000)


@_query(f"""
    SELECT c_custkey, ref FROM (
      SELECT c_custkey, {_REF.replace('STRING', 'VARCHAR')} AS ref FROM (
        SELECT *, 5000e0 * unnest(generate_series(CAST(floor(y0 / 5000) AS BIGINT), CAST(floor(y1 / 5000) AS BIGINT))) AS cell_n FROM (
          SELECT *, 5000e0 * unnest(generate_series(CAST(floor(x0 / 5000) AS BIGINT), CAST(floor(x1 / 5000) AS BIGINT))) AS cell_e
          FROM (SELECT {', '.join(_AROUND)} FROM {SITE_SQL})))) WHERE ref IS NOT NULL
""")
def grid_refs_around(spark, sf_dir):
    cells = grids.grid_cells(site(spark, sf_dir).selectExpr(*_AROUND), 5000.0)
    return cells.selectExpr("c_custkey", f"{_REF} AS ref").where("ref IS NOT NULL")


@_query(f"""
    SELECT c_custkey, count(*) AS n_areas, min(x) AS west, max(x) AS east FROM (
      SELECT *, unnest(generate_series(0, CAST(floor((y1 - y0) / 2000) AS BIGINT))) AS j FROM (
        SELECT *, x0 + 2000e0 * unnest(generate_series(0, CAST(floor((x1 - x0) / 2000) AS BIGINT))) AS x FROM (SELECT {', '.join(_AROUND)} FROM {SITE_SQL}))) GROUP BY 1
""")
def request_areas(spark, sf_dir):
    """The grid of request areas over each site's bounds, begun at their corner."""
    cells = grids.grid_cells(site(spark, sf_dir).selectExpr(*_AROUND), 2000.0, "bounds")
    return cells.groupBy("c_custkey").agg(F.count("*").alias("n_areas"), F.min("cell_e").alias("west"), F.max("cell_e").alias("east"))


_ROUNDED = ["o_orderkey", f"{texts.round_down_to('o_totalprice', '5000')} AS low", f"{texts.round_up_to('o_totalprice', '5000')} AS high"]


@_query(f"SELECT {', '.join(_ROUNDED)}, CAST(ceil((o_totalprice - 1000e0) / 2500.5e0) AS BIGINT) AS n_steps, round(1000e0 + 2500.5e0 * (ceil((o_totalprice - 1000e0) / 2500.5e0) - 1), 4) AS last_step FROM orders WHERE o_totalprice > 1000")
def rounded_steps(spark, sf_dir):
    """Multiples below and above a price, and how many steps of 2500.5 from 1000 lie below it."""
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 1000")
    steps = "sequence(0, CAST(ceil((o_totalprice - 1000e0) / 2500.5e0) AS INT) - 1)"
    return orders.selectExpr(*_ROUNDED, f"transform({steps}, i -> 1000e0 + 2500.5e0 * i) AS s").selectExpr("o_orderkey", "low", "high", "CAST(size(s) AS BIGINT) AS n_steps", "round(element_at(s, -1), 4) AS last_step")


_WKT = "CASE WHEN box_id % 10 = 0 THEN concat('POINT(', x0, ' ', y0, ')') ELSE concat('POLYGON((', x0, ' ', y0, ', ', x1, ' ', y0, ', ', x1, ' ', y1, ', ', x0, ' ', y0, '))') END"


@_query(f"""
    SELECT box_id, CASE WHEN box_id % 10 = 0 THEN 0 ELSE 4 END AS n_points, CASE WHEN box_id % 10 = 0 THEN NULL ELSE round(2 * x0 + 2 * x1, 6) END AS sum_x,
           CASE WHEN box_id % 10 = 0 THEN NULL ELSE round(3 * y0 + y1, 6) END AS sum_y FROM {_BOX_SQL}
""")
def wkt_points(spark, sf_dir):
    rows = _boxes(spark, sf_dir).selectExpr("box_id", f"{_WKT} AS wkt").selectExpr("box_id", f"{texts.wkt_points('wkt')} AS p")
    total = "CASE WHEN size(p) > 0 THEN round(aggregate(p, 0e0, (s, v) -> s + v[{}]), 6) END"
    return rows.selectExpr("box_id", "size(p) AS n_points", f"{total.format(0)} AS sum_x", f"{total.format(1)} AS sum_y")


_SOURCE = "CASE c_custkey % 7 " + " ".join(f"WHEN {i} THEN '{s[0]}'" for i, s in enumerate(texts.BULK_SOURCES)) + " END"
_PATHS = [("source", _SOURCE), ("ref", grid_reference.reference("e", "n", 10000)), ("res", "CASE WHEN c_custkey % 7 > 3 THEN '50CM' ELSE '1M' END"), ("path", texts.bulk_path("'/bulk'", "source", "ref", "res")), ("tiff", texts.tiff_name("path")), ("key", texts.composite_key("c_custkey", "source", "res")), ("quoted", "replace(concat('\"', c_name, '\"'), '\"', concat(chr(92), '\"'))"), ("uri", texts.with_query("concat('db://h/p', CASE WHEN c_custkey % 2 = 0 THEN '?a=1' ELSE '' END)", "'application_name'", "'solar'"))]
_PATH_COLUMNS = "c_custkey, source, path, tiff, key, quoted, uri"


@_query(f"SELECT {_PATH_COLUMNS} FROM {chain_sql(SITE_SQL, _PATHS)} WHERE ref IS NOT NULL")
def bulk_paths(spark, sf_dir):
    return chain(site(spark, sf_dir), _PATHS).where("ref IS NOT NULL").selectExpr(*_PATH_COLUMNS.split(", "))


@_query("""
    SELECT c_custkey, true AS within_building, concat_ws(':', c_custkey, c_nationkey, c_nationkey) AS pixel_id FROM customer
    WHERE c_acctbal >= 0 AND c_nationkey IN (1, 3, 5, 7, 9) ORDER BY c_custkey LIMIT 20 OFFSET 10
""")
def building_page(spark, sf_dir):
    """One page of the buildings that are not excluded, of given keys, with a tag and a composite key."""
    rows = table(spark, sf_dir, "customer").where("c_acctbal >= 0").where(F.col("c_nationkey").isin(1, 3, 5, 7, 9))
    return rows.orderBy("c_custkey").offset(10).limit(20).selectExpr("c_custkey", "true AS within_building", f"{texts.composite_key('c_custkey', 'c_nationkey', 'c_nationkey')} AS pixel_id")


@_query("SELECT DISTINCT p_brand FROM part WHERE p_size > 45 EXCEPT SELECT p_brand FROM part WHERE p_size < 2")
def rasters_to_transfer(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.where("p_size > 45").select("p_brand").subtract(part.where("p_size < 2").select("p_brand"))


@_query("""
    SELECT s_suppkey, coalesce(n, 0) AS n_panels, round(coalesce(area, 0), 4) AS panel_area, coalesce(n, 0) > 0 AS has_panels, greatest(n_nationkey, 3) AS height
    FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS area FROM lineitem WHERE l_discount > 0.05 GROUP BY 1) ON l_suppkey = s_suppkey
    JOIN nation ON n_nationkey = s_nationkey
""")
def panel_totals(spark, sf_dir):
    """Panels summed per roof, written to all roofs; heights joined by key."""
    panels = table(spark, sf_dir, "lineitem").where("l_discount > 0.05").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("area"))
    heights = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.greatest("n_nationkey", F.lit(3)).alias("height"))
    rows = table(spark, sf_dir, "supplier").join(panels, "s_suppkey", "left").join(heights, "s_nationkey")
    return rows.selectExpr("s_suppkey", "coalesce(n, 0L) AS n_panels", "round(coalesce(area, 0), 4) AS panel_area", "coalesce(n, 0L) > 0 AS has_panels", "height")


_VALIDATED = "l_returnflag AS site, month(l_shipdate) AS m, l_extendedprice / 100e0 AS measured, l_quantity * 15e0 AS modelled"


@_query(f"""
    SELECT site, m, round(avg(measured), 6) AS measured_mean, round(stddev_samp(measured), 6) AS measured_sd, round(avg(modelled), 6) AS modelled_mean,
           round(stddev_samp(modelled), 6) AS modelled_sd, round(avg(measured) - avg(modelled), 6) AS difference FROM (SELECT {_VALIDATED} FROM lineitem) GROUP BY 1, 2
""")
def validation_months(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(*_VALIDATED.split(", "))
    each = [f(F.col(c)).alias(f"{c}_{n}") for c in ("measured", "modelled") for f, n in ((F.avg, "mean"), (F.stddev_samp, "sd"))]
    out = rows.groupBy("site", "m").agg(*each).withColumn("difference", F.col("measured_mean") - F.col("modelled_mean"))
    return out.select("site", "m", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


_MODEL_DAYS = "CASE m " + " ".join(f"WHEN {m} THEN {d}" for m, d in enumerate(a.MONTH_DAYS, 1)) + " END"
_MODEL = f"wh * w * 0.001e0 * ({_MODEL_DAYS}) * 0.2e0 * (1 - {a.SYSTEM_LOSS}e0)"


@_query(f"SELECT roof, m, round(sum({_MODEL}), 5) AS kwh FROM (SELECT l_suppkey AS roof, month(l_shipdate) AS m, l_extendedprice / 1000e0 AS wh, l_quantity / 50e0 AS w FROM lineitem) GROUP BY 1, 2")
def validation_model(spark, sf_dir):
    """Energy summed over cells by their shared area, not divided by it."""
    cells = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS roof", "month(l_shipdate) AS m", "l_extendedprice / 1000e0 AS wh", "l_quantity / 50e0 AS w")
    return cells.groupBy("roof", "m").agg(F.round(F.sum(F.expr(_MODEL)), 5).alias("kwh"))


_SITES = "r_regionkey, 50e0 + r_regionkey + (i - 3) * 0.01e0 AS lat, -2e0 + (j - 3) * 0.01e0 AS lon"
_YIELD = "1000e0 * cos(radians(lat)) * (1 + 0.01e0 * sin(radians(lon * 10)))"


@_query(f"""
    WITH g AS (SELECT {_SITES} FROM region, range(7) t1(i), range(7) t2(j)),
    h AS (SELECT r_regionkey, count(*) AS n_horizons FROM (SELECT r_regionkey, 10e0 * b + (o - 5) * 7e0 + r_regionkey AS h FROM region, range(4) t3(b), range(11) t4(o)) WHERE h >= 0 AND h < 90 GROUP BY 1)
    SELECT r_regionkey, round(stddev_samp({_YIELD}), 6) AS sd, count(*) AS n_sites, any_value(n_horizons) AS n_horizons FROM g JOIN h USING (r_regionkey) GROUP BY 1
""")
def sensitivity_grid(spark, sf_dir):
    """Spread of the yield over 7 x 7 places, and the outlying horizons that stay in range: 4 bases x 11."""
    region = table(spark, sf_dir, "region").select("r_regionkey")
    places = region.selectExpr("*", "explode(sequence(0, 6)) AS i").selectExpr("*", "explode(sequence(0, 6)) AS j").selectExpr(*_SITES.split(", "))
    horizons = region.selectExpr("*", "explode(sequence(0, 3)) AS b").selectExpr("*", "explode(sequence(0, 10)) AS o").selectExpr("r_regionkey", "10e0 * b + (o - 5) * 7e0 + r_regionkey AS h")
    horizons = horizons.where("h >= 0 AND h < 90").groupBy("r_regionkey").agg(F.count("*").alias("n_horizons"))
    spread = places.groupBy("r_regionkey").agg(F.round(F.stddev_samp(F.expr(_YIELD)), 6).alias("sd"), F.count("*").alias("n_sites"))
    return spread.join(horizons, "r_regionkey").select("r_regionkey", "sd", "n_sites", "n_horizons")


def _buckets(half_even: str) -> list[tuple[str, str]]:
    """Buckets of days, 365.25 / n each, whose ends are rounded half to even; days is the end less the start, as the reference counts."""
    return [("upto", f"least(365, {half_even}(1 + (ix + 1) * 365.25e0 / n, 0))"), ("start", f"CASE WHEN ix = 0 THEN 1 ELSE least(365, {half_even}(1 + ix * 365.25e0 / n, 0)) + 1 END"), ("mid", f"CAST({half_even}((start + upto) / 2e0, 0) AS INT)")]


_BUCKET_COLUMNS = ["n", "ix", "mid", "month({}) AS month", "CAST(upto - start AS BIGINT) AS days"]


@_query(f"SELECT {', '.join(_BUCKET_COLUMNS).format('DATE ' + chr(39) + '2010-01-01' + chr(39) + ' + (mid - 1)')} FROM {chain_sql('(SELECT n_nationkey + 1 AS n, unnest(generate_series(0, n_nationkey)) AS ix FROM nation)', _buckets('round_even'))}")
def time_buckets(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").selectExpr("n_nationkey + 1 AS n", "explode(sequence(CAST(0 AS BIGINT), CAST(n_nationkey AS BIGINT))) AS ix")
    return chain(rows, _buckets("bround")).selectExpr(*[c.format("date_add(DATE '2010-01-01', mid - 1)") for c in _BUCKET_COLUMNS])


_ETA = [*_TEMP, ("csi", a.efficiency("value", "temp", a.CSI)), ("cdte", a.efficiency("value", "temp", a.CDTE))]


@_query(f"SELECT event_id, round(csi, 7) AS csi, round(cdte, 7) AS cdte FROM {chain_sql(CLOCK_SQL, _ETA)}")
def module_technologies(spark, sf_dir):
    return chain(clock(spark, sf_dir), _ETA).selectExpr("event_id", "round(csi, 7) AS csi", "round(cdte, 7) AS cdte")
