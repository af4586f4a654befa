"""Files, result tables, the job, and edge cases of the cell operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rooflight import job
from rooflight.operators import grids, raster
from rooflight.plans import village
from rooflight.sources import tables

SF = "/root/testdata/sf0.001"


def test_delimited_files(spark, tmp_path):
    rows = [(1, 'a "quoted", b', None), (2, None, 2.5), (3, "line\nbreak", 0.0)]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    tables.write_csv(df, f"{tmp_path}/c", compressed=True)
    assert sorted(map(tuple, tables.read_delimited(spark, f"{tmp_path}/c", "k int, t string, v double", ",").collect())) == rows
    (tmp_path / "t.tsv").write_text("1\tx\t\\N\n2\t\\N\t3.5\n")
    got = sorted(map(tuple, tables.read_delimited(spark, f"{tmp_path}/t.tsv", "k int, t string, v double").collect()))
    assert got == [(1, "x", None), (2, None, 3.5)]


def test_jobs_replace_their_own_rows(spark, tmp_path):
    path = f"{tmp_path}/r"
    assert tables.count_rows(spark, path) == 0
    tables.write_job(spark.range(5), path, 1)
    tables.write_job(spark.range(3), path, 2)
    tables.write_job(spark.range(4), path, 1)
    assert tables.count_rows(spark, path) == 7 and tables.read_job(spark, path, 1).count() == 4 and tables.read_job(spark, path, 2).count() == 3


def test_tiles_by_resolution(spark, tmp_path):
    pixels = spark.range(100).selectExpr("CASE WHEN id % 2 = 0 THEN 1.0D ELSE 0.5D END AS res", "id * 30D AS x", "0D AS y", "id AS v")
    tables.write_tiles(pixels, f"{tmp_path}/t", 1000.0)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 100 and back.where("tile_x <> floor(x / 1000)").isEmpty()
    assert back.select("res", "tile_x").distinct().count() == back.select(F.input_file_name()).distinct().count()


def test_job_from_pixels_to_tables(spark, tmp_path):
    few = "CAST(toid AS INT) <= 6"
    buildings = village._buildings(spark, SF).where(few).withColumn("exclusion_reason", F.when(F.col("toid") == "2", "NO_LIDAR_COVERAGE"))
    pixels = village._pixels(spark, SF).where(few).where("toid <> '3'").selectExpr("*", "transform(sequence(1, 12), m -> m * kwh_year) AS wh", "array(x) AS horizon")
    out = job.model_solar_pv(spark, buildings, pixels, str(tmp_path), job.Parameters(7, edge=0.1))
    again = job.model_solar_pv(spark, buildings, pixels, str(tmp_path), job.Parameters(7, edge=0.1), resume=True)
    assert out == again and out["pv_building"] == 7 and out["planes"] == 10  # houses 0 to 6, two planes each of five
    reasons = {r.toid: r.exclusion_reason for r in tables.read_job(spark, f"{tmp_path}/pv_building", 7).collect()}
    assert reasons["2"] == "NO_LIDAR_COVERAGE" and reasons["3"] == "NO_ROOF_PLANES_DETECTED" and reasons["1"] is None
    roofs = tables.read_job(spark, f"{tmp_path}/pv_roof_plane", 7).collect()
    # a month's energy follows from the day's: pixels give m times the year's value in month m
    for r in roofs:
        ratio = r.kwh_month_max[5] / r.kwh_month_max[0]
        assert abs(ratio - 6 * 30 / 31) < 1e-3 and r.kwh_month_min[0] > 0
    with pytest.raises(ValueError):
        job.Parameters(1, max_slope=91)
    with pytest.raises(ValueError):
        job.Parameters(None)


def test_boxes_meet_once(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 100.0), (2, 16.0, 16.0, 16.0, 16.0), (3, None, 0.0, 1.0, 1.0), (4, -5.0, -5.0, 0.0, 0.0)], "k int, x0 double, y0 double, x1 double, y1 double")
    right = left.toDF("j", "bx0", "by0", "bx1", "by1")
    got = sorted((r.k, r.j) for r in grids.boxes_meet(left.union(left.where("k = 2")), right).collect())
    assert got == [(1, 1), (1, 2), (1, 4), (2, 1), (2, 1), (2, 2), (2, 2), (4, 1), (4, 4)]
    assert grids.boxes_meet(left.where("false"), right).count() == 0


def test_cells_of_awkward_rows(spark):
    pixels = spark.createDataFrame([(0, 0, 1.0), (1, 0, None), (None, 0, 3.0), (1, 1, 4.0), (1, 1, 4.0)], "cx long, cy long, z double")
    points = spark.createDataFrame([(0.5, 0.5), (1.0, 1.0), (None, 0.0), (9.0, 9.0)], "x double, y double")
    got = sorted((str(r.x), r.z) for r in grids.nearest_cell(points, pixels, F.col("x"), F.col("y"), "z").collect())
    assert got == [("0.5", 1.0), ("1.0", 4.0), ("1.0", 4.0), ("9.0", None), ("None", None)]
    none = pixels.where("false")
    assert grids.crop_or_expand(none, grids.extent(none)).count() == 0 and grids.block_maxima(none, 3).count() == 0
    assert raster.stencil(none).count() == 0 and raster.mosaic(none.selectExpr("cx", "cy", "z AS v", "1 AS res")).count() == 0
    with pytest.raises(ValueError):
        grids.grid_cells(points, 5.0, "corner")


def test_labels_refuse_pixels_beyond_their_numbers(spark):
    for bad in ((1 << 20, 0), (-1, 3)):
        with pytest.raises(Exception, match="2\\^20"):
            raster.label_components(spark.createDataFrame([bad, (5, 5)], "cx long, cy long")).collect()
