"""Readers of raster texts and GeoJSON, and the projection, on small fixtures."""

from __future__ import annotations

import json

from rooflight.functions import projection
from rooflight.plans.common import chain
from rooflight.sources import ascii_grid, geojson


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "a.asc").write_text("ncols 3\nnrows 2\nxllcorner 100\nyllcorner 200\ncellsize 2\nNODATA_value -9999\n1 2 -9999\n-4.5\n5e0 6\n")
    (tmp_path / "b.asc").write_text("NCOLS 1\nNROWS 1\nXLLCENTER 7\nYLLCENTER 8\nCELLSIZE 1\n-9999\n")
    (tmp_path / "c.asc").write_text("")
    rows = ascii_grid.read(spark, str(tmp_path)).collect()
    got = {(r.file[-5:], r.row, r.col): (r.x, r.y, r.v) for r in rows}
    want = {0: [1.0, 2.0, None], 1: [-4.5, 5.0, 6.0]}
    assert got == {**{("a.asc", y, x): (101.0 + 2 * x, 203.0 - 2 * y, want[y][x]) for y in want for x in range(3)}, ("b.asc", 0, 0): (7.0, 8.0, -9999.0)}


def test_geojson(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    rows = spark.createDataFrame([(1, "x", ring), (2, None, ring)], "id int, name string, ring array<array<double>>")
    texts = [r.value for r in geojson.features(rows, "ring").collect()]
    (tmp_path / "f.json").write_text('{"type": "FeatureCollection", "features": [' + ",\n".join(texts) + "]}")
    (tmp_path / "none.json").write_text('{"type": "FeatureCollection", "features": []}')
    back = sorted(geojson.read(spark, str(tmp_path)).collect(), key=lambda r: json.loads(r.properties)["id"])
    assert [json.loads(r.properties) for r in back] == [{"id": 1, "name": "x"}, {"id": 2, "name": None}]
    assert all(r.kind == "Polygon" and json.loads(r.geometry)["coordinates"] == [ring] for r in back)


def test_projection_of_a_known_point(spark):
    point = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    r = chain(point, [*projection.inverse_mercator("e", "n"), ("la", "degrees(lat0)"), ("lo", "degrees(lon0)"), *projection.to_wgs84("lat0", "lon0")]).first()
    assert abs(r.la - (52 + 39 / 60 + 27.2531 / 3600)) < 1e-7 and abs(r.lo - (1 + 43 / 60 + 4.5177 / 3600)) < 1e-7
    assert abs(r.lat - 52.65798) < 1e-4 and abs(r.lon - 1.71605) < 1e-4
