"""Every registered solar query against its SQL, on the smallest tables; and physics."""

from __future__ import annotations

import math

import duckdb
import pytest
from rooflight import catalog
from rooflight.operators import raster

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n in catalog.SQL and n not in ("daily_energy", "annual_energy")])
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([_plain(r[c]) for c in cols]) for r in df.collect())
    done = duck.execute(catalog.SQL[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == cols
    want = sorted(repr([_plain(r[names.index(c)]) for c in cols]) for r in done.fetchall())
    assert got == want


def test_panels_cover_less_than_the_roofs(spark):
    got = {r.plane_id: r.n_panels for r in catalog.QUERIES["panels_on_roofs"](spark, SF).collect()}
    assert got and all(n >= 4 for n in got.values())


def test_labels_across_tiles(spark):
    rows = [(x, y) for x in range(12) for y in range(12) if (x * 7 + y * y * 3) % 5 > 1]
    pixels = spark.createDataFrame([*rows, rows[0], (None, 1)], "cx long, cy long")
    got = {(r.cx, r.cy): r.label for r in raster.label_components(pixels, tile=3).collect()}
    want = {p: p[1] * (1 << 20) + p[0] for p in rows}
    for _ in rows:
        want = {(x, y): min(want.get(q, 1 << 60) for q in ((x, y), (x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1))) for x, y in want}
    assert got == want and raster.label_components(pixels.limit(0)).count() == 0


def test_south_beats_east_and_west(spark):
    year = {r.orientation: r.kwh_year for r in catalog.QUERIES["annual_energy"](spark, SF).where("r_regionkey = 1").collect()}
    for slope in (8, 16):  # 30 and 60 degrees; orientations count aspects by 45 degrees from north
        assert year[slope + 4] > year[slope + 2] > year[slope]
        assert abs(year[slope + 2] - year[slope + 6]) < 0.02 * year[slope + 2]
