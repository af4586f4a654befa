"""Nulls, repeated rows and empty tables in rasters and sequential steps."""

from __future__ import annotations

from rooflight.operators import raster, sequences

PIXELS = "cx int, cy int, z double"
#: A block of 3 x 3 whose middle is the only full neighbourhood.
BLOCK = [(x, y, float(10 * x + y)) for x in range(3) for y in range(3)]


def test_stencil_of_awkward_pixels(spark):
    full = [(1, 1, 2.0, 12.0, 22.0, 1.0, 11.0, 21.0, 0.0, 10.0, 20.0)]
    frame = spark.createDataFrame
    for more in ([], BLOCK, [(None, 1, 5.0), (1, None, 5.0), (7, 7, None)]):
        assert [tuple(r) for r in raster.stencil(frame(BLOCK + more, PIXELS)).collect()] == full
    assert raster.stencil(frame([p if p[:2] != (0, 0) else (0, 0, None) for p in BLOCK], PIXELS)).count() == 0
    assert raster.stencil(frame([], PIXELS)).count() == 0


def test_mosaic_of_awkward_pixels(spark):
    schema = "cx int, cy int, res double, v double"
    rows = [(0, 0, 0.5, None), (0, 0, 1.0, 3.0), (0, 0, 2.0, 4.0), (0, 0, 1.0, 3.0), (None, 0, 1.0, 9.0), (0, None, 1.0, 9.0), (5, 5, 1.0, None)]
    assert [tuple(r) for r in raster.mosaic(spark.createDataFrame(rows, schema)).collect()] == [(0, 0, 3.0, 1.0)]
    assert raster.mosaic(spark.createDataFrame([], schema)).count() == 0


def test_horizon_of_awkward_pixels(spark):
    def heights(rows):
        return {tuple(r) for r in raster.horizon(spark.createDataFrame(rows, PIXELS), 2).collect()}

    plain = heights(BLOCK)
    assert len(plain) == 40  # 3 neighbours at a corner, 5 at an edge, 8 in the middle
    assert heights(BLOCK + BLOCK) == plain == heights([*BLOCK, (None, 1, 99.0), (1, None, 99.0), (3, 3, None)])
    assert heights([]) == set()


def test_clusters_of_awkward_values(spark):
    def clusters(rows):
        out = sequences.dbscan_1d(spark.createDataFrame(rows, "part int, k int, v double"), "part", "v", "k", 0.6, 3)
        return {(r.part, r.k): r.cluster for r in out.collect()}

    rows = [(1, k, v) for k, v in enumerate([1.0, 1.0, 1.2, 1.7, 9.0, 20.0, 20.1, 20.2])]
    want = {(1, k): c for k, c in enumerate([1, 1, 1, 1, 0, 2, 2, 2])}
    assert clusters(rows) == want
    empty = [(1, 100 + k, None) for k in range(4)]
    assert clusters(rows + empty) == want | {(1, 100 + k): 0 for k in range(4)}
    assert clusters(empty) == {(1, 100 + k): 0 for k in range(4)} and clusters([]) == {}


def test_batches_of_nothing(spark):
    assert sequences.adaptive_batches(spark.createDataFrame([], "part int, k int, size int"), "part", ["k"], "size").count() == 0
