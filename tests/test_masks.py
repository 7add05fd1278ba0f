"""Curvature by gradients, coast masks and redrawn rivers on small grids."""

import numpy as np
from pyspark.sql import functions as F

from rillstone.operators.focal import curvature_d4
from rillstone.operators.water import alternate_dem, coast_land_mask


def test_geometric_curvature_of_four_directions(spark):
    rng = np.random.default_rng(3)
    z, dx, dy = rng.normal(size=(9, 7)) * 10, 2.0, 3.0
    step = 2 * np.hypot(dx, dy)

    def slant(a, i):
        p = np.pad(a, 1, "symmetric")
        return ((p[:-2, 2:] - p[2:, :-2]) if i else (p[:-2, :-2] - p[2:, 2:])) / step

    gy, gx = np.gradient(z, dy, dx)
    ne, nw = slant(z, 1), slant(z, 0)
    flat, tilted = np.hypot(gx, gy) + 0.1, np.hypot(ne, nw) + 0.1
    want = np.gradient(gx / flat, dx, axis=1) + np.gradient(gy / flat, dy, axis=0) + slant(ne / tilted, 1) + slant(nw / tilted, 0)
    cells = spark.createDataFrame([(i, j, float(z[i, j])) for i in range(9) for j in range(7)], "r long, c long, z double")
    out = curvature_d4(cells, "z", dx, dy, 9, 7, geometric=True)
    assert out.count() == 63 and all(abs(x["curvature"] - want[x["r"], x["c"]]) < 1e-9 for x in out.collect())


def test_low_holes_in_the_ocean_and_land_buffers(spark):
    cells = [(i, j, 0 if j < 8 else 900, 4 if j < 8 else 0, 0) for i in range(12) for j in range(14)]
    cells = [(i, j, -5, 5, 0) if (i, j) == (5, 3) else (i, j, -5, 0, 0) if (i, j) == (8, 3) else (i, j, z, e, o) for i, j, z, e, o in cells]
    out = coast_land_mask(spark.createDataFrame(cells, "r long, c long, z long, edm int, osm int"), F.col("osm") > 0, 1, dx_m=10.0, dy_m=10.0, tight=10.0, wide=30.0)
    got = {(x["r"], x["c"]): x for x in out.collect()}
    assert got[5, 3]["ocean"] == 1 and got[8, 3]["ocean"] == 0 and got[8, 3]["land"] == 1  # a low hole with edited fill, and one without
    assert [got[0, j]["land"] for j in (6, 7, 8)] == [0, 1, 1] and [got[0, j]["land_wide"] for j in (4, 5, 6)] == [0, 1, 1]
    assert got[0, 9]["shore"] == 1 and got[0, 10]["shore"] == 0


def test_rivers_are_redrawn_from_the_alternate_surface(spark):
    # a river of 60 cells whose steps in the alternate surface run one column beside it, and a second one without such steps
    cells = []
    for i in range(20):
        for j in range(30):
            river = 1 if 4 <= j <= 6 or 20 <= j <= 22 else 0
            alt = 2000 if 5 <= j <= 8 else 1999
            cells.append((i, j, 3000, alt, 90 if river or 5 <= j <= 8 else 0, river, 1 if (i, j) == (10, 28) else 0))
    table = spark.createDataFrame(cells, "r long, c long, z long, alt long, swo int, river int, lake int")
    out = alternate_dem(table, 30, 500, F.col("river") == 1, redraw=True, min_overlap=30)
    got = {(x["r"], x["c"]): x for x in out.collect()}
    row = [got[10, j] for j in range(30)]
    assert len(got) == 600 and [x["taken"] for x in row[3:11]] == [0, 1, 1, 1, 1, 1, 1, 0]
    # zones of steps grow by a cell and take the new heights; two cells around them are filled in anew
    assert [x["z_new"] for x in row[4:10]] == [1999.0, 2000.0, 2000.0, 2000.0, 2000.0, 1999.0]
    assert [x["code_new"] for x in row[:4]] == [0, 0, 15, 15] and [x["code_new"] for x in row[4:12]] == [4] * 6 + [15, 15]
    assert 1999 < row[3]["z_new"] < 3000 and [x["code_new"] for x in row[20:23]] == [4, 4, 4] and row[28]["code_new"] == 3 and row[28]["z_new"] == 1999
