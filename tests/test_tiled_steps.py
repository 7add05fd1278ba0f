"""Steps that hold a tile at a time: equal to plain versions across tile borders, by plans that do not multiply the cells."""

import numpy as np
from pyspark.sql import functions as F

from rillstone.operators import drainage as J
from rillstone.operators import focal as K
from rillstone.operators import grid as G
from rillstone.operators import water as H


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_holes_are_filled_from_their_tile_without_a_join(spark):
    rng = np.random.default_rng(8)
    z = rng.integers(0, 90, (12, 9)).astype(float)
    z[rng.random(z.shape) < 0.4] = np.nan
    z[4:, 5:] = np.nan  # the corner is too far from any height
    at = [(r + 250, c + 252) for r, c in np.ndindex(z.shape)]
    rows = [(r, c, None if np.isnan(v) else int(v), f"{r}-{c}") for (r, c), v in zip(at, z.ravel(), strict=True)]
    cells = spark.createDataFrame(rows, "r long, c long, z long, name string")
    out = K.fill_missing(cells, "z", 2)
    assert out.dtypes == [("r", "bigint"), ("c", "bigint"), ("z", "double"), ("name", "string")]
    assert "Join" not in plan_of(out)
    got = {(r, c): (v, name) for r, c, v, name in out.collect()}
    assert len(got) == len(rows)
    for (r, c), old in np.ndenumerate(z):
        near = [(1 / (i * i + j * j), z[r + i, c + j]) for i in range(-2, 3) for j in range(-2, 3) if (i or j) and 0 <= r + i < 12 and 0 <= c + j < 9 and not np.isnan(z[r + i, c + j])]
        want = old if not np.isnan(old) else sum(w * v for w, v in near) / sum(w for w, _ in near) if near else None
        value, name = got[r + 250, c + 252]
        assert name == f"{r + 250}-{c + 252}"
        assert value is None if want is None else abs(value - want) < 1e-9


def test_accumulation_follows_ways_through_many_tiles(spark):
    rng = np.random.default_rng(3)
    height = {(r, c): 3 * r + (5 * c if r % 7 < 3 else -2 * c) + int(rng.integers(0, 25)) for r in range(31) for c in range(14) if rng.random() < 0.97}
    cells = spark.createDataFrame([(r, c, z) for (r, c), z in height.items()], "r long, c long, z long")
    pointers = J.d8_pointer(cells, "z")
    assert "Window" not in plan_of(pointers)  # whole columns of the grid were single tasks
    to, want = {}, dict.fromkeys(height, 0)
    for (r, c), z in height.items():
        drops = [((z - height[r + i, c + j]) / (2**0.5 if i and j else 1.0), -k, (r + i, c + j)) for k, (_, i, j) in enumerate(J.DIRECTIONS, 1) if (r + i, c + j) in height]
        best = max(drops, default=(0.0, 0, None))
        to[r, c] = best[2] if best[0] > 0 else None
    for at in height:
        while at is not None:
            want[at] += 1
            at = to[at]
    for side in (4, 256):
        got = {(r, c): n for r, c, n in J.flow_accumulation(pointers, 14, side=side).select("r", "c", "cells").collect()}
        assert got == want, side


def test_flats_keep_their_columns_and_join_nothing(spark):
    rng = np.random.default_rng(4)
    rows = [(r, c, int(rng.integers(0, 2)), f"{r}/{c}") for r in range(17) for c in range(12)]
    out = J.fix_flats(spark.createDataFrame(rows, "r long, c long, z long, name string"), "z", 0.5, 12, side=5)
    assert "Join" not in plan_of(out)  # the join broadcast all cells, as their files are small
    height, far = {(r, c): z for r, c, z, _ in rows}, {}
    near = {at: [(at[0] + i, at[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j] for at in height}
    ring = [at for at, z in height.items() if any(height.get(n, -1) < z for n in near[at])]
    while ring:
        far |= dict.fromkeys(ring, max(far.values(), default=-1) + 1)
        ring = list({n for at in ring for n in near[at] if height.get(n) == height[at] and n not in far})
    assert {(r, c): (v, name) for r, c, v, name in out.select("r", "c", "out", "name").collect()} == {(r, c): (z + 0.5 * far.get((r, c), 0), name) for r, c, z, name in rows}


def test_targets_of_a_resampling_are_not_broadcast(spark):
    fine, coarse = G.Grid(0.0, 1.0, 40.0, 1.0, 40, 40), G.Grid(0.0, 2.0, 40.0, 2.0, 20, 20)
    cells = spark.range(1600).selectExpr("id div 40 AS r", "id % 40 AS c", "id AS v")
    target = spark.range(400).selectExpr("id div 20 AS r", "id % 20 AS c")
    for out in (G.resample_bilinear(cells, "v", fine, target, coarse), G.resample_nearest(cells, fine, target, coarse, ["v"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        assert out.count() == 400


def test_cells_without_a_lake_do_not_seek_its_level(spark):
    cells = spark.range(4000).selectExpr("id div 40 AS r", "id % 40 AS c", "id % 97 AS z", "CAST(90 AS INT) AS swo")
    lakes = cells.where("r >= 90").selectExpr("r", "c", "r div 5 AS lake")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = H.flatten_lakes(cells, lakes, 60, 0.0, 1e9, 1e9)
        plan = plan_of(out)
        # the join on lakes, the last one, has a filter on its cells' side
        assert "isnull(lake" in plan and "isnotnull(lake" in plan
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 4000 and set(out.columns) == {"r", "c", "z", "swo", "lake", "flat"}
    level = {k: float(np.quantile([x["z"] for x in rows if x["lake"] == k], 0.1)) for k in (18, 19)}
    assert all(abs(x["flat"] - (x["z"] if x["lake"] is None else level[x["lake"]])) < 1e-9 for x in rows)
