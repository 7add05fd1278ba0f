"""Steps of a unit's conditioning that move cells to their tiles once: equal to plain versions, without windows over whole columns or joins of cells."""

import numpy as np
from pyspark.sql import functions as F

from rillstone.operators import depressions as I
from rillstone.operators import ladders as L
from rillstone.operators import spatial as P
from rillstone.operators import tiles as T
from rillstone.operators import water as H


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def grid(spark, z, r0=250, c0=252, **more):
    """Cells across a tile's corner; nan is null."""
    rows = [(r + r0, c + c0, None if np.isnan(v) else float(v), *(int(m[r, c]) for m in more.values())) for (r, c), v in np.ndenumerate(z)]
    return spark.createDataFrame(rows, ", ".join(["r long, c long, z double", *(f"{name} int" for name in more)]))


def ring(z, r, c, k=1):
    return {(a, b): z[a, b] for a in range(r - k, r + k + 1) for b in range(c - k, c + k + 1) if 0 <= a < z.shape[0] and 0 <= b < z.shape[1]}


def test_pits_rivers_and_small_waters_need_no_windows(spark):
    rng = np.random.default_rng(2)
    z = rng.integers(0, 30, (14, 11)).astype(float)
    z[3, 4] = np.nan
    river, swo = (rng.random(z.shape) < 0.9).astype(int), rng.integers(0, 12, z.shape)
    cells = grid(spark, z, river=river, swo=swo)
    pits, narrow, raised = I.single_cell_pits(cells), H.river_minimize(cells, 2, 15.0), H.raise_small(cells, F.col("river") == 0, F.col("swo") > 8, 2, 1.0, 9.0)
    for out in (pits, narrow, raised):
        assert "Window" not in plan_of(out) and "Join" not in plan_of(out)
    pits, narrow, raised = ({(x["r"] - 250, x["c"] - 252): x[name] for x in out.collect()} for out, name in ((pits, "out"), (narrow, "low"), (raised, "raised")))
    inside = {(r, c): bool(river[r, c] == 1 and swo[r, c] > 5 and all(river[a] for a in ring(z, r, c))) for r, c in np.ndindex(z.shape)}
    assert any(inside.values())
    for (r, c), v in np.ndenumerate(z):
        v, others = None if np.isnan(v) else v, [x for at, x in ring(z, r, c).items() if at != (r, c)]
        assert pits[r, c] == (min(others) if v is not None and len(others) == 8 and not np.isnan(others).any() and v < min(others) else v)
        low = [z[at] for at in ring(z, r, c, 2) if inside[at] and not np.isnan(z[at])]
        if v is not None:
            assert narrow[r, c] == (max(min(low), v - 15) if inside[r, c] else v)
            large = [z[at] for at in ring(z, r, c, 2) if swo[at] > 8 and not np.isnan(z[at])]
            lack = min(large, default=-99) + 1 - v
            assert raised[r, c] == (v + lack if river[r, c] == 0 and 0 < lack <= 9 else v)


def test_outlets_are_no_nodes_and_cells_are_not_joined(spark, monkeypatch):
    rng = np.random.default_rng(5)
    z = rng.integers(0, 40, (300, 6)).astype(float)
    seen = {}

    def grab(edges, ways, few):
        seen["edges"], seen["ways"], seen["levels"] = edges.count(), ways.count(), spill(edges, ways, few)
        return seen["levels"]

    spill = I.spill_levels
    monkeypatch.setattr(I, "spill_levels", grab)
    cells = grid(spark, z, 0, 0).withColumn("name", F.lit("x"))  # never null
    out = I.fill_depressions(cells, "z", 6)
    assert out.columns == ["r", "c", "z", "name", "filled"] and plan_of(out).count("Join") == 1  # the labels' levels
    assert out.count() == z.size
    # one border of blocks, six cells wide; the 596 cells at the grid's edge are all outside
    assert seen["edges"] + seen["ways"] <= 40
    assert all(x["filled"] == x["z"] for x in out.where("r in (0, 299) or c in (0, 5)").collect())


def test_cells_outside_and_far_tiles(spark):
    zone = spark.createDataFrame([(r, c) for r in range(250, 262) for c in range(250, 259) if (r, c) != (255, 255)], "r long, c long")
    want = {(r, c) for r in range(249, 263) for c in range(248, 261)} - {tuple(x) for x in zone.collect()}
    assert {tuple(x) for x in T.outer_ring(zone, 1, 2).collect()} == want
    inner = {tuple(x) for x in P.inset_cells(zone, 1.0, 1.0, 1.0).collect()}
    assert inner == {(r, c) for r in range(251, 261) for c in range(251, 258)} - {(255, 255), (254, 255), (256, 255), (255, 254), (255, 256)}
    # a strip of ten tiles: one piece, one hole
    cells = spark.range(2560 * 3).selectExpr("id div 3 AS r", "id % 3 AS c", "CAST(id % 7 AS DOUBLE) AS z")
    pieces = spark.createDataFrame([(9, 1300, 1)], "zone long, r long, c long")
    kept = T.near_tiles(cells, pieces, 3).agg(F.min("r"), F.max("r")).first()
    assert 256 <= kept[0] <= 1297 and 1303 <= kept[1] < 2304
    assert {(x["r"], x["c"], x["d"]) for x in T.around(cells, pieces, 2).collect()} == {(r, c, max(abs(r - 1300), abs(c - 1))) for r in range(1298, 1303) for c in range(3)} - {(1300, 1, 0)}
    gone = spark.createDataFrame([(1279, 1), (1280, 1)], "r long, c long")
    new = {(x["r"], x["c"]): x["z"] for x in L._refill(cells, gone, 1).collect()}
    old = {(x["r"], x["c"]): x["z"] for x in cells.collect()}
    assert len(new) == 7680 and {at for at in old if old[at] != new[at]} <= {(1279, 1), (1280, 1)}
    for r, other in ((1279, 1280), (1280, 1279)):
        near = [(1.0 / (abs(a - r) + abs(b - 1)), old[a, b]) for a in (r - 1, r, r + 1) for b in (0, 1, 2) if (a, b) not in ((r, 1), (other, 1))]
        assert abs(new[r, 1] - sum(w * v for w, v in near) / sum(w for w, _ in near)) < 1e-9
