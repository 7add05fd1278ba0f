"""Operators against brute force on small grids, and invariants."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import bias as V
from rillstone.operators import depressions as I
from rillstone.operators import drainage as J
from rillstone.operators import focal as K
from rillstone.operators import grid as G
from rillstone.operators import spatial as S
from rillstone.operators import water as H
from rillstone.operators import zones as D
from rillstone.operators.components import star_components


def cells_of(spark, z, name="z"):
    rows = [(int(r), int(c), None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(z)]
    return spark.createDataFrame(rows, f"r long, c long, {name} double")


def grid_of(df, value, shape):
    out = np.full(shape, np.nan)
    for row in df.select("r", "c", value).collect():
        out[row["r"], row["c"]] = np.nan if row[value] is None else row[value]
    return out


@pytest.fixture(scope="module")
def hills():
    return np.random.default_rng(5).integers(0, 60, (20, 17)).astype(float)


def test_components_of_chains_stars_and_loops(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 6), (2, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in star_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}
    assert star_components(edges.limit(0)).count() == 0


def test_moving_windows_equal_brute_force(spark, hills):
    out = K.moving(cells_of(spark, hills), {"lo": ("min", "z", 2), "hi": ("max", "z", 1), "s": ("sum", "z", 3)})
    lo, total = grid_of(out, "lo", hills.shape), grid_of(out, "s", hills.shape)
    for r, c in np.ndindex(hills.shape):
        assert lo[r, c] == hills[max(0, r - 2) : r + 3, max(0, c - 2) : c + 3].min()
        assert total[r, c] == hills[max(0, r - 3) : r + 4, max(0, c - 3) : c + 4].sum()


def test_ring_smoothing_equals_direct_convolution(spark, hills):
    weights = [1.0, 0.7, 0.35]
    out = grid_of(K.ring_smooth(cells_of(spark, hills), "z", {"o": weights}, *hills.shape), "o", hills.shape)
    pad = np.pad(hills, 2, mode="symmetric")
    kernel = np.array([[weights[max(abs(i), abs(j))] for j in range(-2, 3)] for i in range(-2, 3)])
    want = np.array([[(pad[r : r + 5, c : c + 5] * kernel).sum() / kernel.sum() for c in range(hills.shape[1])] for r in range(hills.shape[0])])
    assert np.allclose(out, want)


def test_gradient_equals_numpy(spark, hills):
    out = K.gradient(cells_of(spark, hills), "z", 2.0, 3.0)
    gy, gx = np.gradient(hills, 3.0, 2.0)
    assert np.allclose(grid_of(out, "gx", hills.shape), gx) and np.allclose(grid_of(out, "gy", hills.shape), gy)


def priority_flood(z):
    out, heap, done = np.full(z.shape, np.inf), [], np.zeros(z.shape, bool)
    for r, c in np.ndindex(z.shape):
        if not np.isnan(z[r, c]):
            around = [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
            if any(not (0 <= a < z.shape[0] and 0 <= b < z.shape[1]) or np.isnan(z[a, b]) for a, b in around):
                heap.append((z[r, c], r, c))
    heapq.heapify(heap)
    while heap:
        v, r, c = heapq.heappop(heap)
        if done[r, c]:
            continue
        done[r, c], out[r, c] = True, v
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                a, b = r + i, c + j
                if 0 <= a < z.shape[0] and 0 <= b < z.shape[1] and not np.isnan(z[a, b]) and not done[a, b]:
                    heapq.heappush(heap, (max(v, z[a, b]), a, b))
    return out


@pytest.mark.parametrize("block", [5, 64])
def test_fill_equals_priority_flood_for_any_block(spark, hills, block):
    z = hills.copy()
    z[8, 9] = np.nan
    out = grid_of(I.fill_depressions(cells_of(spark, z), "z", 17, block), "filled", z.shape)
    want, there = priority_flood(z), ~np.isnan(z)
    assert np.array_equal(out[there], want[there]) and (out[there] >= z[there]).all()


def test_labels_and_holes(spark):
    z = np.zeros((7, 7))
    z[1:6, 1:6] = 1
    z[3, 3] = 0
    z[0, 0] = 1
    cells = cells_of(spark, z)
    assert D.label(cells, F.col("z") == 1, 7, 8).select("zone").distinct().count() == 1
    assert D.label(cells, F.col("z") == 1, 7, 4).select("zone").distinct().count() == 2
    assert D.close_holes(cells.where("z = 1").select("r", "c"), 7, 7).count() == 26


def test_accumulation_reaches_every_outlet(spark, hills):
    tilted = hills + 100 * np.arange(20)[:, None]
    pointers = J.d8_pointer(cells_of(spark, tilted), "z")
    total = J.flow_accumulation(pointers, 17).join(pointers.where("dir = 0").select("r", "c"), ["r", "c"]).agg(F.sum("cells")).first()[0]
    assert total == hills.size


def test_breach_goes_down_within_its_radius(spark):
    z = np.full((9, 9), 10.0)
    z[4, 4], z[4, 7] = 2.0, 1.0
    cells = cells_of(spark, z)
    carve = I.breach_depressions(cells, spark.createDataFrame([(1, 4, 4)], "pit long, r long, c long"), 4).collect()
    assert {(r["r"], r["c"]) for r in carve} >= {(4, 4), (4, 7)} and all(r["value"] <= z[r["r"], r["c"]] for r in carve)
    assert I.breach_depressions(cells, spark.createDataFrame([(1, 4, 4)], "pit long, r long, c long"), 2).count() == 0


def test_mosaic_does_not_depend_on_partitions(spark, hills):
    cells = cells_of(spark, hills)
    a, b = cells.where("r < 12"), cells.where("r >= 8").withColumn("z", F.col("z") + 1)
    one = G.mosaic([a, b], "z").orderBy("r", "c").collect()
    assert one == G.mosaic([a.repartition(7), b.repartition(3)], "z").orderBy("r", "c").collect()


def test_nearest_points_far_away(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 100.0, 0.0, 7.0)], "pid long, x double, y double, z double")
    queries = spark.createDataFrame([(1, 40.0, 0.0)], "qid long, x double, y double")
    assert [(r["pid"], r["rank"]) for r in S.nearest_points(points, queries, 2, 1.0).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_blocks_round_trip(spark, hills):
    z = hills.copy()
    z[2, 2] = np.nan
    back = G.from_blocks(G.to_blocks(cells_of(spark, z), ["z"], 8), "z", 8)
    got = grid_of(back, "v", z.shape)
    assert np.array_equal(np.isnan(got), np.isnan(z)) and np.array_equal(got[~np.isnan(z)], z[~np.isnan(z)])


def test_partial_fill_and_unit_run_on_a_bowl(spark):
    z = np.full((12, 12), 20.0)
    z[4:8, 4:8] = 10.0
    z[6, 6], z[0, 6] = 5.0, 1.0
    cells = cells_of(spark, z).withColumn("water", F.lit(0))
    out = I.condition_unit(cells, 12, 0.5, 6, I.SolutionLimits(max_carve_depth=50.0))
    done = grid_of(out, "final", z.shape)
    assert np.array_equal(done, priority_flood(grid_of(out, "solved", z.shape)))


def test_partial_fill_wins_where_no_whole_carve_goes(spark):
    z = np.full((3, 8), 30.0)
    z[1, 1:6] = [5.0, 10.0, 10.0, 20.0, 6.0]
    cells = cells_of(spark, z)
    pit = [(1, 1, c, float(z[1, c]), 20.0) for c in (1, 2, 3)]
    held = spark.createDataFrame(pit, "pit long, r long, c long, z double, filled double")
    pits = spark.createDataFrame([(1, 15.0, 35.0)], "pit long, maxfill double, volfill double")
    ways, writes = I.partial_fills(cells, pits, held, 0.2, 6, 14.0)
    want = {2003: 35.0}
    for k in (1, 2, 3, 4):
        surface = {c: max(z[1, c], 20 - 15 * (1 - 0.2 * k)) for c in (1, 2, 3)} | {4: 20.0, 5: 6.0}
        even = [surface[1] + (6 - surface[1]) * i / 4 for i in range(5)]
        want[3000 + 2 * k] = sum(abs(z[1, c] - min(surface[c], even[c - 1])) for c in range(1, 6))
    got = {r["solution"]: r["volume"] for r in ways.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert [tuple(r) for r in I.partial_fill(cells, pits, held, 0.2, 6, 14.0).collect()] == [(1, 3004, 20.5)]
    # with lower ground in reach of the bottom itself, partial fills give way to the whole carve
    low = cells.withColumn("z", F.when((F.col("r") == 1) & (F.col("c") == 5), 4.0).otherwise(F.col("z")))
    assert {r["solution"] for r in I.partial_fills(low, pits, held, 0.2, 6, 50.0)[0].collect()} == {1003, 2003}
    assert writes.where("solution = 3004").count() == 5


def test_solutions_of_very_low_pits_and_fill_behind(spark):
    schema = "pit long, maxfill double, volfill double, n long, maxcarve double, volcarve double, maxfillbehind double, volfillbehind double, completecarve int, n_wall long, n_sink long, n_carve long, n_carve_water long"
    pits = spark.createDataFrame([(1, 0.005, 50.0, 10, 1.0, 5.0, 0.0, 0.0, 1, 0, 0, 3, 0)], schema)
    assert I.select_solution(pits, I.SolutionLimits(shallow=False)).first()["solution"] == 2005
    z = np.full((3, 9), 30.0)
    z[1, 1:8] = [10.0, 12.0, 4.0, 20.0, 8.0, 30.0, 30.0]
    z[1, 8] = 1.0
    cells = cells_of(spark, z)
    carves = spark.createDataFrame([(1, 4, 8.0)], "r long, c long, value double")
    pit = spark.createDataFrame([(1, c, 1) for c in (1, 2, 3)], "r long, c long, label long")
    done, behind = I.fill_behind(cells, carves, pit, 9)
    flooded = z.copy()
    flooded[1, 4] = 8.0
    assert np.array_equal(grid_of(done, "carved", z.shape), priority_flood(flooded))
    assert {(r["c"], r["label"]) for r in behind.collect()} == {(1, 1), (2, 1), (3, 1)}


def test_slopes_beyond_the_table_take_its_last(spark):
    cells = spark.createDataFrame([(1, 50, 20, 100.0), (2, 60, 20, 100.0), (3, 10, 20, 100.0)], "id long, slope int, tc int, z double")
    table = spark.createDataFrame([(999, 50, 20, 7.0), (999, 60, 20, 1.0), (5, 10, 20, 9.0)], "lc int, slope int, tc int, bias double")
    assert {r["id"]: r["corrected"] for r in V.apply_bias_2d(cells, table, "z").collect()} == {1: 93.0, 2: 93.0, 3: 100.0}


def test_water_mask_does_not_join_across_the_sides(spark):
    cells = cells_of(spark, np.zeros((6, 8))).withColumn("osm", F.lit(None).cast("int"))
    wet = spark.createDataFrame([(1, 7), (2, 0)], "r long, c long")
    assert H.water_mask(wet, cells, wet.limit(0), 8, 1).select("zone").distinct().count() == 2


def test_breach_keeps_a_dearer_but_shorter_way(spark):
    z = np.full((5, 9), 100.0)
    z[2, 1:8] = [2.0, 9.0, 5.0, 5.0, 5.0, 5.0, 1.0]
    z[1, 1], z[0, 2], z[1, 3] = 3.0, 3.0, 3.0  # a cheaper way to (2, 4), longer by a step
    carve = I.breach_depressions(cells_of(spark, z), spark.createDataFrame([(1, 2, 1)], "pit long, r long, c long"), 6).collect()
    assert [(r["r"], r["c"]) for r in carve] == [(2, 1), (2, 2), (1, 3), (2, 4), (2, 5), (2, 6), (2, 7)]


def test_nearest_points_with_more_columns(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 5.0, "a"), (2, 100.0, 0.0, 7.0, "b")], "pid long, x double, y double, z double, name string")
    queries = spark.createDataFrame([(1, 40.0, 0.0)], "qid long, x double, y double")
    assert [(r["pid"], r["rank"]) for r in S.nearest_points(points, queries, 2, 1.0).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_small_reservoirs_get_no_barrier(spark):
    z = np.zeros((12, 12))
    z[3, 0] = z[8, 0] = 50
    cells = cells_of(spark, z)
    held = spark.createDataFrame([(3, c, 1) for c in range(9)] + [(8, c, 2) for c in range(3)], "r long, c long, zone long")
    walls = {}
    for least in (0.0, 5e4, 1e6):
        out = H.reservoir_barrier(cells, held, cells.select("r", "c"), 12, 100.0, 100.0, 100.0, 20.0, 1000.0, min_area=least)
        walls[least] = {(r["r"], r["c"], r["z"]) for r in out.where("wall = 1").collect()}
    assert walls == {0.0: {(3, 0, 1050.0), (8, 0, 1050.0)}, 5e4: {(3, 0, 1050.0)}, 1e6: set()}


def test_noise_removal_leaves_artifacts(spark, hills):
    from rillstone.plans.noise import noise_removal

    cells = cells_of(spark, hills).withColumns({"swo": F.lit(0), "edm": F.lit(0), "tc": F.lit(0), "th": F.lit(0)})
    cube = spark.createDataFrame([(0, 10, 1, 1.0)], "slope int, tc int, th int, bias double")
    out = noise_removal(cells, cube, "z", 1000.0, 1200.0, *hills.shape, artifact=F.col("c") < 5)
    got = grid_of(out, "filtered", hills.shape)
    assert np.array_equal(got[:, :5], hills[:, :5]) and not np.array_equal(got[:, 5:], hills[:, 5:])
