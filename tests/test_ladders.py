"""Ladders of heights against plain versions that go up step by step."""

import numpy as np
import pytest

from rillstone.operators.ladders import ladder_of, lower_river_below_land, monotonic_rivers, monotonic_streams
from rillstone.operators.tiles import around
from rillstone.operators.zones import label

M = 1000.0
SQUARE = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
CROSS = [(0, 1), (1, 0), (0, -1), (-1, 0)]


def parts(mask, steps):
    """Connected parts as lists of cells, in the order of their first cells."""
    left, out = {tuple(x) for x in np.argwhere(mask)}, []
    for start in sorted(left):
        if start not in left:
            continue
        left.discard(start)
        found, k = [start], 0
        while k < len(found):
            for i, j in steps:
                n = (found[k][0] + i, found[k][1] + j)
                if n in left:
                    left.discard(n)
                    found.append(n)
            k += 1
        out.append(sorted(found))
    return out


def grown(mask, k):
    out = np.zeros_like(mask)
    for i, j in np.argwhere(mask):
        out[max(0, i - k) : i + k + 1, max(0, j - k) : j + k + 1] = True
    return out


def at(cells, shape):
    out = np.zeros(shape, bool)
    out[tuple(np.array(cells).T)] = True
    return out


def refill(z, gone, k):
    out = z.copy()
    for i, j in np.argwhere(gone):
        num = den = 0.0
        for a in range(max(0, i - k), min(z.shape[0], i + k + 1)):
            for b in range(max(0, j - k), min(z.shape[1], j + k + 1)):
                if not gone[a, b]:
                    w = 1 / ((a - i) ** 2 + (b - j) ** 2)
                    num, den = num + w * z[a, b], den + w
        if den:
            out[i, j] = num / den
    return out


def plain_below_land(z, swo, code, cutoff=20):
    water = np.isin(code, (3, 4))
    low, high = np.floor(max(-2, np.percentile(z[water], 3) / M)) - 1.25, np.ceil(max(0, np.percentile(z[water], 99) / M)) + 0.25
    step = 0.5 if high - low <= 10 else 1.0
    out, new, ring = z.copy(), code.copy(), np.zeros(z.shape, int)
    for k in range(int(np.ceil((high + step - low) / step))):
        here = water & (np.floor((z / M - low) / step) == k)
        for piece in parts(here, SQUARE):
            mine = at(piece, z.shape)
            if len(piece) < 50:
                continue
            border = grown(mine, 1) & ~mine
            banks, waters = border & (code < 3), border & (code > 2)
            if not banks.any() or waters.any() and (len(parts(banks, SQUARE)) < 2 or 5 * banks.sum() < banks.sum() + waters.sum()):
                continue
            land = grown(mine, 15) & ~mine & (code < 3) & (swo < cutoff)
            if not land.any():
                continue
            p25 = np.percentile(z[mine], 25)
            drop = p25 - (np.percentile(z[land], 5) - 0.5 * M)
            if drop > 30 * M:
                drop = p25 - (np.percentile(z[land], 10) - M)
            near = grown(mine, 3)
            if drop <= 0 or (near & (code > 2) & (mine | ~here) & (z >= p25 - drop)).sum() >= 2.5 * len(piece):
                continue
            out[mine] = np.maximum(z[mine] - drop, p25 - drop - M)
            new[mine & (code != 3)] = 5
            ring[near & ~mine & (code > 2) & (code < 6)] = np.maximum(1, ring[near & ~mine & (code > 2) & (code < 6)])
            if drop > 3 * M:
                ring[near & ~mine & (code < 2)] = 2
    new[ring == 2] = 2
    return refill(out, ring > 0, 8), new


def plain_rivers(z, swo, code, heights, radius=25.0, cutoff=20, max_range=100.0):
    z, first, was, new = z.copy(), z.copy(), code.copy(), code.copy()
    river, left, ring = (was > 3) & (was < 8), np.ones(z.shape, int), np.zeros(z.shape, int)
    area = round(np.pi * (radius / 10) ** 2)
    for h in heights:
        falls = []
        for piece in parts(grown(river & (z > h), 1) & river & (z != h), CROSS):
            mine, n = at(piece, z.shape), len(piece)
            near, border = grown(mine, 3) & ~mine, grown(mine, 1) & ~mine
            waters = near & (was > 2) & (was < 7)
            banks = near & (was > 0) & (was < 3)
            if n <= area or not (border & (was < 3)).any() and n < 4 * area or n < 2 * waters.sum():
                continue
            if banks.sum() < 1.5 * waters.sum() and np.percentile(swo[mine], 80) < cutoff:
                continue
            edge = waters & (z <= h)
            rows, cols = np.array(piece).T
            caps = []
            for cap in parts(edge, CROSS):
                a, b = np.array(cap).T
                inside = cols.min() + 10 < b.min() and cols.max() - 10 > b.max() and rows.min() + 10 < a.min() and rows.max() - 10 > a.max()
                if len(cap) >= 3 and not inside and not (mine | edge)[grown(at(cap, z.shape), 1)].all():
                    caps.append(cap)
            if not 2 <= len(caps) <= 3:
                continue
            cells = sorted((i, j, k) for k, cap in enumerate(caps) for i, j in cap)
            w, e = min(cells, key=lambda x: (x[1], x[0])), min(cells, key=lambda x: (-x[1], x[0]))
            n_, s_ = min(cells, key=lambda x: (x[0], x[1])), min(cells, key=lambda x: (-x[0], x[1]))
            x, y = (0 if p[2] == q[2] else np.hypot(p[0] - q[0], p[1] - q[1]) for p, q in ((w, e), (n_, s_)))
            least = np.hypot(rows.max() - rows.min() + 9, cols.max() - cols.min() + 9) / 2
            level = np.percentile([z[i, j] for i, j, _ in cells], 20)
            drop = np.percentile(z[mine], 10) - level
            if x < least or y < least or drop < 0:
                continue
            falls.append((mine, level, drop, np.percentile(z[mine], 95) - np.percentile(z[mine], 10) < max_range * M and left[mine].min() == 2, waters, banks))
        for mine, level, drop, absolute, waters, banks in falls:
            if absolute:
                z[mine], new[mine] = level, 7
                ring[banks] = np.maximum(ring[banks], 1)
            else:
                z[mine] = np.where(z[mine] - h < drop, level, z[mine] - drop)
                new[mine], left[mine] = 6, 2
            ring[waters] = 2
            up = z - first > 0.1 * M
            z[up] = first[up]
    new[ring == 1] = 2
    return refill(z, ring > 0, 8), new


def plain_streams(z, swo, code, heights, radius=25.0):
    z, new, on, ring = z.copy(), code.copy(), (code > 7) & (code < 11), np.zeros(z.shape, int)
    rise = heights[1] - heights[0]
    for h in heights:
        falls = []
        for piece in parts(on & (z > h), SQUARE):
            mine, n = at(piece, z.shape), len(piece)
            if not radius / 4 <= n <= on.sum() / 4 or z[mine].max() - h < rise / 2:
                continue
            ends = parts(grown(mine, 2) & ~mine & on & (z < h), SQUARE)
            if len(ends) < 2 or min(map(len, ends)) < 2 or (grown(mine, 8) & ~mine & ~on & (code < 3) & (z <= h + rise)).sum() >= n:
                continue
            count = [sum((i + a, j + b) in set(piece) for a, b in [(0, 0), *SQUARE]) for i, j in piece]
            few = count.count(min(count))
            if few > 3 or few == 3 and len(ends) < 3 or max(count) > 4 and few < 3:
                continue
            if len(ends) == 2 and np.hypot(ends[0][0][0] - ends[1][0][0], ends[0][0][1] - ends[1][0][1]) < n / 2:
                continue
            falls.append((mine, max(z[x] for e in ends for x in e)))
        for mine, to in falls:
            ring[grown(mine, 2) & (code != 7) & (ring < 2)] = 1
        for mine, to in falls:
            z[mine], ring[mine] = to, 2
    new[ring == 2], new[ring == 1] = 13, 14
    return refill(z, ring == 1, 5), new


def river_grid(seed, n=100, m=64):
    rng = np.random.default_rng(seed)
    r, c = np.mgrid[:n, :m]
    t = r % 96
    off = np.abs(c - (12 + np.where(t < 48, t, 96 - t) * 0.9))
    hump = np.where((r % 48 >= 10) & (r % 48 <= 36), 3000, 0) + np.where((r % 48 >= 15) & (r % 48 <= 31), 4000, 0)
    z = np.where(off <= 4, 10_000 - 3 * r + hump, 25_000 - 3 * r) + rng.integers(0, 40, (n, m))
    code = np.where(off <= 4, 4, np.where(off <= 6, 2, 0))
    swo = rng.integers(0, 100, (n, m))
    return z.astype(float), swo, code


def frame(spark, z, swo, code):
    rows = [(int(i), int(j), float(z[i, j]), int(swo[i, j]), int(code[i, j])) for i in range(z.shape[0]) for j in range(z.shape[1])]
    return spark.createDataFrame(rows, "r long, c long, z double, swo int, code int").repartition(5)


def same(out, z, code):
    found_z, found_code = np.full(z.shape, np.nan), np.full(z.shape, -1)
    rows = out.collect()
    assert len(rows) == z.size
    for x in rows:
        found_z[x["r"], x["c"]], found_code[x["r"], x["c"]] = x["z"], x["code"]
    assert np.array_equal(found_code, code)
    assert np.allclose(found_z, z, atol=1e-6)


def test_rivers_below_land(spark):
    z, swo, code = river_grid(1)
    z[:48, :][code[:48, :] < 3] -= 18_000  # land below the river, at first by much
    z[48:, :][code[48:, :] < 3] -= 15_500
    code[60:70, :][code[60:70, :] == 4] = 3
    want_z, want_code = plain_below_land(z, swo, code)
    assert (want_code == 5).any() and (want_code == 2).sum() > (code == 2).sum() and (want_z[code == 3] < z[code == 3]).any()
    same(lower_river_below_land(frame(spark, z, swo, code), z.shape[1]), want_z, want_code)


@pytest.mark.parametrize("seed", [2])
def test_monotonic_rivers(spark, seed):
    z, swo, code = river_grid(seed)
    heights = [9_500.0, 10_500.0, 11_500.0, 12_500.0, 13_500.0, 15_000.0]
    want_z, want_code = plain_rivers(z, swo, code, heights)
    assert {6, 7} <= set(np.unique(want_code))
    same(monotonic_rivers(frame(spark, z, swo, code), z.shape[1], heights=heights), want_z, want_code)


def test_few_rivers_and_rims_stay(spark):
    z, swo, code = river_grid(2, 60)
    cells = frame(spark, z, swo, code)
    same(monotonic_rivers(cells, z.shape[1]), z, code)  # too few cells for a ladder of its own
    rim = cells.where("r = 24").select("r", "c")
    same(monotonic_rivers(cells, z.shape[1], rim=rim, heights=[10_500.0]), z, code)
    same(lower_river_below_land(cells.where("code < 3 or r < 3"), z.shape[1]).unionByName(cells.where("code >= 3 and r >= 3")), z, code)
    assert monotonic_streams(cells.where("false"), 64).collect() == []


def test_monotonic_streams(spark):
    rng = np.random.default_rng(4)
    n, m = 120, 40
    r, c = np.mgrid[:n, :m]
    line = (c == 6) | (c == 20) & (r < 70) | (r - 70 == c - 20) & (r >= 70) & (r < 89) | (c == 32) & (r % 2 == 0)
    branch = (r - 40 == c - 20) & (r > 40) & (r < 60) & (c < 40)
    z = np.where(line | branch, 10_000 - 10 * r, 40_000) + rng.integers(0, 8, (n, m)).astype(float)
    z[(line | branch) & (r % 50 >= 12) & (r % 50 <= 30)] += 6_000
    z[35:55, 20] += 6_000
    code = np.where(line | branch, 8, 0)
    z[:60, 8:14] -= 31_000  # low land beside the first line
    heights = [9_500.0, 11_500.0, 13_500.0, 15_500.0]
    want_z, want_code = plain_streams(z, np.zeros((n, m), int), code, heights)
    assert (want_code == 13).any() and (want_code == 14).any()
    same(monotonic_streams(frame(spark, z, np.zeros((n, m), int), code), m, heights=heights), want_z, want_code)


def test_ladder_steps_grow_with_the_span():
    steps = ((-1, 2.0), (20, 3.0), (100, 5.0))
    assert ladder_of(0.5, 6.5, steps) == [0.5, 2.5, 4.5] and ladder_of(0.5, 30.5, steps)[1] == 3.5 and ladder_of(3.0, 3.0, steps) == []


def test_zones_and_rings_across_tiles(spark):
    from pyspark.sql import functions as F

    # a spiral of one cell's width and a bar, over several tiles
    cells = [(i, 300) for i in range(600)] + [(599, j) for j in range(10, 300)] + [(i, 10) for i in range(200, 599)] + [(50, j) for j in range(400, 700)]
    grid = spark.createDataFrame(cells, "r long, c long")
    zones = {(x["r"], x["c"]): x["zone"] for x in label(grid, F.lit(True), 800).collect()}
    assert {zones[x] for x in cells[:-300]} == {300} and {zones[x] for x in cells[-300:]} == {50 * 800 + 400}
    apart = {(x["r"], x["c"]): x["zone"] for x in label(grid.withColumn("k", (F.col("r") > 255).cast("int")), F.lit(True), 800, keys=["k"]).collect()}
    assert apart[0, 300] != apart[300, 300] and apart[300, 300] == apart[300, 10]
    pieces = spark.createDataFrame([(7, 255, 255), (7, 256, 256), (9, 256, 258)], "zone long, r long, c long")
    whole = spark.range(240, 280).selectExpr("id as r", "explode(sequence(240L, 280L)) as c").withColumn("v", F.col("r") * 1000 + F.col("c"))
    found = {(x["zone"], x["r"], x["c"]): (x["d"], x["v"]) for x in around(whole, pieces, 3).collect()}
    want = {}
    for zone, own in ((7, {(255, 255), (256, 256)}), (9, {(256, 258)})):
        for i in range(240, 280):
            for j in range(240, 281):
                d = min(max(abs(i - a), abs(j - b)) for a, b in own)
                if 0 < d <= 3:
                    want[zone, i, j] = d, i * 1000 + j
    assert found == want


def test_falls_in_places_apart_share_a_round(spark, monkeypatch):
    from rillstone.operators import ladders

    z, swo, code = river_grid(2, 240)
    z += (240 - np.arange(240))[:, None] // 60 * 1_000.0  # humps begin at higher and higher steps
    heights = [9_500.0 + 1_000.0 * k for k in range(9)]
    want_z, want_code = plain_rivers(z, swo, code, heights)
    rounds, write = [], ladders.write_table
    monkeypatch.setattr(ladders, "write_table", lambda df, tag, *a: rounds.append(tag) or write(df, tag, *a))
    same(monotonic_rivers(frame(spark, z, swo, code), z.shape[1], heights=heights), want_z, want_code)
    steps = {int(v) for v in want_z[(want_code != code) & (want_code > 5)] // 1_000}
    assert len(steps) >= 4 and rounds.count("ladder-state") <= 3


def test_what_falls_reach(spark, monkeypatch):
    from rillstone.operators import ladders

    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 5), (4, 5), (6, 7)], "a long, b long")
    for few in (10, 0):
        monkeypatch.setattr(ladders, "FEW", few)
        found = ladders._reached(edges, spark.createDataFrame([(1,), (2,), (9,)], "zone long"))
        assert sorted(x["zone"] for x in found.collect()) == [2, 3, 5]
