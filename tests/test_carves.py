"""Carves and flats over several tiles, and least-cost ways against a plain search over all ways."""

import math
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators.depressions import Carving, _carve, breach_and_fill, breach_depressions
from rillstone.operators.drainage import fix_flats

EIGHT = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]


def surface(seed, n=26, m=19):
    rng = np.random.default_rng(seed)
    return rng.integers(0, 40, (n, m)).astype(float) + 20


def frame(spark, z):
    return spark.createDataFrame([(i, j, float(z[i, j])) for i in range(z.shape[0]) for j in range(z.shape[1])], "r long, c long, z double").repartition(4)


def pits(z):
    found = [(i, j) for i in range(1, z.shape[0] - 1) for j in range(1, z.shape[1] - 1) if all(z[i + a, j + b] > z[i, j] for a, b in EIGHT)]
    return [(k + 1, i, j) for k, (i, j) in enumerate(found)]


def cheapest(z, start, radius, depth, most, shortest, increment):
    """Least cost of a way to a cell below the pit's level, by trying all cells at each number of steps."""
    low, now = z[start], {start: 0.0}
    best = math.inf
    for step in range(1, radius + 1):
        then = {}
        for (i, j), cost in now.items():
            for a, b in EIGHT:
                x, y = i + a, j + b
                if 0 <= x < z.shape[0] and 0 <= y < z.shape[1] and z[x, y] - low <= depth:
                    c = cost + max(0.0, z[x, y] - (low - increment * step)) * (math.hypot(a, b) if shortest else 1)
                    if c <= most and c < then.get((x, y), math.inf):
                        then[x, y] = c
        now = then
        best = min([best, *(c for x, c in now.items() if z[x] < low - increment * step)])
    return best


@pytest.mark.parametrize("how", [Carving(4), Carving(5, 25.0), Carving(5, least_cost=True, shortest=True), Carving(6, least_cost=True, max_cost=20.0, increment=0.5)])
def test_ways_cost_the_least(spark, how):
    z = surface(5)
    bottoms = pits(z)
    found = {}
    for x in breach_depressions(frame(spark, z), spark.createDataFrame(bottoms, "pit long, r long, c long"), how=how, side=9).collect():
        found.setdefault(x["pit"], {})[x["r"], x["c"]] = x["value"]
    for pit, i, j in bottoms:
        want = cheapest(z, (i, j), how.radius, how.max_depth, how.max_cost, how.shortest, how.increment)
        assert (pit in found) == (want < math.inf)
        if pit in found:
            way = found[pit]
            assert way[i, j] == z[i, j] and len(way) - 1 <= how.radius and all(v <= z[x] for x, v in way.items())
        # the ways of one pit in order, with their cost
        wide = np.pad(z, how.radius + 1, constant_values=np.nan)
        stride, k = wide.shape[1], (i + how.radius + 1) * wide.shape[1] + j + how.radius + 1
        way = _carve(wide.ravel().tolist(), stride, k, how, {})
        assert (way is None) == (want == math.inf)
        if way is not None:
            at = [divmod(x, stride) for x in way[0]]
            far = [math.hypot(x[0] - y[0], x[1] - y[1]) if how.shortest else 1.0 for x, y in zip(at[:-1], at[1:], strict=True)]
            cost = sum(max(0.0, wide[x] - (z[i, j] - how.increment * (n + 1))) * d for n, (x, d) in enumerate(zip(at[1:], far, strict=True)))
            assert abs(cost - want) < 1e-9 and {(x - how.radius - 1, y - how.radius - 1): v for (x, y), v in zip(at, way[1], strict=True)} == found[pit]


def test_pits_that_no_way_leaves_are_filled(spark):
    z = np.full((9, 9), 50.0)
    z[4, 4], z[2, 2], z[0, 2] = 10.0, 30.0, 5.0
    out = {(x["r"], x["c"]): x["out"] for x in breach_and_fill(frame(spark, z), spark.createDataFrame([(1, 4, 4), (2, 2, 2)], "pit long, r long, c long"), 9, Carving(2, least_cost=True)).collect()}
    assert out[4, 4] == 50.0 and out[2, 2] == 30.0 and 30.0 in (out[1, 1], out[1, 2], out[1, 3]) and out[0, 2] == 5.0 and out[8, 8] == 50.0


def test_raised_heights_count_for_their_pit_alone(spark):
    z = np.full((3, 12), 50.0)
    z[1, 1:11] = [20, 25, 30, 10, 50, 20, 25, 30, 10, 50]
    bottoms = spark.createDataFrame([(1, 1, 1), (2, 1, 6)], "pit long, r long, c long")
    raised = spark.createDataFrame([(1, 1, 3, 45.0)], "pit long, r long, c long, level double")
    found = {(x["pit"], x["c"]): x["value"] for x in breach_depressions(frame(spark, z), bottoms, 3, 12.0, raised, side=4).collect()}
    assert {k[0] for k in found} == {2} and found[2, 6] == 20.0 and found[2, 9] == 10.0


def test_flats_rise_from_their_outlets_across_tiles(spark):
    z = np.repeat(np.arange(4), 6)[:, None] * 10.0 + np.zeros((24, 21))
    z[8:10, 3:18] = 35.0
    z[14, 2:19], z[13:20, 5] = 10.0, 10.0
    want, todo = {}, deque()
    for i in range(24):
        for j in range(21):
            if any(not (0 <= i + a < 24 and 0 <= j + b < 21) or z[i + a, j + b] < z[i, j] for a, b in EIGHT):
                want[i, j] = 0
                todo.append((i, j))
    while todo:
        i, j = todo.popleft()
        for a, b in EIGHT:
            x = i + a, j + b
            if 0 <= x[0] < 24 and 0 <= x[1] < 21 and x not in want and z[x] == z[i, j]:
                want[x] = want[i, j] + 1
                todo.append(x)
    out = fix_flats(frame(spark, z), "z", 0.25, 21, side=5)
    assert {(x["r"], x["c"]): x["out"] for x in out.collect()} == {(i, j): z[i, j] + 0.25 * want.get((i, j), 0) for i in range(24) for j in range(21)}
    assert fix_flats(frame(spark, z).where(F.lit(False)), "z", 0.25, 21).collect() == []
