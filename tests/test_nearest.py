"""Nearest points and the nearest means of a bias table against plain searches."""

import math
import random

import pytest

from rillstone.operators.bias import bias_slice
from rillstone.operators.spatial import nearest_points


@pytest.mark.parametrize(("k", "few_bins"), [(1, 50_000), (3, 50_000), (3, 0)])
def test_nearest_points_equal_a_plain_search(spark, k, few_bins):
    rng = random.Random(k)
    points = [(i, rng.gauss(0, 2), rng.gauss(0, 2), float(i)) for i in range(150)] + [(200 + i, rng.uniform(-900, 900), rng.uniform(-900, 900), 1.0) for i in range(20)]
    points += [(300 + i, 5.0, 5.0, 2.0) for i in range(4)] + [(400 + i, -8.0 * i, 16.0, 0.0) for i in range(5)]
    queries = [(i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(30)] + [(50, 9000.0, -7000.0), (51, 5.0, 5.0), (52, -16.0, 8.0), (53, 0.0, 0.0)]
    out = nearest_points(spark.createDataFrame(points, "pid long, x double, y double, z double"), spark.createDataFrame(queries, "qid long, x double, y double"), k, 4.0, few_bins=few_bins)
    want = {(q, rank + 1): p for q, x, y in queries for rank, (_, p) in enumerate(sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), p) for p, a, b, _ in points)[:k])}
    assert {(r["qid"], r["rank"]): r["pid"] for r in out.collect()} == want


def test_nearest_points_of_few_and_of_none(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 1e6, 3.0, 6.0)], "pid long, x double, y double, z double")
    queries = spark.createDataFrame([(7, 10.0, 10.0)], "qid long, x double, y double")
    assert [(r["pid"], r["rank"]) for r in nearest_points(points, queries, 9, 2.0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nearest_points(points.where("false"), queries, 3, 2.0).collect() == [] and nearest_points(points, queries.where("false"), 3, 2.0).collect() == []


def test_gaps_of_a_bias_table_take_the_nearest_mean(spark):
    rng = random.Random(6)
    means = {(s, rng.randint(0, 29), rng.randint(0, 11)): float(rng.randint(-50, 50)) for s in (1, 4) for _ in range(9)}
    rows = [(s, t, h, v) for (s, t, h), v in means.items() for _ in range(3)]
    out = bias_slice(spark.createDataFrame(rows, "slope int, tc int, th int, v double"), "v", n_cutoff=2, cover_cutoff=4, covers=30, heights=12)
    near = {}
    for s in (1, 4):
        for t in range(30):
            for h in range(12):
                v = min(((t - a) ** 2 + (h - b) ** 2, a, b, x) for (z, a, b), x in means.items() if z == s)[3]
                near[s, t, h] = 0.0 if t < 4 or h == 0 else v
    for r in out.collect():
        s, t, h = r["slope"], r["tc"], r["th"]
        ring = [near[s, min(max(t + i, 0), 29), min(max(h + j, 0), 11)] * (1.0 if i == j == 0 else 0.5) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert math.isclose(r["bias"], 0.0 if t < 4 or h == 0 else sum(ring) / 5, abs_tol=1e-9)
