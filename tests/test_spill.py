"""Levels at which a graph and a surface spill, against floods by a heap."""

import heapq
import random

import numpy as np
import pytest

from rillstone.operators.components import OUTSIDE, spill_levels, star_components
from rillstone.operators.depressions import fill_depressions


def plain_levels(edges, ways):
    near = {}
    for a, b, w in [*edges, *((OUTSIDE, n, w) for n, w in ways)]:
        near.setdefault(a, []).append((w, b))
        near.setdefault(b, []).append((w, a))
    level, heap = {}, [(float("-inf"), OUTSIDE)]
    while heap:
        v, n = heapq.heappop(heap)
        if n not in level:
            level[n] = v
            for w, m in near.get(n, []):
                heapq.heappush(heap, (max(v, w), m))
    level.pop(OUTSIDE)
    return level


@pytest.mark.parametrize("few", [0, 20, 10_000])
def test_spill_levels_equal_those_of_a_heap(spark, few):
    rng = random.Random(few)
    # a long chain, a comb and a tangle, with many equal weights and repeated edges
    edges = [(i, i + 1, float(rng.randint(1, 9))) for i in range(80)]
    edges += [(100 + i, rng.randint(0, 79), float(rng.randint(1, 6))) for i in range(40)]
    edges += [(rng.randint(0, 60), rng.randint(0, 60), float(rng.randint(5, 20))) for _ in range(60)] + edges[:5]
    ways = [(0, 7.0), (40, 2.0), (120, 1.0), (120, 3.0)]
    out = spill_levels(spark.createDataFrame([e for e in edges if e[0] != e[1]] + [(5, 5, 0.0)], "a long, b long, w double"), spark.createDataFrame(ways, "node long, w double"), few)
    assert {r["node"]: r["level"] for r in out.collect()} == plain_levels([e for e in edges if e[0] != e[1]], ways)


def test_spill_levels_without_edges(spark):
    none = spark.createDataFrame([], "a long, b long, w double")
    assert [tuple(r) for r in spill_levels(none, spark.createDataFrame([(3, 2.5)], "node long, w double")).collect()] == [(3, 2.5)]
    assert spill_levels(none, spark.createDataFrame([], "node long, w double")).collect() == []


@pytest.mark.parametrize("few", [0, 500_000])
def test_fill_by_blocks_equals_one_flood(spark, few):
    rng = np.random.default_rng(9)
    z = rng.integers(0, 50, (40, 31)).astype(float)
    z[10:14, 5:9] = np.nan
    z[20:30, 10:25] = 0
    cells = [(i, j, None if np.isnan(z[i, j]) else float(z[i, j])) for i in range(40) for j in range(31)]
    level, heap, done = {}, [], set()
    for i, j, v in cells:
        ring = [(a, b) for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1)]
        if v is not None and any(not (0 <= a < 40 and 0 <= b < 31) or np.isnan(z[a, b]) for a, b in ring):
            heap.append((v, i, j))
    heapq.heapify(heap)
    while heap:
        v, i, j = heapq.heappop(heap)
        if (i, j) in done:
            continue
        done.add((i, j))
        level[i, j] = v
        for a in (i - 1, i, i + 1):
            for b in (j - 1, j, j + 1):
                if 0 <= a < 40 and 0 <= b < 31 and not np.isnan(z[a, b]) and (a, b) not in done:
                    heapq.heappush(heap, (max(v, z[a, b]), a, b))
    out = fill_depressions(spark.createDataFrame(cells, "r long, c long, z double"), "z", 31, block=8, few=few)
    assert {(r["r"], r["c"]): r["filled"] for r in out.collect() if r["z"] is not None} == level


def test_components_of_few_edges_equal_those_of_rounds(spark):
    rng = random.Random(1)
    edges = spark.createDataFrame([(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(60)] + [(5, 5), (None, 3)], "a long, b long").repartition(5)
    rounds, one = ({tuple(r) for r in star_components(edges, few=few).collect()} for few in (0, 1000))
    assert rounds == one and rounds
