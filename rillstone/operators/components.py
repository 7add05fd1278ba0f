"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.storage import LIGHT, remove, write_table

#: The node that stands for all that lies outside, less than any other.
OUTSIDE = -1


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the smallest node that each of them reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(rx, ry)[open_], np.minimum(rx, ry)[open_])
        while not np.array_equal(up := root[root], root):
            root = up


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a batch by stars around the smallest node of each local component."""
    for batch in batches:
        if batch.num_rows:
            nodes, root = union_find(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            away = nodes != root
            yield pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(root[away])], names=["u", "v"])


def _whole_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges of a partition; for graphs whose size has been checked."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        nodes, root = union_find(table.column(0).to_numpy(), table.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root)], names=["node", "component"])


def star_components(edges: DataFrame, a: str = "a", b: str = "b", few: int = 0) -> DataFrame:
    """Components of undirected edges: one row (node, component) for each node that has an edge.

    Node ids are longs, component is the smallest node id reachable.  Loops and null ends are
    ignored, repeated edges count once.  Each round's edges are a table in the shared folder;
    the neighbourhood minimum is a combinable aggregate and goes back to the edges by a join
    that adaptive execution may split, so a node of any degree is spread over tasks.  A graph of at
    most few edges, as counted, is solved in one task instead of in rounds.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    now, path = write_table(pairs.mapInArrow(_forest, "u long, v long"), "edges")

    def print_of(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = print_of(now)
    if last[0] <= few:
        whole = now.coalesce(1).mapInArrow(_whole_forest, "node long, component long")
        # its files tell Spark less than its rows take in the driver that would broadcast them
        return whole if last[0] <= LIGHT else whole.hint("merge")
    while last[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # few edges need few files; many keep as many tasks as they have
        files = max(8, last[0] // 200_000)
        large, large_path = write_table(large.coalesce(files), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        before, (now, next_path) = path, write_table(small.coalesce(files), "edges")
        remove(spark, before)
        remove(spark, large_path)
        path, this = next_path, print_of(now)
        if this == last:
            break
        last = this
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    found = now.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.hint("merge") if few else found


def _flood_graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, level) of every node that the outside reaches over all edges of a partition; for graphs whose size has been checked."""
    near: dict[int, list[tuple[float, int]]] = {}
    for batch in batches:
        for a, b, w in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            near.setdefault(a, []).append((w, b))
            near.setdefault(b, []).append((w, a))
    level: dict[int, float] = {}
    heap = [(float("-inf"), OUTSIDE)] if near else []
    while heap:
        v, node = heapq.heappop(heap)
        if node not in level:
            level[node] = v
            for w, other in near[node]:
                if other not in level:
                    heapq.heappush(heap, (max(v, w), other))
    level.pop(OUTSIDE, None)
    yield pa.RecordBatch.from_arrays([pa.array(list(level), pa.int64()), pa.array(list(level.values()), pa.float64())], names=["node", "level"])


def spill_levels(edges: DataFrame, open_: DataFrame, few: int = 0) -> DataFrame:
    """(node, level): the least, over all ways from a node to the outside, of the highest weight on the way.

    edges has a, b, w (undirected), open_ has node, w: ways straight out; ids are not negative.  It contracts the
    graph along a minimum spanning forest: in each round every part takes its lowest way out of itself,
    whose weight is the least level that its nodes may have, and parts that meet become one; so rounds
    grow with the logarithm of the nodes.  A part that meets the outside is done.  Levels then go
    back down through the rounds.  A rest of at most few edges is flooded in one task.  Each round's tables lie
    in the shared folder.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("w").cast("double").alias("w"))
    ways = open_.select(F.lit(OUTSIDE).cast("long").alias("a"), F.col("node").alias("b"), F.col("w").cast("double").alias("w"))
    now, path = write_table(pairs.unionByName(ways).groupBy("a", "b").agg(F.min("w").alias("w")), "spill-edges")
    rounds: list[tuple[DataFrame, str]] = []
    n = now.count()
    while n > few:
        ends = now.select(F.col("a").alias("node"), "a", "b", "w").where(F.col("a") != OUTSIDE).unionByName(now.select(F.col("b").alias("node"), "a", "b", "w"))
        # one order of all edges, so that parts meet in pairs or chains and never in a ring
        lowest = ends.groupBy("node").agg(F.min(F.struct("w", "a", "b")).alias("e"))
        lowest, lowest_path = write_table(lowest.select("node", (F.col("e.a") + F.col("e.b") - F.col("node")).alias("to"), "e.w"), "spill-lowest")
        parts, parts_path = write_table(star_components(lowest, "node", "to", few), "spill-parts")
        parts = parts.where(F.col("node") != OUTSIDE).hint("merge")  # as many as there are nodes
        rounds.append(write_table(lowest.join(parts, "node").select("node", F.col("component").alias("part"), "w"), "spill-round"))
        b = parts.select(F.col("node").alias("b"), F.col("component").alias("pb"))
        a = parts.select(F.col("node").alias("a"), F.col("component").alias("pa"))
        # the outside may have very many edges and stays what it is
        mapped = now.join(b, "b")
        inner = mapped.where(F.col("a") != OUTSIDE).join(a, "a").select("pa", "pb", "w")
        mapped = inner.unionByName(mapped.where(F.col("a") == OUTSIDE).select(F.col("a").alias("pa"), "pb", "w")).where("pa <> pb")
        left, next_path = write_table(mapped.groupBy(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).agg(F.min("w").alias("w")), "spill-edges")
        for gone in (path, lowest_path, parts_path):
            remove(spark, gone)
        now, path, n = left, next_path, left.count()
    level, level_path = write_table(now.coalesce(1).mapInArrow(_flood_graph, "node long, level double"), "spill-levels")
    remove(spark, path)
    for step, step_path in reversed(rounds):
        above = level.select(F.col("node").alias("part"), "level").hint("merge")
        level, next_path = write_table(step.join(above, "part", "left").select("node", F.greatest("w", "level").alias("level")), "spill-levels")
        remove(spark, level_path)
        remove(spark, step_path)
        level_path = next_path
    return level
