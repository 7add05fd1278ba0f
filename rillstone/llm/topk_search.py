"""Exact top-k inner-product search through a pivot-distance index.

Vectors get one more component, so that all have one length; the largest inner product with a
query is then the smallest distance from it.  Each vector is keyed by its nearest pivot and the
distance from it; the table sorted by that key is cut into parts and those into annuli of few
rows, which also keep the least and largest distance of their rows from some reference pivots.
Pivots grow with the table, as the square root of its rows.  A query visits the part where its own key lies first, and then only the parts of which some
annulus may, by the triangle inequality, hold a score that is not below its k-th best so far.
Within a part it expands annuli in the order of their bounds and stops at the first that is out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.embedding_dedup import usual_length, vectors_of
from rillstone.storage import materialize, remove, write_table

#: Least number of pivots; rows drawn to choose them from, which bounds their number; pivots that every annulus is measured from.
PIVOTS, SAMPLE, REFERENCES = 64, 4096, 8
PART_ROWS, ANNULUS_ROWS, QUERY_ROWS = 4096, 128, 1024
#: What is known of a part's annuli without their rows.
OUTLINE = ("a_pivot", "a_inner", "a_outer", "a_low", "a_high")
#: Relative room left to the bounds for rounding.
ROUNDING = 1e-9


def quantised(batch: pa.RecordBatch, scale: float, dim: int) -> tuple[pa.Array, np.ndarray]:
    """ids and floor(scale * x) of the vectors that take part."""
    at, values = vectors_of(batch.column(1), dim)
    ids = batch.column(0).take(pa.array(at))
    here = ids.is_valid().to_numpy(zero_copy_only=False)
    return ids.filter(pa.array(here)), np.floor(scale * values[here]) if len(here) else values


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered vectors, exact in either arithmetic."""
    if len(a) and len(b) and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best (query, score, id) of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[rank < k], score[rank < k], ids[rank < k]


class _Part:
    """The rows of a part in key order, cut into annuli around one pivot each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivot: np.ndarray, radius: np.ndarray):
        self.ids, self.vectors = ids, vectors
        cut = np.ones(len(ids), bool)
        cut[1:] = pivot[1:] != pivot[:-1]
        run = np.flatnonzero(cut)
        inside = np.arange(len(ids)) - np.repeat(run, np.diff(np.append(run, len(ids))))
        self.first = np.flatnonzero(inside % ANNULUS_ROWS == 0)
        self.stop = np.append(self.first[1:], len(ids))
        self.pivot = pivot[self.first]
        self.inner, self.outer = radius[self.first], radius[self.stop - 1]


def _bounds(to_pivot: np.ndarray, to_reference: np.ndarray, length: np.ndarray, longest2: float, inner: np.ndarray, outer: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product that a row of each annulus can have with each query.

    to_pivot holds the distance from each query to each annulus's pivot, low and high the annuli's
    least and largest distances from the references.
    """
    d = to_pivot
    gap = np.maximum(0, np.maximum(inner[None, :] - d, d - outer[None, :]))
    for k in range(low.shape[1]):
        e = to_reference[:, k, None]
        gap = np.maximum(gap, np.maximum(low[None, :, k] - e, e - high[None, :, k]))
    room = ROUNDING * (length[:, None] ** 2 + longest2 + d**2)
    return (length[:, None] ** 2 + longest2 - gap**2) / 2 + room + 1e-6


class Geometry:
    """Pivots in the space with one more component, and what bounds need of it."""

    def __init__(self, pivots: np.ndarray, longest2: float):
        self.pivots, self.longest2 = pivots, longest2

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.sqrt(np.maximum(0, self.longest2 - (vectors**2).sum(1)))])

    def to_pivots(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(0, square))

    def rows(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.to_pivots(self.lifted(vectors))
        nearest = d.argmin(1)
        exact = np.linalg.norm(self.lifted(vectors) - self.pivots[nearest], axis=1)
        return nearest, exact

    def queries(self, vectors: np.ndarray, pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances from queries to the pivots of annuli and to the references, and the queries' lengths."""
        point = np.column_stack([vectors, np.zeros(len(vectors))])
        used, place = np.unique(pivot, return_inverse=True)
        d = np.stack([np.linalg.norm(point - self.pivots[p], axis=1) for p in used], 1)
        return d[:, place], np.stack([np.linalg.norm(point - p, axis=1) for p in self.references], 1), np.linalg.norm(vectors, axis=1)

    @property
    def references(self) -> np.ndarray:
        return self.pivots[:REFERENCES]

    def to_references(self, vectors: np.ndarray) -> np.ndarray:
        points = self.lifted(vectors)
        return np.stack([np.linalg.norm(points - p, axis=1) for p in self.references], 1)


def top_k_search(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: float = 256.0, pivots: int | None = None, sample: int = SAMPLE, part_rows: int = PART_ROWS,
    compared: Accumulator | None = None,
) -> DataFrame:
    """The k best rows of vectors for each row of queries: query_id, rank (from 1), id_col, score.

    Both tables' vectors are taken as floor(scale * x); the score is their integer inner product, and
    equal scores go to the smaller id.  A row is no answer to the query with its own id.  Vectors
    that are null, hold null or non-finite components or have another length than most of vectors take no
    part, nor do rows with a null id; a query without any candidate returns no row.  Pivots (by default
    as many as the square root of the rows, at least 64) come from
    a sample of at most sample rows; every row is indexed and the result is exact.  Rows that repeat
    an id are candidates of their own; rows of queries that repeat an id are one query, that of the least
    vector by its bytes.  Other columns are ignored.  The result is a table in the shared
    folder; compared, if given, gains the number of inner products taken.
    """
    spark = vectors.sparkSession
    dim = usual_length(vectors, vector_col)

    def take(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, values = quantised(batch, scale, dim)
                if len(ids):
                    yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in values], pa.binary()), pa.array((values**2).sum(1))], names=["id", "v", "square"])

        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col)).mapInArrow(run, "id long, v binary, square double")

    (rows, rows_path), (asked, asked_path) = write_table(take(vectors), "vectors"), write_table(take(queries), "queries")
    known = rows.agg(F.max("square").alias("s"), F.count("*").alias("n")).first()
    schema = f"query_id long, rank int, {id_col} long, score long"
    if not known["n"]:
        return spark.createDataFrame([], schema)
    longest2, n = known["s"] * (1 + 1e-12), known["n"]
    pivots = pivots or max(PIVOTS, math.isqrt(n))
    # a bounded sample: the rows with the least hashes
    drawn = np.stack([np.frombuffer(r["v"]) for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()])
    geometry = Geometry(np.zeros((1, dim + 1)), longest2)
    points = geometry.lifted(drawn)
    chosen = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(pivots, len(points)) and far.max() > 0:  # at most sample rounds over the sample
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(points - points[chosen[-1]], axis=1))
    geometry.pivots = points[chosen]
    for _ in range(4):
        # centres of the sample's cells make tighter annuli than its outermost points
        cell = geometry.to_pivots(points).argmin(1)
        geometry.pivots = np.stack([points[cell == j].mean(0) if (cell == j).any() else old for j, old in enumerate(geometry.pivots)])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest, radius = geometry.rows(np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, dim))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nearest), pa.array(radius)], names=["id", "v", "pivot", "radius"])

    parts = max(1, -(-n // part_rows))
    keyed = rows.mapInArrow(key, "id long, v binary, pivot long, radius double")
    keyed = keyed.repartitionByRange(parts, "pivot", "radius", "id").sortWithinPartitions("pivot", "radius", "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a in range(0, batch.num_rows, part_rows):
                b = batch.slice(a, part_rows)
                pivot, radius, vs = b.column(2).to_numpy(), b.column(3).to_numpy(), b"".join(b.column(1).to_pylist())
                held = _Part(b.column(0).to_numpy(), np.zeros(0), pivot, radius)
                away = geometry.to_references(np.frombuffer(vs).reshape(-1, dim))
                low, high = np.minimum.reduceat(away, held.first), np.maximum.reduceat(away, held.first)
                columns = [(part << 24) + k, b.column(0).to_numpy().tobytes(), vs, pivot.tobytes(), radius.tobytes(), held.pivot.tobytes(), held.inner.tobytes(), held.outer.tobytes(), low.tobytes(), high.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c]) for c in columns], names=["part", "ids", "vs", "pivots", "radii", *OUTLINE])
                k += 1

    kinds = "".join(f", {c} binary" for c in ("ids", "vs", "pivots", "radii", *OUTLINE))
    index, index_path = write_table(keyed.mapInArrow(cut, f"part long{kinds}"), "annuli", row_group_bytes=8 << 20)
    outline = index.select("part", *OUTLINE)

    def bounds(part: dict, v: np.ndarray) -> np.ndarray:
        pivot = np.frombuffer(part["a_pivot"], np.int64)
        to_pivot, to_reference, length = geometry.queries(v, pivot)
        inner, outer, low, high = (np.frombuffer(part[c]) for c in OUTLINE[1:])
        return _bounds(to_pivot, to_reference, length, longest2, inner, outer, low.reshape(len(pivot), -1), high.reshape(len(pivot), -1))

    # queries travel in blocks; stretches of the outline (a row per part) meet every block, not every query
    asked = asked.groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    spans = max(1, parts // 256)
    stretches = outline.groupBy(F.pmod(F.xxhash64("part"), F.lit(spans)).alias("span")).agg(F.collect_list(F.struct("part", *OUTLINE)).alias("parts"))

    def visits(queries: DataFrame, best_only: bool) -> DataFrame:
        """Rows (part, its queries) for each block: each query's most promising part, or all that may reach its floor."""
        in_blocks = queries.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("id", "v", "floor")).alias("q"))
        met = in_blocks.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1)))).join(stretches, "span").select("q", "parts")

        def visit(part: int, ids: np.ndarray, v: np.ndarray, floor: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, v, floor))], names=["part", "qids", "qv", "floor"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = np.array([q["id"] for q in row["q"]])
                    v = np.frombuffer(b"".join([q["v"] for q in row["q"]])).reshape(-1, dim)
                    floor = np.array([-np.inf if q["floor"] is None else q["floor"] for q in row["q"]], float)
                    best, where = np.full(len(ids), -np.inf), np.full(len(ids), -1)
                    for part in row["parts"]:
                        bound = bounds(part, v).max(1)
                        if best_only:
                            better = bound > best
                            best[better], where[better] = bound[better], part["part"]
                        elif (go := np.flatnonzero(bound >= floor)).size:
                            yield visit(part["part"], ids[go], v[go], floor[go])
                    for part in np.unique(where).tolist() if best_only else []:
                        go = np.flatnonzero(where == part)
                        yield visit(part, ids[go], v[go], floor[go])

        return met.mapInArrow(run, "part long, qids binary, qv binary, floor binary")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, v = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vs"]).reshape(-1, dim)
                held = _Part(ids, v, np.frombuffer(row["pivots"], np.int64), np.frombuffer(row["radii"]))
                qids, qv, floor = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["qv"]).reshape(-1, dim), np.frombuffer(row["floor"]).copy()
                bound = bounds(row, qv)
                order = np.argsort(-bound, axis=1, kind="stable")
                query, score, answer = (np.zeros(0, np.int64) for _ in range(3))
                going = np.arange(len(qids))
                for step in range(order.shape[1]):
                    reach = bound[going, order[going, step]]
                    going = going[reach >= floor[going]]
                    if not len(going):
                        break
                    for annulus in np.unique(order[going, step]).tolist():
                        mine = going[order[going, step] == annulus]
                        a, b = held.first[annulus], held.stop[annulus]
                        s = products(qv[mine], v[a:b])
                        if compared is not None:
                            compared.add(s.size)
                        keep = (s >= floor[mine, None]) & (ids[a:b][None, :] != qids[mine, None])
                        i, j = np.nonzero(keep)
                        query, score, answer = np.concatenate([query, mine[i]]), np.concatenate([score, s[i, j]]), np.concatenate([answer, ids[a:b][j]])
                    query, score, answer = _best(query, score, answer, k)
                    full = np.bincount(query, minlength=len(qids)) == k
                    least = np.full(len(qids), np.inf)
                    np.minimum.at(least, query, score)
                    floor[full] = np.maximum(floor[full], least[full])
                yield pa.RecordBatch.from_arrays([pa.array(qids[query]), pa.array(score), pa.array(answer)], names=["query_id", "score", "id"])

    def found(queries: DataFrame, best_only: bool) -> DataFrame:
        hits = visits(queries, best_only).join(index, "part").mapInArrow(search, "query_id long, score long, id long")
        first = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        return hits.withColumn("rank", first).where(F.col("rank") <= k)

    near = found(asked.withColumn("floor", F.lit(None).cast("double")), True)
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    floored, floors_path = write_table(asked.join(floors, "id", "left"), "floors")
    out = materialize(found(floored, False).select("query_id", "rank", F.col("id").alias(id_col), "score"), "top-k")
    for path in (rows_path, asked_path, index_path, floors_path):
        remove(spark, path)
    return out
