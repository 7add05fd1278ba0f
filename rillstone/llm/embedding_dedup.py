"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

A vector's code in a table is the signs of its products with the table's hyperplanes.  Vectors
that share a code in a table meet first as sketches, their first 256 signs over all tables: those
that differ from every other by more than a linked pair may stay behind.  The rest are compared
exactly, as matrices; a pair counts in the first table that holds it together.  Buckets beyond a
block's size are cut into blocks and compared block by block, so no pair is lost and no task or
message grows with a bucket.  Equal vectors are one class with a count before anything is compared, so
a group of copies costs no more than a single vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rillstone.llm.near_dup import _groups
from rillstone.operators.components import star_components, union_find
from rillstone.storage import materialize, remove, write_table

TABLES, BITS = 32, 12
#: Signs of a sketch, and how many standard deviations of differing signs a linked pair is granted.
SKETCH, GRANTED = 256, 5.0
#: Rows of a bucket up to which many buckets are sifted at once.
FEW = 64


def usual_length(vectors: DataFrame, vector_col: str) -> int:
    """The most frequent length of the table's vectors, ties to the smaller; 0 without any."""
    sizes = vectors.select(F.size(vector_col).alias("size")).where("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), "size").first()
    return first["size"] if first else 0


def vectors_of(column: pa.Array | pa.ChunkedArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of dim finite numbers, and those vectors in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ok = (size > 0) & (size == dim)
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros((0, dim))
    rows = np.flatnonzero(ok)
    values = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = np.isfinite(values).all(1)
    return rows[good], values[good]


def _units(values: np.ndarray) -> np.ndarray:
    """Vectors of length 1; a vector of zeros stays one."""
    scale = np.abs(values).max(1, keepdims=True)
    values = values / np.where(scale > 0, scale, 1)
    norm = np.linalg.norm(values, axis=1, keepdims=True)
    return values / np.where(norm > 0, norm, 1)


def _signs(units: np.ndarray, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's code in each table, and its sketch as 64-bit words."""
    planes = np.random.default_rng(31).standard_normal((units.shape[1], tables * bits))
    signs = units @ planes > 0
    codes = (signs.reshape(-1, tables, bits) @ (1 << np.arange(bits))).astype(np.uint16)
    sketch = np.zeros((len(units), SKETCH), bool)
    sketch[:, : min(SKETCH, tables * bits)] = signs[:, :SKETCH]
    return codes, np.packbits(sketch, axis=1).view(np.int64)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The same rows in tables that end where a group of equal first keys columns ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        cut = int(change[-1]) if len(change) else 0
        if held and (cut or any(held[-1].column(k)[-1].as_py() != columns[k][0] for k in range(keys))):
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, tables: int = TABLES, bits: int = BITS, block: int = 1024
) -> DataFrame:
    """One row per row of vectors: id_col, n_links, component_id, kept.

    Vectors with a cosine of at least cosine (in double precision) are linked if they share a code in
    one of the tables; none below it are.  At a cosine of 0.9 a pair is missed with probability
    0.004 with the defaults, at 0.95 with 6e-6; its sketches differ by too much with less than 1e-6.
    n_links counts the vectors linked directly; component_id is the smallest id reachable; kept tells
    whether that is the row's own.  Vectors that are null, zero, or hold null or non-finite
    components, or have another length than the table's most frequent one, link with nothing.  Rows
    that repeat an id count as vectors of their own and share their id's row results; a null id is
    returned with no links and takes no part.  Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    dim = usual_length(rows, "vector")
    # vectors travel as they are stored; cosines are taken in double precision
    stored = np.float32 if isinstance(rows.schema["vector"].dataType.elementType, FloatType) else np.float64
    differ = math.acos(cosine) / math.pi
    seen = min(SKETCH, tables * bits)
    limit = seen * differ + GRANTED * math.sqrt(seen * differ * (1 - differ)) + 1

    words = [f"s{k}" for k in range(SKETCH // 64)]

    def take_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = vectors_of(batch.column(1), dim)
            ids = batch.column(0).take(pa.array(at))
            here = ids.is_valid().to_numpy(zero_copy_only=False) & (values != 0).any(1) if len(at) else np.zeros(0, bool)
            if here.any():
                # adding 0 makes one zero of 0 and -0
                raw = pa.array([x.tobytes() for x in values[here].astype(stored) + stored(0)], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.filter(pa.array(here)), raw], names=["id", "raw"])

    def hash_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), stored).astype(np.float64).reshape(batch.num_rows, -1)
            codes, sketch = _signs(_units(values), tables, bits)
            places = codes.astype(np.int32) + (np.arange(tables, dtype=np.int32) << 16)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * tables), pa.array(places.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *(pa.array(np.ascontiguousarray(x)) for x in sketch.T)], names=["id", "rows", "raw", "places", *words])

    taken, taken_path = write_table(rows.mapInArrow(take_rows, "id long, raw binary"), "vectors")
    # a class of equal vectors goes by its least id and counts its rows
    classes = taken.groupBy("raw").agg(F.min("id").alias("id"), F.count("*").alias("rows")).select("id", "rows", "raw")
    hashed = classes.mapInArrow(hash_classes, f"id long, rows long, raw binary, places array<int>, {' long, '.join(words)} long").withColumn("copy", F.monotonically_increasing_id())
    hashed, hashed_path = write_table(hashed, "hashed")
    keys = hashed.select("copy", *words, F.explode("places").alias("place"))
    large = keys.groupBy("place").agg(F.count("*").alias("m")).where(F.col("m") > block)
    parts = F.coalesce(F.ceil(F.col("m") / block), F.lit(1)).cast("int")
    dealt = keys.join(large, "place", "left").withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("copy"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = F.least("mine", "other").cast("long") * (1 << 31) + F.greatest("mine", "other")
    dealt = dealt.select("place", both.alias("pq"), "mine", "copy", *words)

    def sides(table: pa.Table) -> tuple[bool, np.ndarray, np.ndarray]:
        """Whether a block meets itself, and the rows of its two sides."""
        p, q = divmod(table.column("pq")[0].as_py(), 1 << 31)
        mine = table.column("mine").to_numpy()
        return p == q, np.flatnonzero(mine == p), np.flatnonzero(mine == q)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 2):
            place, pq, mine = (table.column(c).to_numpy() for c in ("place", "pq", "mine"))
            sketch = [table.column(c).to_numpy().view(np.uint64) for c in words]
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (pq[1:] != pq[:-1])])
            size = np.diff(np.append(first, len(place)))
            keep = np.zeros(len(place), bool)
            # buckets of few rows, all at once: each row and the one d places behind it
            few = np.flatnonzero((size <= FEW) & (pq[first] == 0))
            for d in range(1, int(size[few].max(initial=1))):
                long = few[size[few] > d]
                count = size[long] - d
                ends = np.cumsum(count)
                i = np.repeat(first[long] - (ends - count), count) + np.arange(ends[-1])
                hit = i[sum(np.bitwise_count(w[i] ^ w[i + d]).astype(np.uint16) for w in sketch) <= limit]
                keep[hit] = keep[hit + d] = True
            for g in np.flatnonzero((size > FEW) | (pq[first] != 0)).tolist():
                rows_ = np.arange(first[g], first[g] + size[g])
                p, q = divmod(int(pq[first[g]]), 1 << 31)
                left, right = rows_[mine[rows_] == p], rows_[mine[rows_] == q]
                near = sum(np.bitwise_count(w[left][:, None] ^ w[right][None, :]).astype(np.uint16) for w in sketch) <= limit if len(left) and len(right) else np.zeros((len(left), len(right)), bool)
                if p == q:
                    np.fill_diagonal(near, False)
                keep[left[near.any(1)]] = True
                keep[right[near.any(0)]] = True
            if keep.any():
                yield from table.select(["place", "pq", "mine", "copy"]).filter(pa.array(keep)).combine_chunks().to_batches()

    sifted = dealt.repartition("place", "pq").sortWithinPartitions("place", "pq").mapInArrow(sift, "place int, pq long, mine int, copy long")
    full = sifted.join(hashed.select("copy", "id", "rows", "places", "raw"), "copy").select("place", "pq", "mine", "copy", "id", "rows", "places", "raw")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 2):
            itself, left, right = sides(table)
            if not len(left) or not len(right):
                continue
            t, ids, copies, held = table.column("place")[0].as_py() >> 16, *(table.column(c).to_numpy() for c in ("id", "copy", "rows"))
            unit = _units(np.frombuffer(b"".join(table.column("raw").to_pylist()), stored).astype(np.float64).reshape(len(ids), -1))
            a, b = np.nonzero(unit[left] @ unit[right].T >= cosine)
            a, b = left[a], right[b]
            keep = copies[a] < copies[b] if itself else slice(None)
            a, b = a[keep], b[keep]
            if t and len(a):
                codes = pc.list_flatten(table.column("places").combine_chunks()).to_numpy().reshape(len(ids), -1)[:, :t]
                first = ~(codes[a] == codes[b]).any(1)
                a, b = a[first], b[first]
            if not len(a):
                continue
            links = np.bincount(np.concatenate([a, b]), held[np.concatenate([b, a])], len(ids)).astype(np.int64)
            node, root = union_find(ids[a], ids[b])
            away, linked = node != root, np.flatnonzero(links)
            u, v = np.concatenate([node[away], ids[linked]]), np.concatenate([root[away], ids[linked]])
            copy = np.concatenate([np.full(int(away.sum()), -1), copies[linked]])
            n = np.concatenate([np.zeros(int(away.sum()), np.int64), links[linked]])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(copy), pa.array(n)], names=["u", "v", "copy", "n"])

    found = full.repartition("place", "pq").sortWithinPartitions("place", "pq").mapInArrow(compare, "u long, v long, copy long, n long")
    found = materialize(found, "vector-links")
    linked = found.where("copy >= 0").groupBy("copy").agg(F.sum("n").alias("n"))
    # a row links with the other rows of its class and with all rows of the classes that its class links with
    classes = hashed.join(linked, "copy", "left").select("raw", F.col("id").alias("first"), (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n"))
    members = materialize(taken.join(classes, "raw").select("id", "first", "n"), "vector-classes")
    for path in (hashed_path, taken_path):
        remove(vectors.sparkSession, path)
    equal = members.where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v")).distinct()
    component = star_components(found.where("copy < 0").select("u", "v").unionByName(equal), "u", "v")
    links = members.groupBy("id").agg(F.max("n").alias("n_links"))
    out = rows.select("id").join(links, "id", "left").join(component.withColumnRenamed("node", "id"), "id", "left")
    own = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"))
