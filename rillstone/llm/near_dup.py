"""Near-duplicate documents by SetSketch registers over word shingles.

Each document's set of shingles is sketched into registers: exponentially spaced, truncated minima
of exponential variates, which merge by maximum and agree more often the more alike two sets are.
Bands of registers give candidates; the similarity of a candidate pair is estimated from all
registers by maximum likelihood; pairs that may reach the threshold are compared on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.chunks import texts_of
from rillstone.llm.kernels import blocks, mix, shingles
from rillstone.operators.components import star_components
from rillstone.storage import materialize

#: Sketch parameters: base of the spacing, rate of the exponential variates.
BASE, RATE = 1.02, 20.0
#: All registers serve the estimate, the first BANDS * BAND_WIDTH of them the candidates.
REGISTERS, BANDS, BAND_WIDTH = 512, 32, 4
#: A pair is compared in full if its estimate is at most this much below the threshold (four standard errors).
SLACK = 0.08
#: Pairs whose share of equal registers is this much lower still are not estimated at all.
ROUGH = 0.1
#: Pairs of one document that a task compares.
SHARE = 512
#: Slots into which the pairs of one document fall while they are counted.
SLOTS = 1024
_SEEDS = np.random.default_rng(4242).integers(0, 1 << 32, 1024, dtype=np.uint32)


def sketches(hashes: np.ndarray, owner: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers (n x registers, unsigned 16 bit) of n sets given as hashes sorted by owner; an empty set has zeros."""
    out = np.zeros((n, registers), np.uint16)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    ends = np.searchsorted(owner, np.arange(n + 1))
    for i, j in blocks(ends, 1 << 16):
        h = short[ends[i] : ends[j]]
        full = i + np.flatnonzero(np.diff(ends[i : j + 1]))
        if not len(full):
            continue
        at = ends[full] - ends[i]
        least = np.empty((len(full), registers), np.uint32)
        for k in range(registers):
            z = h ^ _SEEDS[k]
            z *= np.uint32(0x85EBCA6B)
            z ^= z >> np.uint32(15)
            z *= np.uint32(0xC2B2AE35)
            z ^= z >> np.uint32(13)
            least[:, k] = np.minimum.reduceat(z, at)
        x = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
        out[full] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535)
    return out


def likelihood_similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches whose sets' sizes are known."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    best, value = np.zeros(len(u)), np.full(len(u), -np.inf)
    for step in np.linspace(0, 1, 101):
        j = top * step
        gt, lt = p(u - v * j).clip(1e-12), p(v - u * j).clip(1e-12)
        total = more * np.log(gt) + less * np.log(lt) + same * np.log((1 - gt - lt).clip(1e-12))
        better = total > value
        best[better], value[better] = j[better], total[better]
    return best


def _sketch_rows(width: int, registers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts_of(batch.column(1))
            for i, j in blocks(starts, 2 << 20):
                h, owner = shingles(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], width)
                n = j - i
                size = np.bincount(owner, minlength=n)
                sums = np.zeros((2, n), np.uint64)
                if len(h):
                    full = np.flatnonzero(size)
                    at = np.searchsorted(owner, full)
                    sums[0, full] = np.add.reduceat(mix(h + np.uint64(1)), at)
                    sums[1, full] = np.add.reduceat(mix(h + np.uint64(2)), at)
                sketch = sketches(h, owner, n, registers)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(size), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array([x.tobytes() for x in sketch], pa.binary())],
                    names=["doc", "n", "f1", "f2", "sketch"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows that share their first keys columns, in batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        if last == tuple(c[0] for c in columns):
            new[0] = False
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        if cuts[0]:
            held.append(batch.slice(0, cuts[0]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(a, b - a)]
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _sketch_matrix(column: pa.ChunkedArray | pa.Array, registers: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, registers)


def _with_both(pairs: DataFrame, table: DataFrame, key: str, columns: list[str], share: int = SHARE) -> DataFrame:
    """(a, b) with the columns of a's row in table (prefixed a_) and of b's (b_).

    The pairs of one a are dealt into parts of about share, each with a copy of a's row, so that no
    task meets all pairs of a document that very many others are compared with.  How many parts an a
    has is learnt from counts by (a, slot), and comes back to its pairs by both.
    """
    dealt = pairs.withColumn("slot", F.pmod(F.xxhash64("b"), F.lit(SLOTS)).cast("int"))
    counts = dealt.groupBy("a", "slot").agg(F.count("*").alias("n"))
    parts = counts.groupBy("a").agg(F.ceil(F.sum("n") / share).cast("int").alias("parts"))
    right = dealt.join(counts.join(parts, "a").select("a", "slot", "parts"), ["a", "slot"])
    right = right.withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).drop("slot", "parts")
    right = right.join(table.select(F.col(key).alias("b"), *[F.col(c).alias(f"b_{c}") for c in columns]), "b")
    left = table.select(F.col(key).alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns]).join(parts, "a")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return right.join(left, ["a", "part"]).select("a", "b", *[f"{s}_{c}" for c in columns for s in ("a", "b")])


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    both = _with_both(materialize(pairs, "pairs"), texts, "doc", ["text"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 500):
                batch = big.slice(k, 500)
                # a document that many pairs share is shingled once a batch
                left, number = np.unique(batch.column(0).to_numpy(), return_inverse=True)
                some = np.zeros(len(left), np.int64)
                some[number] = np.arange(batch.num_rows)
                h, owner = shingles(*texts_of(batch.column(2).take(pa.array(some))), width)
                g, mine = shingles(*texts_of(batch.column(3)), width)
                size_a, size_b = np.bincount(owner, minlength=len(left))[number], np.bincount(mine, minlength=batch.num_rows)
                at = np.searchsorted(owner, np.arange(len(left) + 1))
                ends = np.searchsorted(mine, np.arange(batch.num_rows + 1))
                common = np.array([np.isin(g[ends[i] : ends[i + 1]], h[at[c] : at[c + 1]], assume_unique=True).sum() for i, c in enumerate(number.tolist())])
                ok = (100 * common >= percent * (size_a + size_b - common)) & (common > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    return both.mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.75, registers: int = REGISTERS, bands: int = BANDS, band_width: int = BAND_WIDTH, block: int = 256
) -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of width words (A-Z lower-cased, cut at ASCII white
    space); with fewer words, its whole sequence; without words or text it is empty and linked with
    nothing.  Documents whose sets' Jaccard similarity is at least similarity (a whole number of
    hundredths) are linked; component_id is the smallest id reachable; kept tells whether that is
    the document itself.  Equal sets are one node from the start.  Candidates share a band; within a
    band every member is first compared with the smallest, then all members that are still in
    different components with one another, in blocks of bounded size, so no pair of a band is lost.
    Rows that repeat an id are one document.  Null ids take no part (component_id null, kept true).
    Other columns are ignored.  With the defaults a pair at the threshold misses every band with
    probability 6e-6.
    """
    percent = round(100 * similarity)
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    sketched = materialize(docs.mapInArrow(_sketch_rows(width, registers), "doc long, n long, f1 long, f2 long, sketch binary"), "sketches")
    nodes = sketched.where("n > 0 and doc is not null").groupBy("f1", "f2", "n").agg(F.min("doc").alias("rep"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes, "nodes")
    texts = docs.where(F.col("doc").isNotNull() & F.col("text").isNotNull())

    size = 2 * band_width
    keys = F.array(*[F.xxhash64(F.expr(f"substring(sketch, {k * size + 1}, {size})"), F.lit(k)) for k in range(bands)])
    banded = nodes.select("rep", F.posexplode(keys).alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("leader")).where("m > 1")
    members = materialize(banded.join(shared, "key"), "members")

    wanted = ["rep", "n", "sketch"]

    def likely(pairs: DataFrame) -> DataFrame:
        full = _with_both(pairs, nodes, "rep", ["n", "sketch"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    estimate = likelihood_similarity(_sketch_matrix(batch.column(4), registers), _sketch_matrix(batch.column(5), registers), batch.column(2).to_numpy(), batch.column(3).to_numpy())
                    ok = pa.array(estimate >= similarity - SLACK)
                    yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

        return full.mapInArrow(run, "a long, b long")

    stars = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    stars = materialize(stars, "stars")
    links = materialize(_verified(likely(stars), texts, width, percent), "links")
    component = star_components(links)

    # bands whose members are not yet in one component: compare all of them across components
    labelled = members.join(component.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m")).where("lo <> hi").select("key", "m")
    open_ = labelled.drop("m").join(mixed, "key").join(nodes.select(*wanted), "rep")
    parts = F.ceil(F.col("m") / block).cast("int")
    open_ = open_.withColumn("mine", F.pmod(F.xxhash64("rep"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    open_ = open_.select("key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "band", "rep", "component", "leader", "n", "sketch")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            p, q, band = (table.column(c)[0].as_py() for c in ("p", "q", "band"))
            part, rep, label, n = (table.column(c).to_numpy() for c in ("mine", "rep", "component", "n"))
            sketch, leader = _sketch_matrix(table.column("sketch"), registers), table.column("leader")[0].as_py()
            a, b = [], []
            for i in np.flatnonzero(part == p).tolist():
                others = np.flatnonzero((label != label[i]) & (rep != leader) & (rep > rep[i] if p == q else part == q))
                if rep[i] != leader and len(others):
                    like = others[(sketch[others] == sketch[i]).mean(1) >= similarity - SLACK - ROUGH]
                    a.append(np.full(len(like), i))
                    b.append(like)
            a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (a, b))
            if band and len(a):
                # a pair belongs to the first band that it shares
                before = (sketch[a, : band * band_width] == sketch[b, : band * band_width]).reshape(len(a), band, band_width)
                first = ~before.all(2).any(1)
                a, b = a[first], b[first]
            if len(a):
                ok = likelihood_similarity(sketch[a], sketch[b], n[a], n[b]) >= similarity - SLACK
                a, b = rep[a[ok]], rep[b[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    more = open_.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(across, "a long, b long")
    late = materialize(_verified(more.join(stars, ["a", "b"], "left_anti"), texts, width, percent), "late-links")
    if late.first() is not None:
        component = star_components(links.unionByName(late))

    home = nodes.join(component.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = sketched.join(home, ["f1", "f2", "n"], "left")
    found = F.when(F.col("doc").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc"))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), found.cast("long").alias("component_id"), F.coalesce(found == F.col("doc"), F.lit(True)).alias("kept"))
