"""Removal of lines that many documents share, through a sharded minimal perfect hash index.

Every distinct line key is hashed to 128 bits; each shard of hashes gets a minimal perfect hash
function and, at each key's slot, a fingerprint, the number of documents and the last document.
Documents do not join lines: each chunk sends the hashes of its distinct keys to the shards, which
probe their arrays and answer with the keys to drop.
Counts combine before the shuffle, and a shard that very many chunks ask lends its arrays to several
tasks, so no group of rows grows with the number of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.llm.chunks import CHUNK_BYTES, pack, pack_array, per_row, table_of, unpack_array, with_answers
from rillstone.llm.kernels import mix
from rillstone.storage import materialize

GAMMA = 1.5
LEVELS = 40
#: Probes that one task answers from one copy of a shard's arrays.
PROBES = 1 << 18
#: Shards with several copies that are broadcast as (shard, copies); more of them are joined.
SENT = 100_000


class PerfectHash:
    """A minimal perfect hash function over distinct 64-bit keys.

    Level by level, each key left marks a place of a bit array GAMMA times as long as there are
    keys; a place that one key alone marks is its own, other keys go on to the next level.  A key's
    number is the count of owned places before its own.  Keys left after the last level are listed.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.rank = np.cumsum(bits) - bits
        self.owned = int(bits.sum())

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, bits = [], [np.zeros(0, np.int64)]
        for level in range(LEVELS):
            if not len(keys):
                break
            size = int(len(keys) * GAMMA) + 1
            place = cls._place(keys, level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone.astype(np.int64))
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate(bits), np.sort(keys))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for keys that were not built in."""
        out = np.full(len(keys), -1)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = start + self._place(keys[left], level, size)
            hit = self.bits[place] == 1
            out[left[hit]] = self.rank[place[hit]]
            left, start = left[~hit], start + size
        if len(self.rest) and len(left):
            at = np.searchsorted(self.rest, keys[left]).clip(0, len(self.rest) - 1)
            found = self.rest[at] == keys[left]
            out[left[found]] = self.owned + at[found]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes, len(self.rest)], np.int64)
        return pack_array(np.frombuffer(head.tobytes() + self.rest.astype(np.uint64).tobytes() + np.packbits(self.bits.astype(bool)).tobytes(), np.uint8))

    @classmethod
    def load(cls, blob: bytes) -> "PerfectHash":
        raw = unpack_array(blob, np.uint8).tobytes()
        levels = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes = np.frombuffer(raw, np.int64, levels, 8).tolist()
        rest = int(np.frombuffer(raw, np.int64, 1, 8 + 8 * levels)[0])
        at = 16 + 8 * levels
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, -1, at + 8 * rest), count=sum(sizes)).astype(np.int64)
        return cls(sizes, bits, np.frombuffer(raw, np.uint64, rest, at))


def line_keys(text: str | None, min_chars: int) -> Iterator[tuple[bytes, bytes | None]]:
    """Each line of a text as bytes and its key: stripped of ASCII white space, A-Z lower-cased; None if too short."""
    for line in (text or "").encode().split(b"\n"):
        key = line.strip().lower()
        if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
            key = None
        yield line, key


class _ChunkKeys:
    """The distinct keys of a chunk by shard, with how many of its rows hold each and the last of them."""

    def __init__(self, row: dict, id_col: str, text_col: str, shards: int, min_chars: int):
        self.table = table_of(row["payload"])
        self.ids = self.table.column(id_col).to_pylist()
        self.texts = self.table.column(text_col).to_pylist()
        self.lines = [list(line_keys(text, min_chars)) for text in self.texts]
        held: dict[bytes, list[int]] = {}
        for doc, lines in zip(self.ids, self.lines, strict=True):
            for key in {k for _, k in lines if k is not None}:
                x = held.get(key)
                if x is None:
                    held[key] = [1, doc]
                else:
                    x[0] += 1
                    x[1] = max(x[1], doc)
        self.keys = list(held)
        digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in self.keys]), np.uint64).reshape(-1, 2)
        order = np.lexsort((digest[:, 1], digest[:, 0]))
        self.keys = [self.keys[i] for i in order.tolist()]
        self.digest = digest[order]
        found = np.array(list(held.values()), np.int64).reshape(-1, 2)[order]
        self.count, self.last = found[:, 0], found[:, 1]
        self.shard = (self.digest[:, 0] >> np.uint64(40)) % np.uint64(shards)
        self.rows = [np.flatnonzero(self.shard == s) for s in np.unique(self.shard)]

    def probes(self, chunk: int) -> Iterator[tuple]:
        for rows in self.rows:
            yield chunk, int(self.shard[rows[0]]), self.digest[rows].tobytes()


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """The arrays of a shard from its distinct hashes, in slot order."""
    high, mark, count, last, asked = (table.column(c).to_numpy() for c in ("high", "low", "count", "last", "asked"))
    order = np.lexsort((mark.view(np.uint64), high.view(np.uint64)))
    high, mark, count, last = high.view(np.uint64)[order], mark.view(np.uint64)[order], count[order].astype(np.uint32), last[order]
    # two keys that share 64 bits keep one slot each: the second is told apart by its fingerprint
    high = np.where(np.r_[False, high[1:] == high[:-1]], high ^ mark, high)
    function = PerfectHash.build(high)
    slot = function(high)
    arrays = []
    for values in (mark, count, last):
        placed = np.empty_like(values)
        placed[slot] = values
        arrays.append(pack_array(placed))
    return pa.Table.from_pydict({"shard": [key[0].as_py()], "n": [len(high)], "asked": [int(asked.sum())], "function": [function.dump()], "fingerprints": [arrays[0]], "counts": [arrays[1]], "last": [arrays[2]]})


def line_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, chunks: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """The index of all distinct line keys: one row per shard with its function and arrays, in slot order.

    shard, n, asked (chunks that hold a key, summed over keys), function, fingerprints (unsigned 64 bit),
    counts (documents, unsigned 32 bit), last (largest id).
    """
    chunks, shards = (chunks, shards) if chunks is not None else _chunks(docs, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = _ChunkKeys(row, id_col, text_col, shards, min_chars)
                yield pa.RecordBatch.from_pydict({"high": held.digest[:, 0].view(np.int64), "low": held.digest[:, 1].view(np.int64), "count": held.count, "last": held.last})

    counted = chunks.mapInArrow(count, "high long, low long, count long, last long").groupBy("high", "low").agg(F.sum("count").alias("count"), F.max("last").alias("last"), F.count(F.lit(1)).alias("asked"))
    shard = F.shiftrightunsigned("high", 40) % shards
    index = counted.groupBy(shard.alias("shard")).applyInArrow(_build, "shard long, n long, asked long, function binary, fingerprints binary, counts binary, last binary")
    return materialize(index, "line-index")


def _chunks(docs: DataFrame, id_col: str, text_col: str, target: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    chunks, _ = pack(docs, text_col, target)
    size = chunks.agg(F.coalesce(F.sum(F.length("payload")), F.lit(0)).alias("b")).first()["b"]
    return chunks, max(8, int(size >> 21))


def dealt(probes: DataFrame, index: DataFrame, most: int = PROBES) -> tuple[DataFrame, DataFrame]:
    """probes and index with a column part: each shard in as many copies as it takes for about most probes to each."""
    copies = F.ceil(F.col("asked") / most).cast("long")
    several = index.where(F.col("asked") > most).select(F.col("shard").alias("bucket"), copies.alias("_copies"))
    number = several.count()
    if not number:
        return probes.withColumn("part", F.lit(0).cast("long")), index.withColumn("part", F.lit(0).cast("long"))
    probes = probes.join(F.broadcast(several) if number <= SENT else several, "bucket", "left")
    probes = probes.withColumn("part", F.pmod(F.xxhash64("chunk"), F.coalesce("_copies", F.lit(1).cast("long")))).drop("_copies")
    return probes, index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(copies, F.lit(1)) - 1)))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, chunk_bytes: int = CHUNK_BYTES, probes_per_task: int = PROBES) -> DataFrame:
    """docs without the lines whose key at least min_docs documents hold, except in the last of them.

    Lines are cut at newlines (a null or empty text is one empty line).  A key is the line stripped
    of ASCII white space with A-Z lower-cased; keys under min_chars characters drop nothing.  The
    document with the largest id that holds a key keeps all its lines.  Other lines stay as they
    are, joined by newlines.  Adds n_lines (before) and n_dropped; text_col holds what is left, and a
    null text stays null.  Rows count as documents of their own even if they repeat an id, and all
    rows with the largest id keep the line; rows with a null id are returned as they are and count for nothing.
    Other columns are returned as they are; columns named like the two new ones are replaced.
    chunk_bytes and probes_per_task set the size of tasks and do not change the result.
    """
    docs = docs.drop("n_lines", "n_dropped")
    docs = docs.withColumn(id_col, F.col(id_col).cast("long"))
    chunks, shards = _chunks(docs.where(F.col(id_col).isNotNull()), id_col, text_col, chunk_bytes)
    index = line_index(docs, id_col, text_col, min_chars, chunks, shards)

    asking = per_row(lambda row: _ChunkKeys(row, id_col, text_col, shards, min_chars).probes(row["chunk"]), ["chunk", "bucket", "digest"], [pa.int64(), pa.int64(), pa.binary()])
    probes, copies = dealt(chunks.mapInArrow(asking, "chunk long, bucket long, digest binary"), index, probes_per_task)
    answer_schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("often", pa.binary()), ("last", pa.binary())])

    def probe(asked: pa.Table, shard: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and shard.num_rows:
            row = shard.to_pylist()[0]
            function = PerfectHash.load(row["function"])
            marks, counts, last = unpack_array(row["fingerprints"], np.uint64), unpack_array(row["counts"], np.uint32), unpack_array(row["last"], np.int64)
            ends = np.cumsum(pc.binary_length(asked.column("digest")).to_numpy() >> 4)
            digest = np.frombuffer(b"".join(asked.column("digest").to_pylist()), np.uint64).reshape(-1, 2)
            slot = function(digest[:, 0])
            other = (slot < 0) | (marks[slot] != digest[:, 1])
            if other.any():
                again = function(digest[other, 0] ^ digest[other, 1])
                good = (again >= 0) & (marks[again] == digest[other, 1])
                slot[other] = np.where(good, again, -1)
            hit = (slot >= 0) & (counts[slot] >= min_docs)
            for chunk, bucket, often, at in zip(asked.column("chunk").to_pylist(), asked.column("bucket").to_pylist(), np.split(hit, ends[:-1]), np.split(slot, ends[:-1]), strict=True):
                if often.any():
                    out.append((chunk, bucket, np.packbits(often).tobytes(), pack_array(last[at[often]])))
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, answer_schema.types, strict=True)], schema=answer_schema)

    answers = probes.groupBy("bucket", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(probe, "chunk long, bucket long, often binary, last binary")
    known = with_answers(chunks, answers, ["bucket", "often", "last"])
    names = list(docs.columns)
    out_schema = StructType([*docs.schema.fields]).add("n_lines", "long").add("n_dropped", "long")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = _ChunkKeys(row, id_col, text_col, shards, min_chars)
                by_shard, drop = {a["bucket"]: a for a in row["answers"] or []}, {}
                for rows in held.rows:
                    if answer := by_shard.get(int(held.shard[rows[0]])):
                        often = np.unpackbits(np.frombuffer(answer["often"], np.uint8), count=len(rows)).astype(bool)
                        drop |= zip([held.keys[i] for i in rows[often].tolist()], unpack_array(answer["last"], np.int64).tolist(), strict=True)
                texts, n_lines, n_dropped = [], [], []
                for doc, text, lines in zip(held.ids, held.texts, held.lines, strict=True):
                    kept = [line for line, key in lines if drop.get(key, doc) == doc] if drop else [line for line, _ in lines]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                    texts.append(None if text is None else b"\n".join(kept).decode())
                columns = [pa.array(texts, pa.string()) if name == text_col else held.table.column(name).combine_chunks() for name in names]
                table = pa.table([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, "n_lines", "n_dropped"])
                yield from table.to_batches(max_chunksize=1000)

    done = known.mapInArrow(apply, out_schema)
    strays = docs.where(F.col(id_col).isNull())
    return done.unionByName(strays.withColumns({"n_lines": F.size(F.split(F.coalesce(text_col, F.lit("")), "\n", -1)).cast("long"), "n_dropped": F.lit(0).cast("long")}))
