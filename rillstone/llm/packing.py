"""Packing of documents into fixed-length token sequences by first-fit decreasing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.chunks import texts_of
from rillstone.llm.encode import encoder

GROUP_BYTES = 8 << 20


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item (0 < size <= capacity): largest first, each into the first bin that has room.

    The bins' free room is kept in a tournament tree whose inner nodes hold the larger of their
    two children, so the first bin with enough room is found by one walk from the root.
    """
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1
    while leaves < n:
        leaves *= 2
    room = [capacity] * (2 * leaves)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most length tokens.

    A document is its text's ids and end_id (a null or empty text: end_id alone); it is cut every
    length tokens.  Documents are dealt to groups by a hash of their id and their row's place in the input; each group packs
    its pieces on its own by first-fit decreasing, and its last sequences stay partly filled.
    Groups hold about group_bytes of text, whatever the ids, so none grows with the input.
    Returns one row per piece: id_col, start, length, ids (little-endian unsigned 32-bit integers,
    as binary), doc_tokens, sequence_id, offset.  Other columns are ignored.  Rows with equal or
    null ids are documents of their own.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    groups = max(1, -(-(total["b"] + 16 * total["n"]) // group_bytes))
    docs = docs.withColumn("group", F.pmod(F.xxhash64("doc", F.monotonically_increasing_id()), F.lit(groups)))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.sort_by([("doc", "ascending"), ("text", "ascending")])
        ids, starts = encoder(tokenizer_path)(*texts_of(table.column("text")))
        n = table.num_rows
        # the end id goes after each document
        ids, starts = np.insert(ids, starts[1:], end_id), starts + np.arange(n + 1)
        tokens = np.diff(starts)
        pieces = -(-tokens // length)
        doc = np.repeat(np.arange(n), pieces)
        begin = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
        size = np.minimum(length, tokens[doc] - begin)
        bins, offsets = first_fit_decreasing(size, length)
        raw, at = ids.astype("<u4").tobytes(), starts[doc] + begin
        blobs = [raw[4 * a : 4 * b] for a, b in zip(at.tolist(), (at + size).tolist(), strict=True)]
        columns = [table.column("doc").take(pa.array(doc)).combine_chunks(), begin, size, pa.array(blobs, pa.binary()), tokens[doc], (group << 32) + bins, offsets]
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    schema = "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.groupBy("group").applyInArrow(run, schema).withColumnRenamed("doc", id_col)
