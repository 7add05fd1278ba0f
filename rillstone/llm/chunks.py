"""Chunks: rows of a table packed into compressed blobs of a few MB of text.

Operators that compare all documents work in three steps: each chunk reduces what it holds to
short messages for buckets (pre-aggregated within the chunk), each bucket reduces its messages
and answers every chunk that wrote to it, and each chunk applies the answers to its own rows.
Text itself is moved at most once per step and only compressed.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.storage import materialize, write_table

CHUNK_SCHEMA = "chunk long, n long, payload binary"
CHUNK_BYTES = 4 << 20
#: Chunks whose messages a bucket takes as they are; those of more are merged first.
FAN = 1 << 14


def pack_array(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(values).tobytes())


def unpack_array(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def table_of(payload: bytes) -> pa.Table:
    """The rows that a chunk holds."""
    return pa.ipc.open_stream(payload).read_all()


def _payload(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table.combine_chunks())
    return out.getvalue()


def pack(df: DataFrame, size_of: str, target: int = CHUNK_BYTES) -> tuple[DataFrame, str]:
    """Chunks of df's rows (all columns), each with about target bytes of the column size_of.

    Written once to the shared folder, so that chunk numbers stay fixed whatever is lost later;
    returns the table and its path.
    """
    at = df.columns.index(size_of)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k, base = [], 0, 0, TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array([base + k]), pa.array([table.num_rows]), pa.array([_payload(table)], pa.binary())], names=["chunk", "n", "payload"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + target - size, "right")))
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1] - before)
                start = stop
                if size >= target or start < batch.num_rows:
                    yield out()
                    held, size, k = [], 0, k + 1
        if held:
            yield out()

    return write_table(df.mapInArrow(chunks, CHUNK_SCHEMA), "chunks", row_group_bytes=8 << 20)


def texts_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end and the n + 1 places where they start; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None and starts[-1] else np.zeros(0, np.uint8)
    return data, starts - starts[0]


def with_answers(chunks: DataFrame, answers: DataFrame | None, columns: list[str]) -> DataFrame:
    """Each chunk with the list of its answers (structs of columns, at most one for each bucket that it wrote to).

    A chunk writes at most as many messages as it holds keys, so its size bounds the list.
    """
    gathered = answers.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias("answers"))
    return chunks.join(gathered, "chunk", "left")


def per_row(fn: Callable[[dict], Iterator[tuple]], names: list[str], kinds: list[pa.DataType]) -> Callable:
    """A mapInArrow function that calls fn on each row and returns the rows that it yields."""
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                rows = list(fn(row))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)

    return run


class Exchange(NamedTuple):
    """What buckets do with messages (chunk, bucket, fields) and answer with rows (chunk, bucket, results); all fields by name and type.

    answer(bucket, messages) yields the answers; merge(bucket, messages) gives the fields of one message that stands for
    all of them; spread(bucket, messages, found) yields their answers from the one to that message (None: no answer).
    merge and spread get messages in order of their chunks.
    """

    fields: list[tuple[str, str, pa.DataType]]
    results: list[tuple[str, str, pa.DataType]]
    answer: Callable[[int, list[dict]], Iterator[tuple]]
    merge: Callable[[int, list[dict]], tuple]
    spread: Callable[[int, list[dict], dict | None], Iterator[tuple]]

    @staticmethod
    def schemas(columns: list[tuple[str, str, pa.DataType]]) -> tuple[str, pa.Schema]:
        columns = [("chunk", "long", pa.int64()), ("bucket", "long", pa.int64()), *columns]
        return ", ".join(f"{n} {t}" for n, t, _ in columns), pa.schema([(n, k) for n, _, k in columns])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def exchange(messages: DataFrame, number: int, work: Exchange, fan: int = FAN) -> DataFrame:
    """The buckets' answers to the messages of number chunks.

    Of more than fan chunks, messages of about fan chunks to a bucket merge into one first, level by
    level, and answers come back the same way: no group has many more than fan rows, and what many chunks
    send alike is held once.  The answers are the same.
    """
    text, out = work.schemas(work.results)
    if number <= fan:
        return messages.groupBy("bucket").applyInArrow(lambda key, table: _table(list(work.answer(key[0].as_py(), table.to_pylist())), out), text)
    parts = -(-number // fan)
    messages = materialize(messages.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts))), "messages", row_group_bytes=8 << 20)
    merged_text, merged_out = work.schemas(work.fields)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return _table([(key[1].as_py(), key[0].as_py(), *work.merge(key[0].as_py(), table.sort_by("chunk").to_pylist()))], merged_out)

    def spread(asked: pa.Table, found: pa.Table) -> pa.Table:
        rows = asked.sort_by("chunk").to_pylist()
        return _table(list(work.spread(rows[0]["bucket"], rows, (found.to_pylist() or [None])[0])) if rows else [], out)

    merged = messages.groupBy("bucket", "part").applyInArrow(merge, merged_text)
    found = exchange(merged, parts, work, fan)
    return messages.groupBy("bucket", "part").cogroup(found.groupBy("bucket", "chunk")).applyInArrow(spread, text)
