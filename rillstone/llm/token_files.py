"""Token ids in binary files of independent zstandard frames.

A file holds data frames, then two skippable frames: an index of documents (ids, token counts
and the first document of each frame) and a seek table in the public seekable format: for each
data frame its compressed size, its decompressed size and the low half of its content's XXH64,
then the number of frames, a descriptor byte (checksums present) and the magic number, which ends
the file.  A reader finds the table at the end, the index behind the last data frame, and
decompresses only the frames that it needs; plain decoders skip both tables.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.chunks import texts_of
from rillstone.llm.encode import encoder
from rillstone.llm.kernels import blocks
from rillstone.storage import materialize, new_path

# Fixed values of the public seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# Our own skippable frame.
SKIPPABLE_INDEX = 0x184D2A50

FRAME_TOKENS = 1 << 16


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    local = re.fullmatch(r"file:/*(/.*)", path)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _qualified(spark: SparkSession, folder: str) -> str:
    """folder with its scheme; one without is resolved as Spark resolves it, not on each executor's own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


class TokenFileWriter:
    """Writes documents one after another; a frame ends with the document that fills it."""

    def __init__(self, path: str, frame_tokens: int = FRAME_TOKENS):
        self.filesystem, self.path = _open(path)
        self.filesystem.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.filesystem.open_output_stream(self.path, compression=None)
        self.frame_tokens, self.held, self.held_tokens = frame_tokens, [], 0
        self.docs, self.counts, self.first_doc, self.table = [], [], [], []
        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if not self.held:
            self.first_doc.append(len(self.docs))
        self.docs.append(doc)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.held_tokens += len(ids)
        if self.held_tokens >= self.frame_tokens:
            self._end_frame()

    def _end_frame(self) -> None:
        raw = np.concatenate(self.held).astype("<u4").tobytes()
        frame = self.zstd.compress(raw)
        self.out.write(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.held_tokens = [], 0

    def close(self) -> int:
        """Write what is left and the two tables; return the number of tokens."""
        if self.held:
            self._end_frame()
        null = np.array([d is None for d in self.docs], np.uint8)
        ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        index = self.zstd.compress(struct.pack("<QQ", len(ids), len(self.first_doc)) + ids.tobytes() + np.array(self.counts, "<i8").tobytes() + np.array(self.first_doc, "<i8").tobytes() + null.tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        rows = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(rows) + len(footer)) + rows + footer)
        self.out.close()
        return sum(self.counts)


class TokenFileReader:
    """Reads single documents, or all of them a frame at a time; checks each frame's checksum."""

    def __init__(self, path: str):
        filesystem, inner = _open(path)
        self.file = filesystem.open_input_file(inner)
        size = self.file.size()
        frames, flag, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9)) if size >= 9 else (0, 0, 0)
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table")
        at = size - 9 - 12 * frames
        self.table = np.frombuffer(self.file.read_at(12 * frames, at), "<u4").reshape(-1, 3)
        self.frame_at = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        index = int(self.frame_at[-1])
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(at - 8 - index - 8, index + 8))
        n, f = struct.unpack("<QQ", raw[:16])
        self.docs = np.frombuffer(raw, "<i8", n, 16)
        self.counts = np.frombuffer(raw, "<i8", n, 16 + 8 * n)
        self.first_doc = np.append(np.frombuffer(raw, "<i8", f, 16 + 16 * n), n)
        self.null = np.frombuffer(raw, np.uint8, n, 16 + 16 * n + 8 * f).astype(bool)

    def frame(self, k: int) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.table[k, 0]), int(self.frame_at[k])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of the file's i-th document; only its frame is decompressed."""
        k = int(np.searchsorted(self.first_doc, i, "right")) - 1
        before = int(self.counts[self.first_doc[k] : i].sum())
        return self.frame(k)[before : before + int(self.counts[i])]

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.table)):
            ids, at = self.frame(k), 0
            for i in range(int(self.first_doc[k]), int(self.first_doc[k + 1])):
                yield None if self.null[i] else int(self.docs[i]), ids[at : at + int(self.counts[i])]
                at += int(self.counts[i])


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, frame_tokens: int = FRAME_TOKENS, partitions: int | None = None
) -> DataFrame:
    """Tokenise docs and write files in ascending order of id_col; return their manifest.

    Each document is its text's ids and end_id (a null or empty text: end_id alone).  Files go to
    folder, by default one in the shared folder; every attempt of a task writes a file of its own,
    and the manifest, itself a table in the shared folder, names those that count: part (in order),
    path, n_docs, n_tokens, start (tokens in all files before).  Null ids come first; rows with
    equal ids are ordered by a hash of the text.  An empty table gives an empty manifest.  Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = _qualified(spark, folder or new_path(spark, "tokens"))
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    if partitions is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
        partitions = max(1, -(-size // (32 << 20)))
    # equal ids are told apart by a hash, so that many of them do not meet in one file and samples stay small
    ordered = docs.repartitionByRange(partitions, F.col("doc").asc_nulls_first(), F.xxhash64("text")) if partitions > 1 else docs.coalesce(1)
    ordered = ordered.sortWithinPartitions(F.col("doc").asc_nulls_first(), F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, encode = None, f"{folder}/{uuid.uuid4().hex}.tok", encoder(tokenizer_path)
        first = None
        for batch in batches:
            names, (data, places) = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for i, j in blocks(places, 1 << 20):
                ids, starts = encode(data[places[i] : places[j]], places[i : j + 1] - places[i])
                ids, starts = np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))
                for k, doc in enumerate(names[i:j]):
                    if writer is None:
                        writer, first = TokenFileWriter(path, frame_tokens), doc
                    writer.add(doc, ids[starts[k] : starts[k + 1]])
        if writer is not None:
            tokens = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([path]), pa.array([len(writer.docs)]), pa.array([tokens])], names=["first", "path", "n_docs", "n_tokens"])

    written = ordered.mapInArrow(write, "first long, path string, n_docs long, n_tokens long").withColumn("part", F.spark_partition_id())
    manifest = materialize(written, "manifest")
    before = manifest.alias("b").groupBy("part").agg(F.sum("n_tokens").alias("t"))
    # one row per file: the running total is a small, bounded step
    from pyspark.sql import Window

    running = before.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("start"))
    return manifest.join(running, "part").select("part", "path", "n_docs", "n_tokens", "start")


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All documents of the files of a manifest: id_col, start (tokens before it), ids (binary).

    Files are read side by side, each a frame at a time; an empty manifest gives no rows.
    """
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs, starts, blobs = [], [], []
                for doc, ids in TokenFileReader(path):
                    docs.append(doc)
                    starts.append(start)
                    blobs.append(ids.tobytes())
                    start += len(ids)
                    if len(docs) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts), pa.array(blobs, pa.binary())], names=["doc", "start", "ids"])
                        docs, starts, blobs = [], [], []
                if docs:
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts), pa.array(blobs, pa.binary())], names=["doc", "start", "ids"])

    return manifest.repartitionByRange(files, "part").select("path", "start").mapInArrow(read, "doc long, start long, ids binary").withColumnRenamed("doc", id_col)
