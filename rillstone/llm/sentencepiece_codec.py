"""SentencePiece ids by unigram Viterbi over a double-array trie of pieces, and back to text.

A space is written as the marker, and a text begins with one.  Of all ways to cut a text into
pieces the one with the largest sum of log scores is taken; a character that no piece covers
becomes the pieces of its bytes.  Texts are cut into words where no piece reaches across, and the
distinct words of a block are solved together, one lattice column of all words at a time.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.llm.chunks import texts_of
from rillstone.llm.encode import _CODES, _PLACES, LONG_WORD, BlockEncoder
from rillstone.llm.kernels import blocks

# Fixed values of the public model format.
MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields (number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = varint() if size is None else size
        yield key >> 3, raw[at : at + size]
        at += size


class DoubleArray:
    """A trie of byte strings in two arrays: the child of node s by byte c is base[s] + c + 1 if check there is s."""

    def __init__(self, strings: list[bytes], values: list[int]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for text, value in zip(strings, values, strict=True):
            node = 0
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                node = children[node][c]
            ends[node] = value
        size = 4 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = bytearray(b"\1") * size
        free[0] = 0
        place, todo = {0: 0}, [0]
        # nodes with as many children go on where the last of them found room
        reached = [1] * 9
        # the root, then nodes level by level; each takes the first base that leaves its children free places
        for node in todo:
            kids = sorted(children[node])
            if node in ends:
                value[place[node]] = ends[node]
            if not kids:
                continue
            kind = min(len(kids), 8)
            slot = free.find(1, reached[kind])
            while True:
                offset = slot - kids[0] - 1
                if offset >= 0 and all(free[offset + c + 1] for c in kids):
                    break
                slot = free.find(1, slot + 1)
            reached[kind] = slot
            base[place[node]] = offset
            for c in kids:
                child = offset + c + 1
                free[child], check[child] = 0, place[node]
                place[children[node][c]] = child
                todo.append(children[node][c])
        last = int(np.flatnonzero(check >= 0).max(initial=0)) + 258
        self.base, self.check, self.value = base[:last], check[:last], value[:last]

    def step(self, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes by bytes, and which exist."""
        child = self.base[node] + byte.astype(np.int32) + 1
        return child, (child < len(self.check)) & (self.check[np.minimum(child, len(self.check) - 1)] == node)


class Pieces:
    """A SentencePiece model file: pieces, log scores and the trie.

    A unigram file's scores are log probabilities.  A BPE file holds merge ranks instead; its pieces
    get the log probabilities that Zipf's law gives those ranks.
    """

    def __init__(self, raw: bytes):
        self.pieces, self.scores, self.kinds, kind, charsmap, self.prefix = [], [], [], UNIGRAM, b"", True
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rule = dict(_fields(value))
                charsmap, self.prefix = rule.get(2, b""), bool(rule.get(3, 1))
                if charsmap or rule.get(4, 1):
                    raise ValueError("only models that keep texts as they are (identity rule, white space kept) are read")
        normal = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER_DEFINED)]
        if kind == BPE:
            order = sorted(normal, key=lambda i: -self.scores[i])
            total = math.log(sum(1 / r for r in range(1, len(order) + 1)))
            for rank, i in enumerate(order, 1):
                self.scores[i] = -math.log(rank) - total
        self.trie = DoubleArray([self.pieces[i].encode() for i in normal], normal)
        self.score = np.array(self.scores, np.float64)
        self._lists: tuple[list[int], list[int], list[int]] | None = None
        self.unknown_score = min((self.scores[i] for i in normal), default=0.0) - UNKNOWN_PENALTY
        bytes_ = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.byte_ids = np.array([bytes_.get(b, unknown) for b in range(256)], np.uint32)
        self.has_bytes = len(bytes_) == 256
        self.unknown = unknown
        self.cuts = not any(MARKER in p.lstrip(MARKER) or "\n" in p for p in (self.pieces[i] for i in normal))
        # what each id is worth in a decoded text
        self.shown = [p.replace(MARKER, " ").encode() if k in (NORMAL, USER_DEFINED) else bytes([int(p[1:-1], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else b"" for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.shown_bytes, self.shown_size = np.frombuffer(b"".join(self.shown), np.uint8), np.array([len(x) for x in self.shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size

    def segment(self, words: list[bytes]) -> list[bytes]:
        """The best ids of each word (marker for space already in place), as unsigned 32-bit integers."""
        if any(len(w) > LONG_WORD for w in words):
            short = [w for w in words if len(w) <= LONG_WORD]
            rest = iter(self.segment(short) if short else [])
            return [self._walk(w) if len(w) > LONG_WORD else next(rest) for w in words]
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words])
        stop = np.cumsum(length)
        begin = stop - length
        n = len(data)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        limit = np.repeat(stop, length)
        # edges of the lattices: every piece that starts at a character
        starts, ends, ids = [], [], []
        at, node, depth = heads, np.zeros(len(heads), np.int32), 0
        while len(at):
            inside = at + depth < limit[at]
            at, node = at[inside], node[inside]
            node, exists = self.trie.step(node, data[at + depth])
            at, node = at[exists], node[exists]
            depth += 1
            whole = self.trie.value[node] >= 0
            starts.append(at[whole])
            ends.append(at[whole] + depth)
            ids.append(self.trie.value[node[whole]])
        next_head = np.append(heads[1:], n)
        starts, ends, ids = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (starts, ends, ids))
        single = np.zeros(n + 1, bool)
        single[starts[ends == next_head[np.searchsorted(heads, starts)]]] = True
        lone = np.flatnonzero(~single[heads])
        starts, ends = np.concatenate([starts, heads[lone]]), np.concatenate([ends, next_head[lone]])
        score = np.concatenate([self.score[ids], np.full(len(lone), self.unknown_score)])
        ids = np.concatenate([ids, np.full(len(lone), -1)])
        # best path to each place; columns are byte offsets within words, all words at once
        word = np.searchsorted(stop, starts, "right")
        column = ends - begin[word]
        order = np.lexsort((starts, ends, column))
        starts, ends, ids, score, column = starts[order], ends[order], ids[order], score[order], column[order]
        best, via = np.full(n + 1, -np.inf), np.full(n + 1, -1)
        first_of = np.zeros(n + 1, bool)
        first_of[begin] = True
        edges = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else []
        for a, b in zip(edges, [*edges[1:], len(column)], strict=True):
            total = np.where(first_of[starts[a:b]], 0.0, best[starts[a:b]]) + score[a:b]
            head = np.flatnonzero(np.r_[True, ends[a + 1 : b] != ends[a : b - 1]])
            top = np.maximum.reduceat(total, head)
            hit = total == np.repeat(top, np.diff(np.append(head, b - a)))
            rows = np.flatnonzero(hit)
            place = ends[a:b][rows]
            keep = np.r_[True, place[1:] != place[:-1]]
            self_end, rows = place[keep], rows[keep]
            # a word's end is the next word's start: keep both apart by writing to the end only
            best_end, via_end = total[rows], a + rows
            best[self_end], via[self_end] = best_end, via_end
        # back from each word's end
        trail: list[list[np.ndarray]] = []
        now, mine = stop[length > 0], np.flatnonzero(length > 0)
        while len(now):
            edge = via[now]
            trail.append([mine, edge])
            now = starts[edge]
            on = now > begin[mine]
            now, mine = now[on], mine[on]
        if not trail:
            return [b""] * len(words)
        owner, edge = np.concatenate([t[0] for t in trail]), np.concatenate([t[1] for t in trail])
        back = np.concatenate([np.full(len(t[0]), -k) for k, t in enumerate(trail)])
        order = np.lexsort((back, owner))
        owner, edge = owner[order], edge[order]
        chosen, a, b = ids[edge], starts[edge], ends[edge]
        size = np.where(chosen >= 0, 1, b - a if self.has_bytes else 1)
        done = np.cumsum(size)
        out = np.repeat(np.where(chosen >= 0, chosen, self.unknown), size).astype(np.uint32)
        if self.has_bytes:
            inside = np.arange(len(out)) - np.repeat(done - size, size)
            lost = np.repeat(chosen < 0, size)
            out[lost] = self.byte_ids[data[(np.repeat(a, size) + inside)[lost]]]
        raw = out.tobytes()
        cut = 4 * np.concatenate([[0], done])[np.searchsorted(owner, np.arange(len(words) + 1))]
        return [raw[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def _walk(self, word: bytes) -> bytes:
        """segment for one long word, character by character; of equal paths it takes the same one."""
        if self._lists is None:
            self._lists = self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()
        base, check, value = self._lists
        n, size = len(word), len(check)
        best, via = [-math.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        heads = [i for i in range(n) if word[i] & 0xC0 != 0x80] + [n]
        for s, following in zip(heads[:-1], heads[1:], strict=True):
            so_far, node, at, lone = best[s], 0, s, True
            while at < n:
                child = base[node] + word[at] + 1
                if child >= size or check[child] != node:
                    break
                node, at = child, at + 1
                piece = value[node]
                if piece >= 0:
                    lone &= at != following
                    total = so_far + self.scores[piece]
                    if total > best[at]:
                        best[at], via[at] = total, (s, piece)
            if lone and so_far + self.unknown_score > best[following]:
                best[following], via[following] = so_far + self.unknown_score, (s, -1)
        out, at = [], n
        while at:
            s, piece = via[at]
            out.append([piece] if piece >= 0 else self.byte_ids[list(word[s:at])].tolist() if self.has_bytes else [self.unknown])
            at = s
        return np.array([i for ids in reversed(out) for i in ids], np.uint32).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.shown[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode_block(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many texts' ids on end, and the n + 1 places where the texts start."""
        size = self.shown_size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.shown_bytes[np.repeat(self.shown_start[ids] - ends[:-1], size) + np.arange(ends[-1])]
        at = ends[starts]
        if self.prefix:
            full = np.flatnonzero(np.diff(at))
            spaced = at[full[data[at[full]] == 32]]
            data, at = np.delete(data, spaced), at - np.searchsorted(spaced, at)
        return data, at


class SentencePieceEncoder(BlockEncoder):
    cache_bytes = 60_000_000  # lattices need memory beside the cache

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def whole(self, text: str) -> bytes:
        if not text:
            return b""
        if self.pieces.cuts and MARKER not in text:
            data = np.frombuffer(text.encode(), np.uint8)
            first = np.flatnonzero(self._begins(data, np.array([0, len(data)]))).tolist()
            words = [data[a:b].tobytes() for a, b in zip(first, [*first[1:], len(data)], strict=True)]
            return b"".join(self._lookup(words, [True] + [False] * (len(words) - 1)))
        return self.pieces.segment([((MARKER if self.pieces.prefix else "") + text.replace(" ", MARKER)).encode()])[0]

    def _long_or_odd(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        odd = np.full(len(starts) - 1, not self.pieces.cuts)
        begin = np.append(np.flatnonzero(self._begins(data, starts)), len(data))
        wide = np.flatnonzero(np.diff(begin) > LONG_WORD)
        odd[np.searchsorted(starts, begin[wide], "right") - 1] = True
        # a marker in the text itself is a space to the pieces
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
        odd[np.searchsorted(starts, mark, "right") - 1] = True
        return odd

    @staticmethod
    def _begins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A word begins with a text, at a space after ink, at a newline and after one."""
        begin = np.zeros(len(data) + 1, bool)
        begin[starts] = True
        begin = begin[:-1]
        space, line = data == 32, data == 10
        begin |= line
        begin[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        return begin

    def _words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.flatnonzero(self._begins(data, starts))
        stop = np.append(first[1:], len(data))
        inside = np.arange(len(data)) - np.repeat(first, stop - first)
        sums = np.add.reduceat(_CODES[data] * _PLACES[np.minimum(inside, LONG_WORD)], first)
        opens = np.isin(first, starts)
        sums[opens] ^= np.uint64(0x5BD1E9955BD1E995)
        return first, stop, sums ^ (sums >> np.uint64(31))

    def _lookup(self, words: list[bytes], opens: list[bool]) -> list[bytes]:
        mark = MARKER.encode()
        return self.pieces.segment([(mark if o and self.pieces.prefix else b"") + w.replace(b" ", mark) for w, o in zip(words, opens, strict=True)])


_loaded: dict[int, SentencePieceEncoder] = {}


def _encoder(raw: bytes) -> SentencePieceEncoder:
    """The encoder of a model, built once in each Python worker."""
    key = hash(raw)
    if key not in _loaded:
        _loaded[key] = SentencePieceEncoder(Pieces(raw))
    return _loaded[key]


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with ids_col: the text's ids as little-endian unsigned 32-bit integers (binary).

    A null or empty text has no ids.  Other columns are returned as they are; a column named ids_col
    is replaced.  The model file is read on the driver and is as large as its vocabulary.
    """
    with open(model_path, "rb") as file:
        raw = file.read()
    docs = docs.drop(ids_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(raw)
        for big in batches:
            _, places = texts_of(big.column(at))
            for i, j in blocks(places, 1 << 20):
                batch = big.slice(i, j - i)
                ids, starts = encode(*texts_of(batch.column(at)))
                blob = ids.astype("<u4").tobytes()
                column = pa.array([blob[4 * a : 4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(ids_col, "binary"))


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """encoded with text_col: the text of the ids; null ids give null, bytes that are no UTF-8 give U+FFFD.

    Other columns are returned as they are; a column named text_col is replaced.
    """
    with open(model_path, "rb") as file:
        raw = file.read()
    encoded = encoded.drop(text_col)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(raw).pieces
        for batch in batches:
            texts = [None if x is None else pieces.decode(np.frombuffer(x, "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields]).add(text_col, "string"))


def codec_report(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_ids, ids_crc32 and round_trip (the decoded text equals the text; null counts as empty).

    One row per row of docs, repeated rows and null ids included; other columns are ignored.  Texts are
    encoded whole and decoded again in the same pass, a block of about 256 KB (or one longer text) at
    a time; only these figures leave a task.
    """
    with open(model_path, "rb") as file:
        raw = file.read()
    docs = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(raw)
        for batch in batches:
            _, places = texts_of(batch.column(1))
            for i, j in blocks(places, 1 << 18):
                part = batch.slice(i, j - i)
                data, starts = texts_of(part.column(1))
                ids, cuts = encode(data, starts)
                back, at = encode.pieces.decode_block(ids, cuts)
                whole, text, shown = ids.astype("<u4"), memoryview(data), memoryview(back)
                crc = [zlib.crc32(whole[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                same = [text[a:b] == shown[c:d] for a, b, c, d in zip(starts[:-1].tolist(), starts[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(cuts)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=[id_col, "n_ids", "ids_crc32", "round_trip"])

    return docs.mapInArrow(run, StructType([docs.schema[id_col]]).add("n_ids", "long").add("ids_crc32", "long").add("round_trip", "boolean"))
