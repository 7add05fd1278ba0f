"""Removal of long strings repeated from earlier documents, by sorted suffixes.

A string of n bytes is found in two documents if and only if its winnowed anchor (the leftmost
q-gram with the least hash in it) is, so only stretches of text around anchors whose hash occurs
in two documents take part.  Their suffixes are dealt out by anchor and sorted in each bucket by
deep-shallow sorting: multikey quicksort on eight bytes at a time to a shallow depth, then blind
tries for the groups that still share a prefix.  Equal n-byte strings are neighbours then.
The windows of an anchor that very many stretches share are dealt out one by one, by a hash of
their own n bytes: equal windows still meet, and no bucket holds a whole anchor.  What very many
chunks send a bucket alike is merged on the way, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.chunks import CHUNK_BYTES, FAN, Exchange, exchange, pack, pack_array, per_row, table_of, texts_of, unpack_array, with_answers
from rillstone.llm.kernels import anchors
from rillstone.storage import materialize, remove

GRAM = 25
SHALLOW = 24
WORD = 8
#: Stretches around one anchor hash beyond which its windows are dealt out one by one.
HOT = 1 << 15
#: Windows sorted at a time.
SORTED = 1 << 20


def _by_group(key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order that sorts by group, then by key (unsigned); fewer than 2**32 of each."""
    by = np.argsort(key)
    pairs = (group[by].astype(np.uint64) << np.uint64(32)) | np.arange(len(by), dtype=np.uint64)
    pairs.sort()
    return by[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def sort_suffixes(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of data at starts by their first depth bytes (depth at least 8).

    Returns (order, group): order lists the suffixes in sorted order; group numbers them in that
    order, equal prefixes of depth bytes having one number.
    """
    word = np.ndarray((max(0, len(data) - WORD + 1),), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))

    def at(offset: np.ndarray | int, rows: np.ndarray) -> np.ndarray:
        return word[starts[rows] + offset].byteswap()

    n = len(starts)
    order, group = np.arange(n), np.zeros(n, np.int64)
    # shallow: partition each group of equals by its next eight bytes
    for d in range(0, min(shallow, depth - WORD + 1), WORD):
        size = np.bincount(group, minlength=1)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        key = at(d, order[open_])
        by = _by_group(key, group[open_]) if d else np.argsort(key)
        order[open_] = order[open_][by]
        key, step = key[by], np.zeros(n, np.int64)
        step[1:] = group[1:] != group[:-1]
        step[open_[1:]] |= (key[1:] != key[:-1]) & (group[open_[1:]] == group[open_[:-1]])
        group = np.cumsum(step)
    known = min(shallow, depth // WORD * WORD)
    # deep: the blind tries of all groups, a level at a time; a node looks only at its branching byte
    todo = np.bincount(group, minlength=1) > 1
    while todo.any():
        rows = np.flatnonzero(todo[group])
        head = np.ones(len(rows), bool)
        head[1:] = group[rows[1:]] != group[rows[:-1]]
        first = np.flatnonzero(head)
        mine, top = order[rows], order[rows[first]][np.cumsum(head) - 1]
        common = np.full(len(rows), depth)
        for d in range((depth - 1) // WORD * WORD, known - 1, -WORD):
            d = min(d, depth - WORD)
            differ = at(d, mine) ^ at(d, top)
            hit = differ != 0
            # without the bit below it, the top bit cannot round up
            top_bit = (differ[hit] & ~(differ[hit] >> np.uint64(1))).astype(np.float64)
            common[hit] = d + (63 - np.log2(top_bit).astype(int)) // 8
        skip = np.minimum.reduceat(common, first)
        ended = skip >= depth
        branch = np.repeat(~ended, np.diff(np.append(first, len(rows))))
        open_ = rows[branch]
        todo[group[rows[first[ended]]]] = False
        if not len(open_):
            break
        offset = skip[np.cumsum(head) - 1][branch]
        byte = data[starts[order[open_]] + offset]
        by = _by_group(byte, group[open_])
        order[open_] = order[open_][by]
        byte, old = byte[by], group[open_]
        step = np.zeros(n, np.int64)
        step[1:] = group[1:] != group[:-1]
        step[open_[1:]] |= (byte[1:] != byte[:-1]) & (old[1:] == old[:-1])
        was = todo[group]
        group = np.cumsum(step)
        todo = was[np.flatnonzero(np.r_[True, step[1:] > 0])] & (np.bincount(group) > 1)
    return order, group


def _grams(row: dict, id_col: str, text_col: str, n: int, buckets: int) -> Iterator[tuple]:
    """Which anchor hashes a chunk holds, how often, and whether two of its documents do."""
    table = table_of(row["payload"])
    ids = table.column(id_col).to_numpy()
    text, _, _, _, h = anchors(*texts_of(table.column(text_col)), n, GRAM)
    if not len(h):
        return
    owner = ids[text]
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    shared = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    times = np.diff(np.append(first, len(h))).astype(np.uint32)
    h = h[first]
    bucket, short = (h >> np.uint64(32)) % np.uint64(buckets), (h & np.uint64(0xFFFFFF)).astype(np.uint32)
    for b, rows in _split(bucket, buckets):
        rows = rows[np.argsort(short[rows], kind="stable")]
        yield row["chunk"], b, *_packed(short[rows], shared[rows], times[rows])


def _packed(hashes: np.ndarray, shared: np.ndarray, times: np.ndarray) -> tuple:
    """A message of ascending 32-bit hashes: their steps, whether two documents hold them and how often."""
    steps = np.diff(hashes, prepend=np.uint32(0))
    narrow = bool(steps.max() < 1 << 16)
    return pack_array(steps.astype(np.uint16) if narrow else steps), int(narrow), np.packbits(shared).tobytes(), pack_array(times)


def _split(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if ends[b] < ends[b + 1]:
            yield b, order[ends[b] : ends[b + 1]]


def _window_hash(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n bytes (at least 8) at each of starts."""
    word = np.ndarray((max(0, len(data) - WORD + 1),), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    out = np.zeros(len(starts), np.uint64)
    for d in range(0, n, WORD):
        out = (out ^ word[starts + min(d, n - WORD)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _gathered(messages: list[dict]) -> tuple:
    """The hashes of all messages in one list: distinct ones, the number of each in it, shared, times and the messages' ends."""
    lists = [np.cumsum(unpack_array(m["hashes"], np.uint16 if m["narrow"] else np.uint32), dtype=np.uint32) for m in messages]
    shared = [np.unpackbits(np.frombuffer(m["shared"], np.uint8), count=len(x)).astype(bool) for m, x in zip(messages, lists, strict=True)]
    values, number, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    often = count > 1
    np.logical_or.at(often, number, np.concatenate(shared))
    times = np.bincount(number, np.concatenate([unpack_array(m["times"], np.uint32) for m in messages]))
    return values, number, often, times, np.cumsum([len(x) for x in lists])[:-1]


def _told(bucket: int, messages: list[dict], often: np.ndarray, hot: np.ndarray, cuts: np.ndarray) -> Iterator[tuple]:
    for m, x, y in zip(messages, np.split(often, cuts), np.split(hot, cuts), strict=True):
        if x.any():
            yield m["chunk"], bucket, np.packbits(x).tobytes(), np.packbits(y).tobytes() if y.any() else None


def _repeated(bucket: int, messages: list[dict], hot: int) -> Iterator[tuple]:
    """Tell each chunk which of its anchor hashes occur in two documents, and which more than hot times."""
    _, number, often, times, cuts = _gathered(messages)
    yield from _told(bucket, messages, often[number], (often & (times > hot))[number], cuts)


def _merged_grams(bucket: int, messages: list[dict]) -> tuple:
    values, _, often, times, _ = _gathered(messages)
    return _packed(values, often, np.minimum(times, np.iinfo(np.uint32).max).astype(np.uint32))


def _spread_grams(bucket: int, messages: list[dict], found: dict | None) -> Iterator[tuple]:
    if found is not None:
        values, number, _, _, cuts = _gathered(messages)
        often, hot = (np.unpackbits(np.frombuffer(found[k] or bytes(len(values) // 8 + 1), np.uint8), count=len(values)).astype(bool) for k in ("often", "hot"))
        yield from _told(bucket, messages, often[number], hot[number], cuts)


def _padded(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Strings as rows of equal width, whole words: their bytes, zeros, and their length (below 256) at the end."""
    width = -(-int(length.max(initial=0)) // WORD) * WORD + WORD
    ended = np.append(data, np.zeros(width, np.uint8))
    rows = np.lib.stride_tricks.sliding_window_view(ended, width)[start]
    rows *= np.arange(width) < length[:, None]
    rows[:, -1] = length
    return rows


def _distinct(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which strings stand for the distinct ones, and the number of each string's own among those.

    Strings of equal hashes are compared byte by byte; one that differs stands for itself.
    """
    rows = _padded(data, start, length).view(np.uint64)
    sums = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        sums = (sums ^ rows[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        sums ^= sums >> np.uint64(29)
    order = np.argsort(sums, kind="stable")
    new = np.ones(len(sums), bool)
    new[1:] = sums[order[1:]] != sums[order[:-1]]
    leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    odd = np.flatnonzero((rows[order] != rows[leader]).any(1))
    leader[odd] = order[odd]
    stands = np.empty(len(sums), np.int64)
    stands[order] = leader
    return np.unique(stands, return_inverse=True)


def _windows(data: np.ndarray, first: np.ndarray, last: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window from first to last, and whose it is."""
    count = last - first + 1
    return np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count), np.repeat(owner, count)


def _stretches(row: dict, id_col: str, text_col: str, n: int, buckets: int) -> Iterator[tuple]:
    """The stretches of a chunk whose anchors are repeated, each distinct one once, by bucket.

    A stretch is the union of the n-byte windows that share an anchor; of hot anchors each window is
    a stretch of its own, dealt by its own hash.  The last message is the chunk's to itself: for
    each stretch where it starts, how many windows it has, its bucket, its number there, and
    whether an earlier document of the chunk holds it too.
    """
    table = table_of(row["payload"])
    ids = table.column(id_col).to_numpy()
    data, starts = texts_of(table.column(text_col))
    text, _, first, last, h = anchors(data, starts, n, GRAM)
    hashes, number = np.unique(h, return_inverse=True)
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    often, hot, flags = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool), {a["bucket"]: a for a in row["answers"] or []}
    for b, rows in _split(bucket, buckets):
        if b in flags:
            rows = rows[np.argsort(hashes[rows] & np.uint64(0xFFFFFF), kind="stable")]
            often[rows] = np.unpackbits(np.frombuffer(flags[b]["often"], np.uint8), count=len(rows))
            if flags[b]["hot"] is not None:
                hot[rows] = np.unpackbits(np.frombuffer(flags[b]["hot"], np.uint8), count=len(rows))
    keep, split = (often & ~hot)[number], hot[number]
    one, of = _windows(data, first[split], last[split], ids[text[split]], n)
    start = np.append(first[keep], one)
    length = np.append(last[keep] - first[keep] + n, np.full(len(one), n))
    owner = np.append(ids[text[keep]], of)
    if not len(start):
        return
    place = np.append(bucket[number[keep]], (_window_hash(data, one, n) % np.uint64(buckets)).astype(np.int64))
    stands, number = _distinct(data, start, length)
    least = np.full(len(stands), np.iinfo(np.int64).max)
    np.minimum.at(least, number, owner)
    slot = np.zeros(len(stands), np.int64)
    for b, rows in _split(place[stands], buckets):
        slot[rows] = np.arange(len(rows))
        size = length[stands[rows]]
        ends = np.cumsum(size)
        yield row["chunk"], b, pack_array(data[np.repeat(start[stands[rows]] - (ends - size), size) + np.arange(ends[-1])], level=3), pack_array(size.astype(np.uint8)), pack_array(least[rows])
    order = np.argsort(start, kind="stable")
    number, later = number[order], owner[order] > least[number[order]]
    itself = [np.diff(start[order], prepend=0).astype(np.uint32), (length[order] - n + 1).astype(np.uint8), place[stands][number].astype(np.uint32), slot[number].astype(np.uint32), np.packbits(later)]
    parts = [pack_array(x) for x in itself]
    yield row["chunk"], -1 - row["chunk"], b"".join(parts), pack_array(np.array([len(x) for x in parts])), b""


def _foreign(data: np.ndarray, starts: np.ndarray, holder: np.ndarray, n: int) -> np.ndarray:
    """Which of the n-byte windows at starts an earlier holder than their own has too.

    Many windows are sorted in parts by a hash of their bytes; equal ones share a part.
    """
    parts, out = 1 + len(starts) // SORTED, np.zeros(len(starts), bool)
    part = np.zeros(len(starts), np.uint16)
    for i in range(0, len(starts) if parts > 1 else 0, SORTED):
        part[i : i + SORTED] = _window_hash(data, starts[i : i + SORTED], n) % np.uint64(parts)
    for k in range(parts):
        rows = np.flatnonzero(part == k)
        if not len(rows):
            continue
        order, group = sort_suffixes(data, starts[rows], n)
        rows = rows[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        out[rows] = np.minimum.reduceat(holder[rows], first)[group] < holder[rows]
    return out


def _strings(messages: list[dict]) -> tuple:
    """The stretches of all messages in one list: bytes, where each begins, lengths, first holders and the messages' ends."""
    sizes = [unpack_array(m["lengths"], np.uint8) for m in messages]
    length = np.concatenate(sizes).astype(np.int64)
    data = np.concatenate([unpack_array(m["strings"], np.uint8) for m in messages])
    return data, np.cumsum(length) - length, length, np.concatenate([unpack_array(m["least"], np.int64) for m in messages]), np.cumsum([len(x) for x in sizes])[:-1]


def _every(count: np.ndarray) -> np.ndarray:
    return ((np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


def _itself(bucket: int, messages: list[dict]) -> Iterator[tuple]:
    for m in messages:
        yield m["chunk"], bucket, m["strings"], m["lengths"]


def _earliest(bucket: int, messages: list[dict], n: int) -> Iterator[tuple]:
    """For each stretch, the windows (as bits) that an earlier document than the chunk's first holder has."""
    if bucket < 0:
        yield from _itself(bucket, messages)
        return
    data, begin, length, least, cuts = _strings(messages)
    # whole stretches first: chunks that hold the same one need its windows sorted once
    rows = _padded(data, begin, length)
    order, group = sort_suffixes(rows.ravel(), np.arange(len(rows)) * rows.shape[1], rows.shape[1])
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    own, holder, number = order[head], np.minimum.reduceat(least[order], head), np.empty(len(order), np.int64)
    number[order] = group
    count = length[own] - n + 1
    inside = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint8)
    earlier = _foreign(data, np.repeat(begin[own], count) + inside, np.repeat(holder, count), n).astype(np.uint32)
    bits = np.bitwise_or.reduceat(earlier << inside, np.cumsum(count) - count)[number]
    bits = np.where(least > holder[number], _every(count)[number], bits)
    for m, x in zip(messages, np.split(bits, cuts), strict=True):
        yield m["chunk"], bucket, pack_array(x), None


def _merged_strings(bucket: int, messages: list[dict]) -> tuple:
    if bucket < 0:
        return b"", b"", b""
    data, begin, length, least, _ = _strings(messages)
    stands, number = _distinct(data, begin, length)
    first = np.full(len(stands), np.iinfo(np.int64).max)
    np.minimum.at(first, number, least)
    size = length[stands]
    ends = np.cumsum(size)
    return pack_array(data[np.repeat(begin[stands] - (ends - size), size) + np.arange(ends[-1])], level=3), pack_array(size.astype(np.uint8)), pack_array(first)


def _spread_strings(bucket: int, messages: list[dict], found: dict, n: int) -> Iterator[tuple]:
    if bucket < 0:
        yield from _itself(bucket, messages)
        return
    data, begin, length, least, cuts = _strings(messages)
    stands, number = _distinct(data, begin, length)
    first = np.full(len(stands), np.iinfo(np.int64).max)
    np.minimum.at(first, number, least)
    bits = np.where(least > first[number], _every(length - n + 1), unpack_array(found["bits"], np.uint32)[number])
    for m, x in zip(messages, np.split(bits, cuts), strict=True):
        yield m["chunk"], bucket, pack_array(x), None


def _covered(size: int, answers: list[dict], n: int) -> np.ndarray:
    """Which bytes of a chunk of size bytes lie in a repeated window."""
    itself = next((a for a in answers if a["bucket"] < 0), None)
    if itself is None:
        return np.zeros(size, bool)
    cuts = np.cumsum(unpack_array(itself["lengths"], np.int64))
    parts = [itself["bits"][a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]
    step, count, place, slot = (unpack_array(x, k) for x, k in zip(parts, (np.uint32, np.uint8, np.uint32, np.uint32), strict=False))
    first, later = np.cumsum(step, dtype=np.int64), np.unpackbits(unpack_array(parts[4], np.uint8), count=len(step)).astype(bool)
    bits = {a["bucket"]: unpack_array(a["bits"], np.uint32) for a in answers if a["bucket"] >= 0}
    base = np.zeros(max(bits) + 2, np.int64)
    for b, x in bits.items():
        base[b + 1] = len(x)
    base = np.cumsum(base)
    own = np.concatenate([bits[b] for b in sorted(bits)])[base[place] + slot]
    own = np.where(later, (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1), own.astype(np.uint64)).astype("<u4")
    hit = np.flatnonzero(np.unpackbits(own.view(np.uint8), bitorder="little"))
    total = np.cumsum(np.bincount(first[hit >> 5] + (hit & 31), minlength=size))
    total[n:] -= total[:-n].copy()
    return total > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 50, hot: int = HOT, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """docs with every byte removed that an earlier document's min_bytes-byte string covers.

    Texts are UTF-8 bytes, a null text is empty; a byte goes if it lies in a string of min_bytes
    bytes that also starts in a document with a smaller id, judged on the input, overlaps counted.
    Adds kept_bytes (binary), n_bytes, n_removed and n_spans; text_col is kept_bytes as a string,
    where a character cut in half becomes U+FFFD.  A null text stays null if it is kept as a
    column.  Rows with a null id take no part and are returned unchanged; rows with equal ids do
    not count as earlier than each other.
    Any other columns are returned as they are; columns named like the four new ones are replaced.
    An anchor with more than hot stretches has its windows dealt out one by one, messages of more than fan
    chunks (of chunk_bytes of text) to a bucket are merged before they meet; the result is the same.
    """
    if not 2 * GRAM <= min_bytes <= GRAM + 31:
        raise ValueError(f"min_bytes must lie between {2 * GRAM} and {GRAM + 31}")
    docs = docs.drop("kept_bytes", "n_bytes", "n_removed", "n_spans")
    chunks, path = pack(docs.where(F.col(id_col).isNotNull()).withColumn(id_col, F.col(id_col).cast("long")), text_col, chunk_bytes)
    held = chunks.agg(F.coalesce(F.sum(F.length("payload")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets, number = max(8, int(held["b"] >> 20)), held["n"]
    n, blob, whole = min_bytes, pa.binary(), pa.int64()
    grams = Exchange(
        [("hashes", "binary", blob), ("narrow", "long", whole), ("shared", "binary", blob), ("times", "binary", blob)],
        [("often", "binary", blob), ("hot", "binary", blob)],
        lambda b, m: _repeated(b, m, hot),
        _merged_grams,
        _spread_grams,
    )
    strings = Exchange(
        [("strings", "binary", blob), ("lengths", "binary", blob), ("least", "binary", blob)],
        [("bits", "binary", blob), ("lengths", "binary", blob)],
        lambda b, m: _earliest(b, m, n),
        _merged_strings,
        lambda b, m, found: _spread_strings(b, m, found, n),
    )

    def sent(table: DataFrame, fn, work: Exchange) -> DataFrame:
        text, out = work.schemas(work.fields)
        return table.mapInArrow(per_row(lambda row: fn(row, id_col, text_col, n, buckets), out.names, out.types), text)

    often = exchange(sent(chunks, _grams, grams), number, grams, fan)
    known = materialize(with_answers(chunks, often, ["bucket", "often", "hot"]), "stretches", row_group_bytes=8 << 20)
    remove(docs.sparkSession, path)
    bits = exchange(sent(known, _stretches, strings), number, strings, fan).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "lengths")).alias("found"))
    schema = docs.withColumn(id_col, F.col(id_col).cast("long")).schema
    names = list(schema.names)
    out_schema = schema.add("kept_bytes", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, found in zip(batch.column("payload"), batch.column("found"), strict=True):
                table = table_of(payload.as_py())
                raw, starts = texts_of(table.column(text_col))
                gone = _covered(len(raw), found.as_py() or [], n)
                total = np.concatenate([[0], np.cumsum(gone)])
                edge = np.r_[gone[:1], gone[1:] & ~gone[:-1]] if len(gone) else gone
                edge = edge.copy()
                inner = starts[:-1][starts[:-1] < len(gone)]
                edge[inner] = gone[inner]
                spans = np.concatenate([[0], np.cumsum(edge)])
                left = raw[~gone].tobytes()
                at = (starts - total[starts]).tolist()
                kept = [left[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                null = table.column(text_col).is_null().to_pylist()
                columns = [
                    pa.array([None if x else k.decode("utf-8", "replace") for x, k in zip(null, kept, strict=True)], pa.string()) if name == text_col else table.column(name).combine_chunks() for name in names
                ]
                columns += [pa.array(kept, pa.binary()), pa.array(np.diff(starts)), pa.array(np.diff(total[starts])), pa.array(np.diff(spans[starts]))]
                out = pa.table(columns, names=[*names, "kept_bytes", "n_bytes", "n_removed", "n_spans"])
                yield from out.to_batches(max_chunksize=1000)

    done = known.join(bits, "chunk", "left").mapInArrow(apply, out_schema)
    strays = docs.where(F.col(id_col).isNull()).withColumn(id_col, F.col(id_col).cast("long"))
    raw = F.coalesce(F.encode(text_col, "utf-8"), F.lit(b""))
    return done.unionByName(strays.withColumns({"kept_bytes": raw, "n_bytes": F.length(raw).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")}))
