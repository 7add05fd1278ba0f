"""Phrase collocations by top-order marginalisation.

Each word leads one window: itself and the words after it in its piece, padded where the piece
ends.  Only these longest windows are counted; the counts of shorter phrases are sums over them,
which one ROLLUP gives for all prefixes at once, so no list of n-grams of each order is ever made.

Blocks of text count their own windows and send them, packed, to parts of the table by their first
word.  There, where all of a phrase's windows meet, those that occur too seldom to be a phrase are
added to their prefix, padded, before the ROLLUP.  Which words are common, hence short to write and
dealt to several parts, is estimated from a bounded sample; it changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.chunks import texts_of
from rillstone.llm.kernels import BASE, BYTE_CODES, LOWER, blocks, mix
from rillstone.storage import materialize, remove, write_table

#: Text in a block: so few words that numbers of three fit into 63 bits, unless words are very short.
BLOCK_BYTES = 6 << 20
#: Documents of the sample about, words that get a short code, cells that the sample's loads are kept in.
SAMPLE, SHORT, LOADS = 4096, 65_534, 1 << 16
#: A cell of words may fill this share of a part; a fuller one is dealt to several.
FULL = 0.25
#: Windows that a part holds before it adds equal ones together.
HELD = 1 << 20
#: A phrase is common if its count is this share of all words, so that each length has at most COMMON of them.
COMMON = 4096
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def pieces_of_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: where it starts and stops, its hash (A-Z lower-cased, never 0), its text's number and its piece's."""
    empty = np.zeros(0, np.int64)
    if not len(data):
        return empty, empty, np.zeros(0, np.uint64), empty, empty
    ink = ~_GAP[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | cut[1:-1]
    first = np.flatnonzero(begin)
    if not len(first):
        return empty, empty, np.zeros(0, np.uint64), empty, empty
    stop = ink.copy()
    stop[:-1] &= ~ink[1:] | cut[1:-1]
    last = np.flatnonzero(stop) + 1
    inside = (np.arange(len(data)) - first[np.maximum(np.cumsum(begin) - 1, 0)]).astype(np.uint64)
    code = mix(BYTE_CODES[LOWER[data]] + inside * np.uint64(BASE))
    code[~ink] = 0
    h = mix(np.add.reduceat(code, first) + (last - first).astype(np.uint64))
    text = np.searchsorted(starts, first, "right") - 1
    return first, last, np.maximum(h, np.uint64(1)), text, np.cumsum(_BREAK[data])[first] + text


def _windows(number: np.ndarray, piece: np.ndarray, width: int) -> np.ndarray:
    """The windows that words (numbers from 1) lead, width columns; 0 is padding."""
    out = np.zeros((len(number), width), np.int64)
    out[:, 0] = number
    for k in range(1, width):
        same = piece[k:] == piece[: len(piece) - k]
        out[: len(number) - k, k] = np.where(same, number[k:], 0)
    return out


def _counted(rows: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in ascending order and their counts' sums."""
    order = np.lexsort(rows.T[::-1])
    rows, count = rows[order], count[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    first = np.flatnonzero(new)
    return rows[first], np.add.reduceat(count, first) if len(first) else count


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Strings of bytes: values from each cut to the next."""
    ends = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


class Deal:
    """How windows are written and dealt: the words with short codes, and into how many parts a cell of first words or pairs goes."""

    def __init__(self, short: np.ndarray, by_word: np.ndarray, by_pair: np.ndarray, buckets: int):
        self.short, self.by_word, self.by_pair, self.buckets = np.sort(short), by_word, by_pair, buckets

    def slices(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Into how many parts the windows (of hashes) of a first word, and of a first pair, are dealt."""
        pair = mix(rows[:, 0] * np.uint64(3) + mix(rows[:, 1]))
        words = self.by_word[(rows[:, 0] >> np.uint64(40)) % np.uint64(LOADS)]
        pairs = np.where(words > 1, self.by_pair[(pair >> np.uint64(40)) % np.uint64(LOADS)], 1)
        return words.astype(np.uint64), pairs.astype(np.uint64)

    def bucket(self, rows: np.ndarray) -> np.ndarray:
        words, pairs = self.slices(rows)
        rest = np.zeros(len(rows), np.uint64)
        for k in range(2, rows.shape[1]):
            rest = mix(rest + rows[:, k] + np.uint64(k))
        key = rows[:, 0] + mix(mix(rows[:, 1] + np.uint64(7)) % words + np.uint64(1)) + mix(mix(rest + np.uint64(9)) % pairs + np.uint64(2))
        return (mix(key) % np.uint64(self.buckets)).astype(np.int64)

    def codes(self, words: np.ndarray) -> np.ndarray:
        """0 for padding, a number for a word with a short code, the largest number for others."""
        at = np.searchsorted(self.short, words)
        hit = np.append(self.short, np.uint64(0))[at] == words if len(self.short) else np.zeros(len(words), bool)
        return np.where(words == 0, 0, np.where(hit & (at < len(self.short)), at + 1, SHORT + 1)).astype(np.uint16)

    def words(self, codes: np.ndarray, long: np.ndarray) -> np.ndarray:
        """The hashes that codes stand for; long holds those without a short code, in order."""
        out = np.concatenate([np.zeros(1, np.uint64), self.short, np.zeros(1, np.uint64)])[np.minimum(codes, len(self.short) + 1)]
        out[codes == SHORT + 1] = long
        return out


def _texts_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows (lang, text) in tables of about BLOCK_BYTES of text; a longer text is one of its own."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
            if size >= BLOCK_BYTES or start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _count_blocks(deal: Deal, width: int, names: list[str]):
    """A row for each (lang, bucket) that a block has windows or words for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _texts_in_blocks(batches):
            langs = table.column(0).combine_chunks().dictionary_encode()
            data, starts = texts_of(table.column(1))
            parts, pieces = [], 0
            for i, j in blocks(starts, 1 << 16):
                first, last, h, text, piece = pieces_of_words(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
                parts.append((first + starts[i], last + starts[i], h, text + i, piece + pieces))
                pieces += int(starts[j] - starts[i]) + j - i
            first, last, h, text, piece = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else pieces_of_words(data, starts)
            lang_of = langs.indices.to_numpy()[text]
            for lang in np.unique(lang_of).tolist():
                mine = lang_of == lang
                yield _message(deal, width, names, langs.dictionary[lang].as_py(), data, first[mine], last[mine], h[mine], piece[mine])

    return run


def _message(deal: Deal, width: int, names: list[str], lang: str, data: np.ndarray, first: np.ndarray, last: np.ndarray, h: np.ndarray, piece: np.ndarray) -> pa.RecordBatch:
    words, one_of, number = np.unique(h, return_index=True, return_inverse=True)
    rows = _windows(number + 1, piece, width)
    base = len(words) + 1
    if base**width < 2**63:
        key = rows[:, 0].copy()
        for k in range(1, width):
            key = key * base + rows[:, k]
        key, count = np.unique(key, return_counts=True)
        rows = np.empty((len(key), width), np.int64)
        for k in reversed(range(width)):
            key, rows[:, k] = np.divmod(key, base)
    else:
        rows, count = _counted(rows, np.ones(len(rows), np.int64))
    known = np.append(np.zeros(1, np.uint64), words)
    hashes = known[rows]
    bucket = deal.bucket(hashes)
    order = np.argsort(bucket, kind="stable")
    bucket, hashes, count = bucket[order], hashes[order], count[order]
    # words' spellings go to the buckets of their hashes
    home = (mix(words) % np.uint64(deal.buckets)).astype(np.int64)
    by_home = np.argsort(home, kind="stable")
    spell = LOWER[data]
    size = (last - first)[one_of][by_home]
    ends = np.cumsum(size)
    letters = spell[np.arange(int(ends[-1])) + np.repeat(first[one_of][by_home] - (ends - size), size)]
    used = np.unique(np.concatenate([bucket, home]))
    cuts = np.append(np.searchsorted(bucket, used), len(bucket))
    word_cuts = np.append(np.searchsorted(home[by_home], used), len(home))
    columns = [pa.array([lang] * len(used), pa.string()), pa.array(used), _binary(count.astype(np.uint32), cuts)]
    for k in range(width):
        codes = deal.codes(hashes[:, k])
        far = codes == SHORT + 1
        columns += [_binary(codes, cuts), _binary(hashes[far, k], np.append(0, np.cumsum(far))[cuts])]
    columns += [_binary(words[by_home], word_cuts), _binary(size.astype(np.uint32), word_cuts), _binary(letters, np.append(0, ends)[word_cuts])]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _fold(rows: np.ndarray, count: np.ndarray, least: int, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose phrase occurs fewer than least times become their prefix, padded.

    A prefix's windows all lie here unless its first word's, or first pair's, are dealt to several parts (words, pairs).
    """
    width = rows.shape[1]
    for size in range(width, 0, -1):
        # a phrase of this size: all its windows lie side by side, as rows are sorted
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :size] != rows[:-1, :size]).any(1)
        group = np.cumsum(new) - 1
        total = np.bincount(group, count, minlength=int(new.sum())).astype(np.int64)[group] if len(rows) else count
        whole = (words == 1) if size == 1 else (pairs == 1) if size < width else np.ones(len(rows), bool)
        small = (total < least) & whole & (rows[:, size - 1] != 0)
        rows = rows.copy()
        rows[small, size - 1 :] = 0
        order = np.lexsort(rows.T[::-1])
        rows, count, words, pairs = rows[order], count[order], words[order], pairs[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(1)
        at = np.flatnonzero(new)
        if len(at):
            rows, count, words, pairs = rows[at], np.add.reduceat(count, at), np.maximum.reduceat(words, at), np.maximum.reduceat(pairs, at)
    return rows, count


def _merge(deal: Deal, width: int, least: int):
    """Windows with their counts, and words with their spellings, of messages sorted by (lang, bucket)."""
    w = [f"w{k + 1}" for k in range(width)]

    def out(lang: str, rows: np.ndarray, count: np.ndarray, spelt: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        if len(rows):
            rows, count = _counted(rows, count)
            rows, count = _fold(rows, count, least, *deal.slices(rows))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), *(pa.array(rows[:, k].view(np.int64)) for k in range(width)), pa.array(count), pa.nulls(len(rows), pa.string())], names=["lang", *w, "c", "word"])
        if spelt:
            n, none = len(spelt), pa.nulls(len(spelt), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(np.array(list(spelt), np.uint64).view(np.int64)), *[none] * width, pa.array([x.decode("utf-8", "replace") for x in spelt.values()])], names=["lang", *w, "c", "word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, count, fresh, spelt = None, np.zeros((0, width), np.uint64), np.zeros(0, np.int64), [], {}
        waiting = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _counted(np.concatenate([rows, *(x for x, _ in fresh)]), np.concatenate([count, *(x for _, x in fresh)]))

        for batch in batches:
            for r in batch.to_pylist():
                if at != (r["lang"], r["bucket"]):
                    if at is not None:
                        yield from out(at[0], *merged(), spelt)
                    at, rows, count, fresh, spelt, waiting = (r["lang"], r["bucket"]), rows[:0], count[:0], [], {}, 0
                n = len(r["count"]) // 4
                if n:
                    new = np.stack([deal.words(np.frombuffer(r[f"c{k}"], np.uint16), np.frombuffer(r[f"h{k}"], np.uint64)) for k in range(width)], 1)
                    fresh.append((new, np.frombuffer(r["count"], np.uint32).astype(np.int64)))
                    waiting += n
                if waiting > max(HELD, len(rows)):
                    rows, count = merged()
                    fresh, waiting = [], 0
                ends = np.cumsum(np.frombuffer(r["spell_sizes"], np.uint32)).tolist()
                a = 0
                for word, b in zip(np.frombuffer(r["spell_words"], np.uint64).tolist(), ends, strict=True):
                    if word not in spelt:
                        spelt[word] = r["spell"][a:b]
                    a = b
        if at is not None:
            yield from out(at[0], *merged(), spelt)

    return run


def _sampled(docs: DataFrame, width: int, buckets: int) -> Deal:
    """Codes and loads from the beginnings of about SAMPLE documents."""
    n = docs.count()
    chosen = docs if n <= SAMPLE else docs.sample(SAMPLE / n, seed=12)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, starts = texts_of(batch.column(1).slice(k, 1))
                h, piece = pieces_of_words(data[: 1 << 16], np.minimum(starts, 1 << 16))[2::2]
                yield pa.RecordBatch.from_arrays([pa.array([h.tobytes()], pa.binary()), pa.array([piece.tobytes()], pa.binary())], names=["h", "piece"])

    seen = chosen.mapInArrow(look, "h binary, piece binary").limit(2 * SAMPLE).collect()  # at most 2 * SAMPLE beginnings of texts
    h = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["h"], np.uint64) for r in seen)])
    words, count = np.unique(h, return_counts=True)
    short = words[np.argsort(-count, kind="stable")[:SHORT]]
    by_word = np.bincount(((h >> np.uint64(40)) % np.uint64(LOADS)).astype(np.int64), minlength=LOADS)
    by_pair = np.zeros(LOADS, np.int64)
    for r in seen:
        mine, piece = np.frombuffer(r["h"], np.uint64), np.frombuffer(r["piece"], np.int64)
        nxt = np.append(np.where(piece[1:] == piece[:-1], mine[1:], np.uint64(0)), np.zeros(min(1, len(mine)), np.uint64))
        by_pair += np.bincount(((mix(mine * np.uint64(3) + mix(nxt)) >> np.uint64(40)) % np.uint64(LOADS)).astype(np.int64), minlength=LOADS)
    room = max(16.0, FULL * len(h) / buckets)
    return Deal(short, *(np.minimum(np.ceil(x / room).clip(1), buckets).astype(np.int64) for x in (by_word, by_pair)), buckets)


def _with(df: DataFrame, keys: Sequence[str], table: DataFrame, value: str, common: Column, none: Column | None = None) -> DataFrame:
    """df left-joined with a value of table (keys are unique there), where a few keys may stand in very many rows of df.

    table's common rows, of which there are at most a few times COMMON, are broadcast; rows that found
    theirs there, and rows that look for none, are scattered by a second key, so the shuffle has no frequent key left.
    """
    near = table.where(common).select(*keys, F.col(value).alias("_near"))
    far = table.where(~common).select(*keys, F.col(value).alias("_far"), F.lit(0).alias("_tag"))
    held = df.join(F.broadcast(near), list(keys), "left")
    done = F.col("_near").isNotNull() if none is None else F.col("_near").isNotNull() | none
    held = held.withColumn("_tag", F.when(done, 1 + F.pmod(F.xxhash64(*df.columns), F.lit(4096))).otherwise(0).cast("int"))
    return held.join(far, [*keys, "_tag"], "left").select(*df.columns, F.coalesce("_near", "_far").alias(value))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10, within: int = 50, top: int = 2000) -> DataFrame:
    """The first top phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to max_words words within a piece of text; candidates occur at least least times
    (a).  The score is the lowest of floor(1000000 a a / (l r)) over the cuts of a phrase into two, l and r
    being its parts' counts; n counts the lang's words.  A candidate that a longer one holds
    is dropped if the longer one has at least within percent of its count.  Higher scores come first,
    then higher counts, then phrases in the order of their bytes.

    A null lang is und; null, empty and blank texts have no words; a lang without candidates returns
    nothing.  Repeated rows count each.  Other columns are ignored.  Words are told apart by 64-bit
    hashes.  The result is a table in the shared folder.
    """
    if not 2 <= max_words <= 8:
        raise ValueError("max_words is 2 to 8")
    spark, width, least = docs.sparkSession, max_words, max(1, least)
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    w = [f"w{k + 1}" for k in range(width)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = _sampled(docs, width, 4 * parts)
    codes = [f"{x}{k}" for k in range(width) for x in ("c", "h")]
    names = ["lang", "bucket", "count", *codes, "spell_words", "spell_sizes", "spell"]
    sent = docs.mapInArrow(_count_blocks(deal, width, names), f"lang string, bucket long, {', '.join(f'{x} binary' for x in names[2:])}")
    sent = sent.repartition(parts, "lang", "bucket").sortWithinPartitions("lang", "bucket")
    schema = f"lang string, {', '.join(f'{x} long' for x in w)}, c long, word string"
    folded, folded_path = write_table(sent.mapInArrow(_merge(deal, width, least), schema), "windows")

    windows = folded.where("c is not null").select("lang", *w, "c")
    sums = windows.rollup("lang", *w).agg(F.sum("c").alias("f"), F.grouping_id("lang", *w).alias("g"))
    # the level of a sum is the number of words it goes by; a padded last word belongs to a shorter phrase
    size = F.lit(None).cast("int")
    for k in range(width + 1):
        size = F.when(F.col("g") == (1 << (width - k)) - 1, k).otherwise(size)
    sums = sums.withColumn("size", size).where("size is not null")
    ended = F.lit(False)
    for k in range(1, width + 1):
        ended = ended | ((F.col("size") == k) & (F.col(w[k - 1]) == 0))
    zero = [F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in w]
    sums = sums.where(~ended & ((F.col("size") == 0) | (F.col("f") >= least)))
    sums, sums_path = write_table(sums.select("lang", "size", *zero, "f"), "phrase-counts")

    total = sums.where("size = 0").select("lang", F.col("f").alias("n"))  # a row for each lang
    everything = total.agg(F.sum("n").alias("n")).first()["n"] or 0
    common = F.col("f") * COMMON >= max(1, everything)
    counts = sums.where("size > 0")
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")

    # all cuts: the parts' counts are at least the phrase's own, so they are among those kept
    def part(a: int, b: Column | int) -> list[Column]:
        """Words a+1 to b of a candidate as keys, padded."""
        return [F.when(F.lit(a + k) < b, F.col(w[a + k])).otherwise(F.lit(0)).cast("long") if a + k < width else F.lit(0).cast("long") for k in range(width)]

    cuts = None
    for k in range(1, width):
        one = candidates.where(F.col("size") > k).select("lang", "size", *w, "a", F.lit(k).alias("k"), *[x.alias(f"l{i}") for i, x in enumerate(part(0, k))], *[x.alias(f"r{i}") for i, x in enumerate(part(k, F.col("size")))])
        cuts = one if cuts is None else cuts.unionByName(one)
    for side in ("l", "r"):
        keyed = counts.select("lang", *[F.col(x).alias(f"{side}{i}") for i, x in enumerate(w)], F.col("f"), F.col("f").alias(side))
        cuts = _with(cuts, ["lang", *[f"{side}{i}" for i in range(width)]], keyed, side, common)
    wide = [F.col(x).cast("decimal(19,0)") for x in ("a", "l", "r")]
    whole = (F.lit(1_000_000).cast("decimal(7,0)") * F.col("a")).cast("decimal(19,0)") * wide[0]
    product = wide[1] * wide[2]
    cuts = cuts.withColumns({"_whole": whole, "_product": product}).withColumn("score", F.expr("_whole div _product"))
    scored = cuts.groupBy("lang", "size", *w, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))

    # the largest count of a longer candidate around each phrase
    around = None
    for j in range(2, width):
        for a in range(width - j + 1):
            inner = [F.col(w[a + k]) if k < j else F.lit(0).cast("long") for k in range(width)]
            one = candidates.where(F.col("size") >= max(j + 1, a + j)).select("lang", *[x.alias(f"x{i}") for i, x in enumerate(inner)], "a")
            around = one if around is None else around.unionByName(one)
    kept = scored.select("lang", "size", *w, "a", "s.score", "s.l", "s.r")
    if around is not None:
        around = around.groupBy("lang", *[f"x{i}" for i in range(width)]).agg(F.max("a").alias("longer")).withColumnsRenamed({f"x{i}": x for i, x in enumerate(w)})
        kept = kept.join(around, ["lang", *w], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))).drop("longer")

    spelt = folded.where("c is null").select("lang", F.col("w1").alias("h"), "word")
    spelt = spelt.join(counts.where("size = 1").select("lang", F.col("w1").alias("h"), "f"), ["lang", "h"])
    named = kept
    for k, x in enumerate(w):
        table = spelt.select("lang", F.col("h").alias(x), "f", F.col("word").alias(f"s{k}"))
        named = _with(named, ["lang", x], table, f"s{k}", common, F.col(x) == 0)
    named = named.withColumn("phrase", F.concat_ws(" ", *[f"s{k}" for k in range(width)]))
    ranked = named.select("lang", "phrase", "a", "l", "r", "score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    for keys in (["lang", "part"], ["lang"]):  # 16 * top rows of a lang at most reach one task
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    out = materialize(ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    for path in (folded_path, sums_path):
        remove(spark, path)
    return out
