"""Ranked lexical search over bags that are scored once.

Documents are cut down to the vocabulary of the items that ask.  What is left of a document, its
counts of those terms and its length class m, is its bag: documents with equal bags score alike
for every item.  Bags are told apart by a hash, and by their bytes where hashes agree; each
distinct one is scored once for all items through the items' posting lists, and only the classes
that can reach an item's result are expanded to documents, in ascending order of doc_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.chunks import texts_of
from rillstone.llm.kernels import BASE, BYTE_CODES, LOWER, blocks, mix
from rillstone.storage import materialize, remove, write_table

#: Distinct (item, term) pairs of the items that are searched for at a time: what tasks get of them stays below some 50 MB.
ITEM_TERMS = 1_000_000
#: Cells of the score matrix (bags x items) that a task holds at a time, and postings that it adds up at a time.
CELLS, POSTINGS = 1 << 21, 1 << 21
#: Classes to expand are broadcast if there are no more than this, 8 bytes each; else they meet the documents in a shuffle.
WANTED = 100_000
#: Bytes that end a term: ASCII other than digits and letters.
_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def terms(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each term, its bytes lower-cased in A-Z, and the number of its text.

    Terms are the maximal runs of ASCII letters, digits and other characters than ASCII.
    """
    empty = np.zeros(0, np.uint64)
    if not len(data):
        return empty, empty, np.zeros(0, np.int64)
    ink = ~_BREAK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | cut[1:-1]
    first = np.flatnonzero(begin)
    if not len(first):
        return empty, empty, np.zeros(0, np.int64)
    stop = ink.copy()
    stop[:-1] &= ~ink[1:] | cut[1:-1]
    length = (np.flatnonzero(stop) + 1 - first).astype(np.uint64)
    inside = (np.arange(len(data)) - first[np.maximum(np.cumsum(begin) - 1, 0)]).astype(np.uint64)
    code = BYTE_CODES[LOWER[data]]
    one, two = mix(code + inside * np.uint64(BASE)), (code ^ (code >> np.uint64(29))) * (inside * np.uint64(2) + np.uint64(1))
    one[~ink], two[~ink] = 0, 0
    return mix(np.add.reduceat(one, first) + length), mix(np.add.reduceat(two, first) ^ length), np.searchsorted(starts, first, "right") - 1


class Vocabulary:
    """The terms of a set of items by number, and the items that hold each."""

    def __init__(self, one: np.ndarray, two: np.ndarray, item: np.ndarray):
        """Arrays of the same length: the hashes of a term and an item with it; each (term, item) once."""
        order = np.lexsort((item, two, one))
        one, two, item = one[order], two[order], item[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.one, self.two = one[new], two[new]
        self.items, number = np.unique(item, return_inverse=True)
        self.posted, self.ends = number, np.append(np.flatnonzero(new), len(one))

    def __len__(self) -> int:
        return len(self.one)

    def numbers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for those of no item."""
        if not len(self):
            return np.full(len(one), -1)
        # equal first hashes lie side by side; a second look tells the few apart that agree in it
        at = np.searchsorted(self.one, one)
        out = np.full(len(one), -1)
        for shift in range(int(np.unique(self.one, return_counts=True)[1].max())):
            k = np.minimum(at + shift, len(self) - 1)
            same = (self.one[k] == one) & (self.two[k] == two)
            out[same] = k[same]
        return out


def length_class(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with n terms each: 50 + (50 n documents) div total."""
    if int(n.max(initial=0)) * 50 * documents < 2**63:
        return 50 + (50 * documents * n) // total
    return np.array([50 + (50 * int(x) * documents) // total for x in n], np.int64)


def term_weight(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2 documents + 2) / (2 df + 1))), in doubles."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def scores(vocabulary: Vocabulary, weight: np.ndarray, bag: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (bags x items) of bags given as rows (bag number, term, tf); m holds one value a bag."""
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[bag]))
    bag, term, part = bag[part > 0], term[part > 0], part[part > 0]
    size = np.diff(vocabulary.ends)[term]
    ends = np.cumsum(size)
    out = np.zeros(len(m) * len(vocabulary.items), np.int64)
    # sums of doubles are exact below 2^53
    small = int(weight.max(initial=0)) * 1_000_000 * max(1, len(vocabulary)) < 2**53
    a = 0
    while a < len(term):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + POSTINGS, "right")))
        n, stop = size[a:b], ends[a:b] - (ends[a - 1] if a else 0)
        item = vocabulary.posted[np.arange(stop[-1]) + np.repeat(vocabulary.ends[term[a:b]] - (stop - n), n)]
        cell = np.repeat(bag[a:b] * len(vocabulary.items), n) + item
        low, high = int(bag[a]) * len(vocabulary.items), (int(bag[b - 1]) + 1) * len(vocabulary.items)
        if small:
            out[low:high] += np.bincount(cell - low, np.repeat(part[a:b], n).astype(float), high - low).astype(np.int64)
        else:
            np.add.at(out, cell, np.repeat(part[a:b], n))
        a = b
    return out.reshape(len(m), -1)


def _bags(vocabulary: Vocabulary):
    """Rows (doc, n, vec): the terms of a text, all and those of the vocabulary as pairs (number, count) of 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts_of(batch.column(1))
            for i, j in blocks(starts, 1 << 16):
                one, two, text = terms(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
                count = np.bincount(text, minlength=j - i)
                known = vocabulary.numbers(one, two)
                key, tf = np.unique(text[known >= 0] * (len(vocabulary) + 1) + known[known >= 0], return_counts=True)
                owner, number = np.divmod(key, len(vocabulary) + 1)
                pairs = np.stack([number, tf], 1).astype(np.uint32).tobytes()
                ends = (8 * np.searchsorted(owner, np.arange(j - i + 1))).astype(np.int32)
                vec = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(count), vec], names=["doc", "n", "vec"])

    return run


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df, docs, total) as far as a task has seen them; documents and terms in all stand at term -1."""
    df, docs, total = np.zeros(0, np.int64), 0, 0
    for batch in batches:
        n = batch.column(0).to_numpy()
        docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        number = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)[::2]
        here = np.bincount(number, minlength=len(df))
        here[: len(df)] += df
        df = here
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(df[held], docs)), pa.array(np.append(0 * held, total))], names=["term", "df", "total"])


def _best_rows(item: np.ndarray, score: np.ndarray, least: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each item: higher scores first, then the smaller least doc_id, then the smaller class."""
    order = np.lexsort((row, least, -score, item))
    first = np.flatnonzero(np.r_[True, item[order][1:] != item[order][:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def _search(docs: DataFrame, vocabulary: Vocabulary, k: int) -> DataFrame:
    """(item, rank, doc, score) for the items of one vocabulary."""
    spark = docs.sparkSession
    bags, bags_path = write_table(docs.mapInArrow(_bags(vocabulary), "doc long, n long, vec binary"), "bags")
    seen = bags.select("n", "vec").mapInArrow(_document_counts, "term long, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    df, documents, total = np.zeros(len(vocabulary), np.int64), 0, 0
    for r in seen.collect():  # at most a row for each term of the vocabulary, which is bounded
        if r["term"] < 0:
            documents, total = r["df"], r["total"]
        else:
            df[r["term"]] = r["df"]
    weight = term_weight(df, documents)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = length_class(batch.column(1).to_numpy(), documents, max(1, total))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m), batch.column(2)], names=["doc", "m", "vec"])

    # documents without a term of any item score 0 and end here, as do those without an id
    rows = bags.where("doc is not null and length(vec) > 0").mapInArrow(classed, "doc long, m long, vec binary").withColumn("hash", F.xxhash64("m", "vec"))
    # equal hashes meet, and within a hash only equal bytes are one class; tasks merge what they hold before rows move
    classes, classes_path = write_table(rows.groupBy("hash", "m", "vec").agg(F.min("doc").alias("least")), "bag-classes")
    parts = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, floor = [np.zeros(0, np.int64) for _ in range(4)], np.ones(len(vocabulary.items), np.int64)
        step = max(1, CELLS // max(1, len(vocabulary.items)))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                vec = batch.column(3).to_pylist()
                flat = np.frombuffer(b"".join(vec), np.uint32).astype(np.int64)
                bag = np.repeat(np.arange(len(vec)), [len(v) // 8 for v in vec])
                found = scores(vocabulary, weight, bag, flat[::2], flat[1::2], batch.column(2).to_numpy())
                i, j = np.nonzero(found >= floor)
                new = (j, found[i, j], batch.column(1).to_numpy()[i], batch.column(0).to_numpy()[i])
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
                best = _best_rows(*held, k)
                held = [x[best] for x in held]
                full = np.bincount(held[0], minlength=len(floor)) == k
                least = np.full(len(floor), np.iinfo(np.int64).max)
                np.minimum.at(least, held[0], held[1])
                floor[full] = least[full]
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(vocabulary.items[held[0]]), *map(pa.array, held[1:])], names=["item", "score", "least", "hash"])

    # the k best classes hold the k best documents: each class before another has a document before all of the other's
    hits = classes.select("hash", "least", "m", "vec").mapInArrow(score, "item long, score long, least long, hash long")
    hits = hits.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    for keys in (["item", "part"], ["item"]):
        hits = hits.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "least", "hash"))).where(F.col("k") <= k)
    hits, hits_path = write_table(hits.select("item", "score", "least", "hash"), "bag-hits")
    # the members of the classes that were hit: first the k smallest of each in a part of the table, then of all
    wanted = hits.select("hash").distinct()
    members = rows.join(F.broadcast(wanted) if k * len(vocabulary.items) <= WANTED else wanted, "hash", "left_semi").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16)))
    few = members.withColumn("k", F.row_number().over(Window.partitionBy("hash", "m", "vec", "part").orderBy("doc"))).where(F.col("k") <= k)
    few = few.groupBy("hash", "m", "vec", "part").agg(F.collect_list("doc").alias("docs"))  # k ids at most
    few = few.groupBy("hash", "m", "vec").agg(F.slice(F.array_sort(F.flatten(F.collect_list("docs"))), 1, k).alias("docs"))  # 16 lists at most
    few = few.select("hash", F.array_min("docs").alias("least"), "docs")
    expanded = hits.join(few, ["hash", "least"]).select("item", "score", F.explode("docs").alias("doc"))  # k * k rows of an item at most
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))
    out = materialize(expanded.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "rank", "doc", "score"), "bag-search")
    for path in (bags_path, classes_path, hits_path):
        remove(spark, path)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = 50, item_terms: int = ITEM_TERMS) -> DataFrame:
    """The k best documents of each item: item_col, rank (from 1), id_col, score.

    A term is a maximal run of characters other than ASCII signs, spaces and controls, with A-Z
    lower-cased.  The score sums weight * saturated count over an item's distinct terms, all in whole
    numbers; documents that score 0 are no answers, equal scores go by ascending id.  Null texts have
    no terms; documents without a term count in no statistic.  A document with a null id counts in the
    statistics but is no answer; rows that repeat an id are documents of their own.  Items
    with a null id or without terms return nothing, and rows that repeat an item's id are one item
    with the terms of all.  Items are searched for in blocks of about item_terms terms, each of which
    goes over all documents once.  Other columns are ignored.  The result is a table in the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts_of(batch.column(1))
            one, two, text = terms(data, starts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["item", "one", "two"])

    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where("item is not null")
    asked, asked_path = write_table(asked.mapInArrow(of_items, "item long, one long, two long").distinct(), "item-terms")
    count = asked.count()
    in_blocks = max(1, -(-count // item_terms))
    out = spark.createDataFrame([], "item long, rank int, doc long, score long") if not count else None
    for b in range(in_blocks if count else 0):
        pairs = asked.where(F.pmod(F.xxhash64("item"), F.lit(in_blocks)) == b).toPandas()  # about item_terms rows
        if len(pairs):
            block = Vocabulary(pairs["one"].to_numpy().view(np.uint64), pairs["two"].to_numpy().view(np.uint64), pairs["item"].to_numpy())
            found = _search(docs, block, k)
            out = found if out is None else out.unionByName(found)
    remove(spark, asked_path)
    return out.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
