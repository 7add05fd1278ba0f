"""Quality by naive Bayes support vectors.

A text's features are indicators of n-grams: of its words, of their shapes (runs of capitals, small
letters, digits and each sign), and of how neighbouring words repeat.  Each indicator is scaled by
the log ratio of its counts in the two classes, texts are scaled to length one, and a linear
model with hinge loss is fitted by dual coordinate descent.  Margins of folds that a model has not
seen give the sigmoid that turns a margin into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.llm.chunks import texts_of
from rillstone.llm.kernels import BASE, BYTE_CODES, LOWER, SPACE, blocks, mix
from rillstone.storage import remove, write_table

#: At most so many labelled rows are learned from, and so many n-grams kept, those that tell the classes apart best.
LEARN_ROWS = 20_000
FEATURES = 20_000
#: An n-gram is kept if so many learning rows have it.
LEAST_ROWS = 3
#: Added to each count before the ratio.
SMOOTH = 1.0
#: Cost of the hinge loss, passes over the rows, folds of the calibration.
COST, PASSES, FOLDS = 1.0, 20, 3
#: Classes of bytes: capitals, small letters (all beyond ASCII too), digits; signs stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 65, 97, 97, 48
_KINDS = np.random.default_rng(1313).integers(1, 1 << 63, 8, dtype=np.uint64)


def grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all n-grams of texts and the numbers of their texts; repeated ones as often as they occur."""
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(data):
        return nothing
    ink = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | cut[1:-1]
    first = np.flatnonzero(begin)
    if not len(first):
        return nothing
    number = np.maximum(np.cumsum(begin) - 1, 0)
    inside = (np.arange(len(data)) - first[number]).astype(np.uint64)
    code = mix(BYTE_CODES[LOWER[data]] + inside * np.uint64(BASE))
    code[~ink] = 0
    word = mix(np.add.reduceat(code, first))
    # a shape is the string of classes where they change
    kind = _CLASS[data]
    change = begin.copy()
    change[1:] |= ink[1:] & (kind[1:] != kind[:-1])
    at = np.flatnonzero(change)
    order = np.arange(len(at)) - np.searchsorted(at, first)[number[at]]
    code = mix(BYTE_CODES[kind[at]] + order.astype(np.uint64) * np.uint64(BASE))
    shape = mix(np.add.reduceat(code, np.searchsorted(at, first)))
    text = np.searchsorted(starts, first, "right") - 1
    two, three = text[1:] == text[:-1], text[2:] == text[:-2]
    again = word[1:] == word[:-1]
    out = [
        (mix(word + _KINDS[0]), text),
        (mix(word[:-1] * np.uint64(3) + mix(word[1:] + _KINDS[1]))[two], text[1:][two]),
        (mix(shape + _KINDS[2]), text),
        (mix(shape[:-1] * np.uint64(3) + mix(shape[1:] + _KINDS[3]))[two], text[1:][two]),
        (mix(mix(shape[:-2] * np.uint64(3) + mix(shape[1:-1] + _KINDS[4])) * np.uint64(3) + shape[2:])[three], text[2:][three]),
        (np.repeat(mix(_KINDS[5:6]), int((two & again).sum())), text[1:][two & again]),
        (np.repeat(mix(_KINDS[6:7]), int((three & again[1:] & again[:-1]).sum())), text[2:][three & again[1:] & again[:-1]]),
    ]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def indicators(known: np.ndarray, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct known n-grams of each text as (text, number in the ascending hashes known), sorted."""
    parts = [np.zeros(0, np.int64)]
    for i, j in blocks(starts, 1 << 16):
        h, text = grams(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
        if len(h) and len(known):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            parts.append(np.unique((text[hit] + i) * len(known) + at[hit]))
    return np.divmod(np.concatenate(parts), max(1, len(known)))


def log_count_ratio(good: np.ndarray, bad: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """log of the n-grams' shares of all counts in the one class over those in the other."""
    p, q = good + smooth, bad + smooth
    return np.log((p / p.sum()) / (q / q.sum())) if len(p) else p


def dual_descent(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, width: int, cost: float = COST, passes: int = PASSES, seed: int = 13) -> tuple[np.ndarray, float]:
    """Weights and offset of the linear model with least |w|^2 / 2 + cost * sum of hinge losses, by dual coordinate descent.

    Row i has values[starts[i]:starts[i + 1]] in columns of the same places; y is 1 or -1.  The offset is
    the weight of one more feature that is always 1.  It ends after passes, or when no dual variable would move by more than 0.01.
    """
    w, b, alpha = np.zeros(width), 0.0, np.zeros(len(y))
    square = np.add.reduceat(np.append(values.astype(float) ** 2, 0), np.minimum(starts[:-1], len(values))) if len(y) else np.zeros(0)
    square = np.where(np.diff(starts) > 0, square, 0) + 1
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        most = 0.0
        for i in rng.permutation(len(y)).tolist():
            a, z = starts[i], starts[i + 1]
            c, v = columns[a:z], values[a:z]
            gradient = y[i] * (float(w[c] @ v) + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            move = new - alpha[i]
            if move:
                alpha[i] = new
                w[c] += move * y[i] * v
                b += move * y[i]
                most = max(most, abs(move))
        if most < 0.01:
            break
    return w, b


def sigmoid_of(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that tells the classes (y is 1 or -1) best by their margins; targets are drawn in a little, by the classes' sizes."""
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    s, o = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(s * margin + o).clip(-35, 35)))
        d, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * margin).sum() + 1e-3 * s, d.sum()])
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2 / max(1e-12, float(np.abs(step).max())))
        s, o = s - step[0], o - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(s), 1e-6), float(o)


class QualityModel:
    """Kept n-grams (ascending hashes), their log count ratios and weights, the offset, and the sigmoid."""

    def __init__(self, known: np.ndarray, ratio: np.ndarray, weight: np.ndarray, offset: float, slope: float, shift: float):
        self.known, self.ratio, self.weight, self.offset, self.slope, self.shift = known, ratio, weight, offset, slope, shift

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = len(starts) - 1
        text, number = indicators(self.known, data, starts)
        length = np.sqrt(np.bincount(text, self.ratio[number] ** 2, n))
        margin = np.bincount(text, self.ratio[number] * self.weight[number], n) / np.where(length > 0, length, 1) + self.offset
        return 1 / (1 + np.exp(-(self.slope * margin + self.shift).clip(-35, 35)))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that nothing may be learned from: crc32 of the id as text leaves 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learn_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_rows: int = LEARN_ROWS, features: int = FEATURES) -> QualityModel:
    """Fit the model on at most learn_rows labelled rows that are not held out.

    Of labels, null ids and labels other than 0 and 1 are ignored; an id with several labels takes the largest.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(learn_rows)
    # at most learn_rows ids: bounded, so it may be broadcast; rows that repeat an id count once, by the least text
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marked), "id")
    rows, path = write_table(rows.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y"), "quality-rows")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts_of(batch.column(0))
            y = batch.column(1).to_numpy()
            for i, j in blocks(starts, 1 << 20):
                h, text = grams(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
                order = np.lexsort((text, h))
                h, text = h[order], text[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                h, side = h[new], y[i:j][text[new]]
                one, at = np.unique(h, return_index=True)
                good = np.add.reduceat(side, at) if len(at) else side
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(good.astype(np.int64)), pa.array(np.diff(np.append(at, len(h))) - good)], names=["h", "good", "bad"])

    sides = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sides.get(1, 0), sides.get(0, 0)
    none = np.zeros(0)
    if not n1 or not n0:
        remove(spark, path)
        return QualityModel(np.zeros(0, np.uint64), none, none, 0.0, 1.0, float(np.log((n1 + 1) / (n0 + 1))))
    counted = rows.mapInArrow(count, "h long, good long, bad long").groupBy("h").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    # how far the counts are from what equal rates would give
    p1, p0, both = (F.col("good") + 0.5) / (n1 + 1), (F.col("bad") + 0.5) / (n0 + 1), (F.col("good") + F.col("bad") + 1) / (n1 + n0 + 2)
    gain = F.col("good") * F.log(p1 / both) + F.col("bad") * F.log(p0 / both)
    kept = counted.where(F.col("good") + F.col("bad") >= LEAST_ROWS).orderBy(F.desc(gain), "h").limit(features).collect()
    kept = sorted(kept, key=lambda r: r["h"] % (1 << 64))
    known = np.array([r["h"] for r in kept], np.int64).view(np.uint64)
    ratio = log_count_ratio(np.array([r["good"] for r in kept], float), np.array([r["bad"] for r in kept], float))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts_of(batch.column(0))
            text, number = indicators(known, data, starts)
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
            hits = [number[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.binary()), batch.column(1)], names=["hits", "y"])

    # at most learn_rows rows of at most as many numbers as there are n-grams kept; ordered, so that a fit can be repeated
    seen = rows.mapInArrow(look, "hits binary, y int").orderBy(F.xxhash64("hits"), "hits", "y").collect()
    remove(spark, path)
    columns = np.frombuffer(b"".join(r["hits"] for r in seen), np.int32)
    starts = np.append(0, np.cumsum([len(r["hits"]) // 4 for r in seen]))
    y = np.array([1.0 if r["y"] == 1 else -1.0 for r in seen])
    owner = np.repeat(np.arange(len(y)), np.diff(starts))
    values = ratio[columns]
    length = np.sqrt(np.bincount(owner, values**2, len(y)))
    values = (values / np.where(length > 0, length, 1)[owner]).astype(np.float32)

    def fit(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        inside = chosen[owner]
        return dual_descent(np.append(0, np.cumsum(np.diff(starts)[chosen])), columns[inside], values[inside], y[chosen], len(known))

    margin, fold = np.zeros(len(y)), np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        w, b = fit(fold != k) if len(np.unique(y[fold != k])) == 2 else (np.zeros(len(known)), 0.0)
        margin[fold == k] = (np.bincount(owner, values * w[columns], len(y)) + b)[fold == k]
    slope, shift = sigmoid_of(margin, y)
    w, b = fit(np.ones(len(y), bool))
    return QualityModel(known, ratio, w, b, slope, shift)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_rows: int = LEARN_ROWS, features: int = FEATURES) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Labels serve only to learn, and only those of rows that are not held out (held_out()); a score
    looks at the whole text alone.  A null text scores as an empty one, by the offset.  Without labels of both kinds
    all score alike, by the labels' smoothed share; without any, 0.5.  Rows that repeat an id are
    scored on their own.  Other columns are returned as they are; columns named like the three new ones are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = learn_quality(docs, labels, id_col, text_col, label_col, learn_rows, features)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(*texts_of(batch.column(at))))], names=[*batch.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumns({"held_out": held_out(id_col), "predicted": (F.col("score") >= 0.5).cast("int")})
