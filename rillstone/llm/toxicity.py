"""Toxicity by weak supervision.

Many voters look at each text: lexicons of insults, patterns of address and shouting, and words
and word beginnings that learning rows' labels point to.  A generative label model estimates, by
expectation maximisation, how often each voter fires on toxic and on clean texts, and from what is
left over how voters depend on one another; correlated voters share their weight.  A linear
classifier is then trained on the posterior labels and scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: At most so many labelled rows are learned from, and so many features kept for each side.
LEARN_ROWS = 20_000
FEATURES = 400
PREFIXES = (3, 4, 5, 6, 7)

LEXICONS: dict[str, set[str]] = {
    "stupidity": {"idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "fool", "dimwit", "halfwit", "dunce"},
    "worth": {"worthless", "useless", "loser", "losers", "pathetic", "failure", "nobody", "pitiful"},
    "filth": {"trash", "garbage", "scum", "filth", "filthy", "vermin", "disgusting", "vile", "revolting"},
    "ridicule": {"clown", "clowns", "joke", "laughable", "freak", "creep", "weirdo"},
    "hate": {"hate", "despise", "loathe", "kill", "die", "hang"},
    "german": {"idiot", "dummkopf", "trottel", "blödmann", "arschloch", "abschaum", "versager", "widerlich", "dreck"},
    "french": {"idiot", "imbécile", "crétin", "connard", "salaud", "ordure", "minable", "dégoûtant"},
    "spanish": {"idiota", "imbécil", "estúpido", "estúpida", "basura", "escoria", "perdedor", "asqueroso"},
}
PATTERNS: dict[str, re.Pattern] = {
    "address": re.compile(r"\byou(?:'re| are)? (?:an? |such an? )?(?:idiot|moron|loser|clown|fool|trash|scum|pathetic|stupid|worthless|disgusting)", re.I),
    "command": re.compile(r"\b(?:shut up|get lost|go to hell|drop dead|nobody likes you)\b", re.I),
    "masked": re.compile(r"\b\w[*#@$]{2,}\w*\b"),
    "shouting": re.compile(r"[A-Z]{4,}(?:\W+[A-Z]{3,}){3,}"),
    "exclaiming": re.compile(r"!{3,}"),
}
_word = re.compile(r"\w+")


def features_of(text: str | None) -> set[str]:
    """Distinct words and, marked by ^, their beginnings, in lower case."""
    out = set(_word.findall((text or "").lower()))
    return out | {f"^{w[:k]}" for w in out for k in PREFIXES if len(w) > k}


def hits_of(text: str | None, known: dict[str, int], first_voter: int) -> list[int]:
    """Numbers of the known features and, from first_voter on, of the fixed voters that a text has."""
    text = text or ""
    words = set(_word.findall(text.lower()))
    out = {known[w] for w in words if w in known}
    for k in PREFIXES:
        out.update(known[p] for w in words if len(w) > k and (p := f"^{w[:k]}") in known)
    for j, lexicon in enumerate(LEXICONS.values()):
        if not words.isdisjoint(lexicon):
            out.add(first_voter + j)
    for j, pattern in enumerate(PATTERNS.values()):
        if pattern.search(text):
            out.add(first_voter + len(LEXICONS) + j)
    return sorted(out)


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row, each voter's rates (toxic, clean), and its share of weight.

    votes is rows x voters, 1 where a voter fires.  gold is a label, or nan: it enters as one more
    voter that is seldom wrong.  The share is 1 / (1 + the voter's positive correlations with others
    within a class), so voters that repeat one another count about once.
    """
    n, m = votes.shape
    any_hit = votes.any(1)
    post = np.where(np.isnan(gold), np.where(any_hit, 0.6, 0.05), np.where(gold == 1, 0.95, 0.05))
    prior_gold = np.where(np.isnan(gold), 0, np.where(gold == 1, 1, -1)) * np.log(0.97 / 0.03)
    share = np.ones(m)
    rates = np.zeros((2, m))
    for step in range(rounds):
        prior = post.mean().clip(0.001, 0.999)
        rates[0] = (post @ votes + 0.1) / (post.sum() + 1)
        rates[1] = ((1 - post) @ votes + 0.1) / (n - post.sum() + 1)
        if step % 10 == 5 and m:
            excess = np.zeros((m, m))
            for side, weight in ((0, post), (1, 1 - post)):
                left = (votes - rates[side]) * np.sqrt(weight)[:, None]
                cov = left.T @ left
                scale = np.sqrt(np.diag(cov)) + 1e-9
                excess = np.maximum(excess, cov / scale[:, None] / scale[None, :])
            np.fill_diagonal(excess, 0)
            share = 1 / (1 + excess.clip(0, 1).sum(1))
        on, off = np.log(rates[0] / rates[1]), np.log((1 - rates[0]).clip(1e-9) / (1 - rates[1]).clip(1e-9))
        logit = np.log(prior / (1 - prior)) + prior_gold + votes @ (share * (on - off)) + (share * off).sum()
        post = 1 / (1 + np.exp(-logit.clip(-30, 30)))
    return post, rates, share


def fit_linear(x: np.ndarray, target: np.ndarray, steps: int = 600, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient steps with momentum."""
    n, m = x.shape
    w, b = np.zeros(m), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    v, s = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ w + b).clip(-30, 30)))
        error = (p - target) / n
        g = np.append(x.T @ error + ridge * w, error.sum())
        v, s = 0.9 * v + 0.1 * g, 0.999 * s + 0.001 * g * g
        move = 0.1 * (v / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:m], b - move[m]
    return w, b


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts of few rows, so that few texts are Python strings at a time."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


class ToxicityModel:
    """The classifier: features and voters by number, their weights and the offset."""

    def __init__(self, known: dict[str, int], weights: np.ndarray, offset: float):
        self.known, self.weights, self.offset = known, weights, offset

    def score(self, text: str | None) -> float:
        total = self.offset + float(self.weights[hits_of(text, self.known, len(self.known))].sum())
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, total)))))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that nothing may be learned from: crc32 of the id as text divides by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn_rows: int = LEARN_ROWS, features: int = FEATURES) -> ToxicityModel:
    """Fit the model on at most learn_rows labelled rows that are not held out.

    Of labels, null ids and labels other than 0 and 1 are ignored; an id with several labels takes the largest.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(learn_rows)
    # at most learn_rows ids: bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marked), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (Counter(), Counter())
        for batch in batches:
            for part in slices(batch):
                for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    sides[y].update(features_of(text))
                    sides[y][""] += 1
        for y, side in enumerate(sides):
            names = list(side)
            for k in range(0, len(names), 50_000):
                part = names[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([y] * len(part), pa.int32()), pa.array([side[f] for f in part])], names=["f", "y", "c"])

    counted = rows.select("text", "y").mapInArrow(count, "f string, y int, c long")
    counted = counted.groupBy("f").agg(F.sum(F.when(F.col("y") == 1, F.col("c")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("c")).otherwise(0)).alias("b"))
    total = counted.where("f = ''").first()
    n1, n0 = (total["a"], total["b"]) if total else (0, 0)
    fixed = len(LEXICONS) + len(PATTERNS)
    if not (n1 and n0):
        return ToxicityModel({}, np.full(fixed, 2.0), -3.0)
    p1, p0 = (F.col("a") + 0.2) / (n1 + 0.4), (F.col("b") + 0.2) / (n0 + 0.4)
    # how far a feature's counts are from what equal rates would give, with its sign
    both = (F.col("a") + F.col("b") + 0.4) / (n1 + n0 + 0.8)
    gain = F.col("a") * F.log(p1 / both) + F.col("b") * F.log(p0 / both)
    ranked = counted.where("f <> '' and a + b >= 3").withColumn("gain", F.when(p1 > p0, gain).otherwise(-gain))
    toxic = ranked.where("gain > 4").orderBy(F.desc("gain"), "f").limit(features)
    clean = ranked.where("gain < -4").orderBy("gain", "f").limit(features // 4)
    known = {r["f"]: i for i, r in enumerate([*toxic.select("f").collect(), *clean.select("f").collect()])}
    first = len(known)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            hits = [hits_of(text, known, first) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), batch.column(1)], names=["hits", "y"])

    seen = rows.select("text", "y").mapInArrow(look, "hits array<int>, y int").collect()  # at most learn_rows rows
    x = np.zeros((len(seen), first + fixed), np.float32)
    for i, r in enumerate(seen):
        x[i, r["hits"]] = 1
    gold = np.array([r["y"] for r in seen], float)
    post, _, _ = label_model(x, gold)
    weights, offset = fit_linear(x, post)
    return ToxicityModel(known, weights, offset)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn_rows: int = LEARN_ROWS, features: int = FEATURES) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Labels serve only to learn, and only those of rows that are not held out (held_out()); a score
    looks at the whole text alone.  A null text scores as an empty one.  Without labels of both kinds the
    fixed lexicons and patterns decide.  Rows that repeat an id are scored on their own.  Other
    columns are returned as they are; columns named like the three new ones are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = learn_toxicity(docs, labels, id_col, text_col, label_col, learn_rows, features)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            scores = [model.score(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumns({"held_out": held_out(id_col), "predicted": (F.col("score") >= 0.5).cast("int")})
