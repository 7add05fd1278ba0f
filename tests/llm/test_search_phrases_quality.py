"""Ranked search, collocations and quality against plain versions, with nulls, ties, repeated rows and empty tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rillstone.llm import bag_search, collocations as phrases, quality
from rillstone.llm.bag_search import ranked_search
from rillstone.llm.collocations import collocations
from rillstone.llm.quality import score_quality

DOCS = "doc_id long, text string, lang string, score double, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_search(docs, items, k):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(TERM.findall(lower(t)))
    out = []
    for item, words in asked.items():
        scored = []
        for doc, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n_docs) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m)) for t in words if bag[t])
            if s > 0 and doc is not None:
                scored.append((-s, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def corpus(n, seed=5):
    rng = random.Random(seed)
    words = ["the", "OF", "and", "sea", "Élan", "x1", "river", "stone", "rare", "naïve"]
    texts = [" ".join(rng.choices(words, [30, 20, 10, 5, 3, 2, 2, 1, 1, 1], k=rng.randint(1, 30))) + rng.choice([".", "\nThe sea, the stone; a b!", "", "!"]) for _ in range(n)]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(1000 + i, texts[3]) for i in range(70)] + [(2000, None), (2001, ""), (2002, "  ...\n"), (None, "river stone"), (5, "river rare"), (5, "river rare"), (2003, "long " * 30_000 + "stone")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("item_terms", [1_000_000, 4])
def test_ranked_search_equals_a_plain_one(spark, item_terms):
    docs = corpus(120)
    items = [(1, "the SEA, the stone"), (2, "élan x1 naïve"), (3, None), (4, ""), (None, "sea"), (5, "river"), (5, "rare"), (6, "unknown words only"), (7, "and")]
    table = spark.createDataFrame([(i, t, "en", 1.0, 2) for i, t in docs], DOCS).repartition(7)
    out = ranked_search(table, spark.createDataFrame(items, "item_id long, text string"), k=9, item_terms=item_terms)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect())) == plain_search(docs, items, 9)


def test_ranked_search_of_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "sea")], "item_id long, text string")
    some = spark.createDataFrame([(1, "sea", "en", 1.0, 2)], DOCS)
    for docs, asked in ((none, items), (some, items.where("false")), (none, items.where("false")), (some.withColumn("text", some.lang), items)):
        assert ranked_search(docs, asked).collect() == []


def test_terms_whose_first_hashes_agree_stay_apart():
    one, two = np.array([5, 5, 9], np.uint64), np.array([1, 2, 3], np.uint64)
    known = bag_search.Vocabulary(one, two, np.array([10, 20, 10]))
    assert known.numbers(np.array([5, 5, 5, 9], np.uint64), np.array([2, 1, 7, 3], np.uint64)).tolist() == [1, 0, -1, 2]


def test_scores_beyond_doubles_are_exact():
    known = bag_search.Vocabulary(np.array([1, 2], np.uint64), np.array([1, 2], np.uint64), np.array([1, 1]))
    weight = np.array([2**40, 3])
    found = bag_search.scores(known, weight, np.array([0, 0]), np.array([0, 1]), np.array([3, 1]), np.array([77]))
    assert found.tolist() == [[2**40 * (3_000_000_000 // (3000 + 1540)) + 3 * (1_000_000_000 // (1000 + 1540))]]


def plain_collocations(docs, least, within, top, width):
    f, total = Counter(), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang or "und"] += len(w)
            for size in range(1, width + 1):
                f.update((lang or "und", *w[i : i + size]) for i in range(len(w) - size + 1))
    found = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    out = defaultdict(list)
    for (lang, *w), a in found.items():
        score, _, x, y = min((1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
        longer = [b for (other, *v), b in found.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= within * a for b in longer):
            out[lang].append((-score, -a, " ".join(w).encode(), x, y))
    return sorted((lang, r, p.decode(), -a, x, y, total[lang], -s) for lang, rows in out.items() for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1))


@pytest.mark.parametrize(("width", "least", "top"), [(3, 3, 2000), (2, 2, 7), (4, 2, 50)])
def test_collocations_equal_plain_ones(spark, width, least, top):
    rng = random.Random(width)
    words = ["the", "THE", "sea", "of", "stone", "New", "york", "ç", "x\x1fy", "a"]
    docs = [(" ".join(rng.choices(words, [9, 2, 3, 5, 2, 3, 3, 1, 1, 1], k=rng.randint(1, 25))) + rng.choice([". New York city", ",new york", "\r\nof\tthe  sea", ""]), rng.choice(["en", "en", "en", None, "de", "und"])) for _ in range(90)]
    docs += [("New York city hall! " * 30, "fr"), ("New York city hall! " * 30, "fr"), (None, "en"), ("", "es"), (" \n ", "es"), ("y " * 5000, "en")]
    table = spark.createDataFrame([(i, t, lang, 1.0, 2) for i, (t, lang) in enumerate(docs)], DOCS).repartition(6)
    out = collocations(table, max_words=width, least=least, top=top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == plain_collocations(docs, least, 50, top, width)


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert collocations(none).collect() == []
    assert collocations(spark.createDataFrame([(1, None, None, 1.0, 2), (2, "one two", "en", 1.0, 2)], DOCS)).collect() == []


def test_windows_of_seldom_phrases_fold_into_their_prefixes():
    rows = np.array([[1, 2, 3], [1, 2, 4], [1, 5, 0], [6, 7, 8]], np.uint64)
    ones = np.ones(4, np.uint64)
    folded, count = phrases._fold(rows, np.array([12, 1, 3, 2]), 10, ones, ones)
    assert list(zip(folded.tolist(), count.tolist(), strict=True)) == [([0, 0, 0], 2), ([1, 0, 0], 3), ([1, 2, 0], 1), ([1, 2, 3], 12)]
    # words that are dealt to several parts keep their rows, as their other windows lie elsewhere
    folded, count = phrases._fold(rows[3:], np.array([2]), 10, ones[3:] * np.uint64(4), ones[3:])
    assert folded.tolist() == [[6, 0, 0]] and count.tolist() == [2]


def labelled(n):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        words = rng.choices(["the", "sea", "of", "stone", "river", "and", "Light"], k=rng.randint(3, 40))
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), 0 if bad else 1))
    return rows


def test_quality_is_learned_without_the_held_out_rows(spark):
    rows = labelled(600)
    docs = spark.createDataFrame([(i, t, "en", 9.0, 2) for i, t, _ in rows] + [(9001, None, None, None, None), (9002, "", "en", 1.0, 1), (None, "the SEA", "en", 1.0, 1), (4, "THE!! SEA!! OF!!", "en", 1.0, 1)], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, 5)], "doc_id long, quality int")
    out = score_quality(docs, labels)
    assert out.columns == ["doc_id", "text", "lang", "rank", "score", "held_out", "predicted"]
    found = out.collect()
    assert len(found) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    truth = {i: y for i, _, y in rows}
    kept_back = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert 150 < len(kept_back) < 250 and sum(r["predicted"] == truth[r["doc_id"]] for r in kept_back) >= 0.98 * len(kept_back)
    # other labels of held-out rows, or other texts under them, change no score
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in score_quality(docs, flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-12 for r in found if r["doc_id"] != 4)
    empty = [r["score"] for r in found if not r["text"]]
    assert empty[0] == empty[1]


def test_quality_with_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", 1.0, 2), (2, None, "en", 1.0, 2)], DOCS)
    one = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    assert [r["score"] for r in score_quality(docs, one.where("false")).collect()] == [0.5, 0.5]
    assert all(r["predicted"] == 1 for r in score_quality(docs, one).collect())
    assert score_quality(docs.where("false"), one).collect() == []


def test_dual_descent_reaches_the_least_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0]) + 0.3 + 0.5 * rng.normal(size=80) > 0, 1.0, -1.0)
    starts, columns = np.arange(81) * 5, np.tile(np.arange(5), 80)
    w, b = quality.dual_descent(starts, columns, x.ravel(), y, 5, passes=3000)

    def loss(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (x @ w + b)).sum()

    best = loss(w, b)
    assert all(loss(w + 0.02 * d[:5], b + 0.02 * d[5]) > best - 0.02 for d in rng.normal(size=(300, 6)))


def test_ratio_is_that_of_the_shares():
    r = quality.log_count_ratio(np.array([3.0, 1.0]), np.array([0.0, 5.0]))
    assert np.allclose(r, np.log([(4 / 6) / (1 / 7), (2 / 6) / (6 / 7)]))
