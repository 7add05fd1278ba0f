"""The corpus pipeline, stage by stage against plain versions, on documents with every odd case."""

import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from rillstone.llm.sentencepiece_codec import codec_report
from rillstone.llm.toxicity import score_toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
PASSAGE = "a passage of some length that three of the documents below hold in the midst of their other words"
LINE = "All rights reserved, see the licence."


def documents():
    rng = np.random.default_rng(21)
    prose = lambda n: " ".join(rng.choice(WORDS, n))
    texts = [prose(60) for _ in range(30)]
    texts += [texts[0], texts[1], texts[2] + " more", texts[3].replace(texts[3].split()[30], "other", 1)]
    texts += [f"{prose(30)} {PASSAGE} {prose(30)}" for _ in range(3)] + [f"{prose(40)}\n{LINE}\n{prose(40)}" for _ in range(4)]
    texts += [None, "", "\n\n", "one two", "one two", "é日本 😀\x00 naïve", "z" * 3000, prose(30_000)]
    texts += [f"{prose(20)} you stupid idiot moron, shut up you idiot {prose(10)}" for _ in range(25)]
    return [(i, t, "en" if i % 3 else None, "web", None if t is None else len(t), "clash", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars int, kept string, n_lines int"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    toxic = [(i, 1, int("idiot" in (t or ""))) for i, t, *_ in rows]
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def plain_lines(docs):
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate({i: i + 32 for i in range(65, 91)})
    holders = {}
    for i, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return {i: t if t is None else "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in docs.items()}


def plain_near(docs):
    sets = {}
    for i, t in docs.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: t for i, t in docs.items() if find(i) == i}


def plain_repeats(docs):
    seen, out = set(), {}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        mine = [raw[k : k + 50] for k in range(len(raw) - 49)]
        gone = {k + d for k, x in enumerate(mine) if x in seen for d in range(50)}
        seen.update(mine)
        out[i] = docs[i] if docs[i] is None else bytes(b for k, b in enumerate(raw) if k not in gone).decode("utf-8", "replace")
    return out


def test_each_stage_equals_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    plain = {"line_dedup": plain_lines, "near_dup": plain_near, "suffix_dedup": plain_repeats}
    for name, stage in P.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = P.materialize(stage(spark, docs, folder), name)
        if name == "packing":
            break
        assert after.columns == columns
        now = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "toxicity":
            assert all("idiot" in (before[i] or "") for i in before.keys() - now.keys()) and len(before) - len(now) >= 20
        else:
            assert now == plain[name](before)
        assert after.where("n_chars is distinct from char_length(text)").count() == 0
        docs = after
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in sorted(after.collect(), key=lambda r: (r["doc_id"], r["start"])):
        assert pieces.get(r["doc_id"], 0) == r["start"]
        pieces[r["doc_id"]] = r["start"] + r["length"]
    assert pieces == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in now.items()}


def test_whole_run_and_empty_tables(spark, folder, tmp_path):
    whole = P.run(spark, folder)
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and whole.count() > 40
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_empty_documents(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    assert score_toxicity(docs.limit(0), labels).count() == 0
    assert score_toxicity(docs, labels.limit(0)).agg(F.count("*")).first()[0] == docs.count()
    assert codec_report(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
