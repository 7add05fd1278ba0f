"""The numbered operators against brute force, round trips and held-out labels on small fixtures with every odd case."""

import hashlib
import io
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillstone.llm import chunks, line_dedup
from rillstone.llm.chunks import _payload, texts_of, unpack_array
from rillstone.llm.embedding_dedup import duplicate_vectors
from rillstone.llm.encode import WordEncoder
from rillstone.llm.line_dedup import PerfectHash, drop_common_lines
from rillstone.llm.near_dup import likelihood_similarity, near_duplicates, sketches
from rillstone.llm.packing import first_fit_decreasing, pack_documents
from rillstone.llm.sentencepiece_codec import Pieces, SentencePieceEncoder, codec_report
from rillstone.llm.sharding import place, ring, shard_documents
from rillstone.llm.suffix_dedup import remove_repeats, sort_suffixes
from rillstone.llm.token_files import TokenFileReader, read_token_files, write_token_files
from rillstone.llm.topk_search import top_k_search
from rillstone.llm.toxicity import label_model, score_toxicity

PASSAGE = "the quick brown fox jumps over the lazy dog and then runs far away from here again "
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def texts():
    rng = np.random.default_rng(3)
    out = [" ".join(rng.choice(WORDS, 40)) + "\n" + " ".join(rng.choice(WORDS, 30)) for _ in range(25)]
    out += [out[0], out[0], out[1] + " tail", out[2].replace("alpha", "beta", 1)]
    out += [PASSAGE + out[3][:80], out[4][:60] + PASSAGE, PASSAGE * 2, "A shared licence line, twenty chars\nx", "  a SHARED licence line, twenty chars\t\ny", "a shared licence line, twenty chars"]
    out += ["", None, "\n\n", " ", "one two", "One  TWO", "é日本 😀\x00 naïve  tab\tend\r\n", "z" * 3000, " ".join(WORDS) * 60]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i, "clash") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_lines long, kept string").repartition(3).cache()


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=8).tolist() for _ in range(300)] + [[1.0] * 8] * 150
    odd = [None, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [0.0] * 7, [0.0] * 8]
    rows = [(i, v, "x") for i, v in enumerate(vectors + odd)] + [(None, [1.0] * 8, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k_search(table, table.where("vec_id % 7 = 0"), pivots=8, part_rows=64).collect()}
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in enumerate(vectors)} | {454: np.zeros(8, int)}
    want = {}
    for q in good:
        if q % 7 == 0:
            best = sorted((-int(good[q] @ good[i]), i) for i in good if i != q)[:5]
            want |= {(q, k): (i, -s) for k, (s, i) in enumerate(best, 1)}
    assert got == want
    assert top_k_search(table.limit(0), table.limit(0)).count() == 0


def test_top_k_stops_early_on_clusters(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16))
    values = np.repeat(centres, 50, axis=0) + rng.normal(scale=0.02, size=(2000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    queries = table.where("vec_id % 50 = 0")
    compared = spark.sparkContext.accumulator(0)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k_search(table, queries, part_rows=256, compared=compared).collect()}
    whole = np.floor(256 * values).astype(int)
    for q in range(0, 2000, 50):
        score = whole @ whole[q]
        best = sorted((i for i in range(2000) if i != q), key=lambda i: (-score[i], i))[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, score[i]) for i in best]
    assert 0 < compared.value < 0.5 * 40 * 2000


def test_first_fit_decreasing():
    sizes = np.random.default_rng(0).integers(1, 101, 400)
    bins, offsets = first_fit_decreasing(sizes, 100)
    room, want = [], {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if k == len(room):
            room.append(100)
        want[i], room[k] = (k, 100 - room[k]), room[k] - sizes[i]
    assert all(want[i] == (bins[i], offsets[i]) for i in range(400))


def test_packing_holds_every_token_once(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = pack_documents(docs, path, length=64, group_bytes=2000).collect()
    ids, places = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert len(ids.setdefault(r["doc_id"], b"")) == 4 * r["start"] and len(r["ids"]) == 4 * r["length"]
        ids[r["doc_id"]] += r["ids"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(texts()):
        assert ids[i] == np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
    for held in places.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(held[-1]) <= 64
    assert pack_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_encoder_equals_the_library(name):
    encode = WordEncoder(public_tokenizers.path(name))
    some = [t or "" for t in texts()] + ["a  b", "don't 's it's\n's", "<|endoftext|> a", "ΑΣ ΑΣ.", "é ́a", "x y z", "Ａ１² ½", "İ ẞ", "a" * 1500 + " b", " lead", "trail "]
    ids, starts = encode(*texts_of(pa.array(some)))
    assert [ids[a:b].tobytes() for a, b in zip(starts, starts[1:])] == [encode.whole(t) for t in some]


def test_embedding_links_and_components(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    near = base[:5] + 0.02 * rng.normal(size=(5, 16))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(np.concatenate([base, near, np.repeat(base[:1], 40, 0)]))]
    rows += [(100, None, "x"), (101, [0.0] * 16, "x"), (102, [float("nan")] * 16, "x"), (103, [None] * 16, "x"), (104, [1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string")
    got = by_id(duplicate_vectors(table, block=8), "vec_id")
    assert len(got) == len(rows)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows if i < 100}
    for i, u in unit.items():
        linked = [j for j, w in unit.items() if j != i and u @ w >= 0.9]
        assert got[i]["n_links"] == len(linked)
        assert got[i]["component_id"] == min([i, *linked])
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(100, 105))
    assert duplicate_vectors(table.limit(0)).count() == 0


def test_suffix_order_and_groups():
    rng = np.random.default_rng(0)
    data = np.frombuffer(b"".join(rng.choice([b"abcabcabcd" * 3, PASSAGE.encode(), b"zq"], 200)), np.uint8)
    starts = np.arange(len(data) - 60)
    order, group = sort_suffixes(data, starts, 50)
    keys = [data[i : i + 50].tobytes() for i in starts[order]]
    assert keys == sorted(keys) and all((a == b) == (g == h) for a, b, g, h in zip(keys, keys[1:], group, group[1:]))


def test_repeats_go_as_by_brute_force(spark, docs):
    got = by_id(remove_repeats(docs.unionByName(spark.createDataFrame([(None, "x", "en", 1, "c")], docs.schema))))
    assert got.pop(None)["n_removed"] == 0
    seen: dict[bytes, int] = {}
    for i, t in enumerate(texts()):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        windows = [raw[k : k + 50] for k in range(len(raw) - 49)]
        for k, w in enumerate(windows):
            if seen.get(w, i) < i:
                gone[k : k + 50] = True
        for w in windows:
            seen.setdefault(w, i)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        assert (bytes(got[i]["kept_bytes"]), got[i]["n_removed"], got[i]["n_bytes"]) == (kept, gone.sum(), len(raw))
        assert got[i]["n_spans"] == (np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum() and got[i]["kept"] == "clash"
        assert (got[i]["text"] is None) == (t is None)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_perfect_hash_is_minimal_and_survives_storage():
    keys = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 5000, dtype=np.uint64))
    fn = PerfectHash.load(PerfectHash.build(keys).dump())
    assert np.array_equal(np.sort(fn(keys)), np.arange(len(keys)))
    assert len(PerfectHash.load(PerfectHash.build(keys[:0]).dump())(keys)) == len(keys)


def test_common_lines_go_as_by_brute_force(docs):
    strip = "[\x20\x09-\x0d]+"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(f"^{strip}|{strip}$", "", line))
    lines = {i: (t or "").split("\n") for i, t in enumerate(texts())}
    holders: dict[str, set[int]] = {}
    for i, own in lines.items():
        for k in {key(x) for x in own}:
            holders.setdefault(k, set()).add(i)
    got = by_id(drop_common_lines(docs))
    dropped = 0
    for i, own in lines.items():
        kept = [x for x in own if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        assert ((got[i]["text"] or ""), got[i]["n_lines"], got[i]["n_dropped"]) == ("\n".join(kept), len(own), len(own) - len(kept))
        dropped += len(own) - len(kept)
    assert dropped > 2 and drop_common_lines(docs.limit(0)).count() == 0
    small = by_id(drop_common_lines(docs, chunk_bytes=200, probes_per_task=5))
    assert {i: (r["text"], r["n_dropped"]) for i, r in small.items()} == {i: (r["text"], r["n_dropped"]) for i, r in got.items()}


def test_groups_of_line_probes_do_not_grow_with_the_chunks(spark):
    largest = []
    for n in (400, 800):
        docs = spark.range(n).selectExpr("id doc_id", "concat('a line that every document holds\n', repeat(concat('own line ', id), 9)) text")
        chunks, shards = line_dedup._chunks(docs, "doc_id", "text", 64)
        assert chunks.count() >= n
        index = line_dedup.line_index(docs, chunks=chunks, shards=shards)
        asking = line_dedup.per_row(lambda row: line_dedup._ChunkKeys(row, "doc_id", "text", shards, 20).probes(row["chunk"]), ["chunk", "bucket", "digest"], [pa.int64(), pa.int64(), pa.binary()])  # noqa: B023
        probes, copies = line_dedup.dealt(chunks.mapInArrow(asking, "chunk long, bucket long, digest binary"), index, 100)
        assert probes.join(copies, (probes.bucket == copies.shard) & (probes.part == copies.part)).count() == probes.count()
        largest.append(probes.groupBy("bucket", "part").count().agg(F.max("count")).first()[0])
        assert index.agg(F.sum("asked")).first()[0] == 2 * n
    assert max(largest) < 160 and largest[1] < 1.4 * largest[0]


def test_repeats_are_the_same_when_messages_merge(spark, docs):
    columns = ("doc_id", "kept_bytes", "n_removed", "n_spans")
    passage = "a passage of well over fifty bytes that every document of this table holds, whatever else it says"
    rows = spark.range(60).selectExpr("59 - id doc_id", f"concat('own words of number ', id, ' before ', '{passage}', ' and after it ', repeat(string(id % 3), 40)) text")
    for table in (docs.select("doc_id", "text"), rows):
        whole = sorted(remove_repeats(table).select(*columns).collect(), key=str)
        assert sum(r["n_removed"] for r in whole) > 100
        for hot in (4, 1 << 15):
            assert sorted(remove_repeats(table, hot=hot, chunk_bytes=100, fan=3).select(*columns).collect(), key=str) == whole


def test_merged_messages_meet_in_groups_of_bounded_size(spark):
    largest = []
    kinds = [("value", "long", pa.int64())]

    def answer(bucket, messages):
        assert len(messages) <= 32
        total = sum(m["value"] for m in messages)
        for m in messages:
            yield m["chunk"], bucket, total

    def spread(bucket, messages, found):
        assert len(messages) <= 32
        for m in messages:
            yield m["chunk"], bucket, found["value"]

    work = chunks.Exchange(kinds, kinds, answer, lambda b, messages: (sum(m["value"] for m in messages),), spread)
    for n in (500, 1000):
        messages = spark.range(n).selectExpr("id chunk", "0L bucket", "id value")
        largest.append({r["value"] for r in chunks.exchange(messages, n, work, 10).collect()})
        assert largest[-1] == {n * (n - 1) // 2}


def test_toxicity_learns_from_allowed_rows_alone(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = list(rng.choice(WORDS, 30)) + (["grumpf" + str(rng.choice(["a", "o", "is"])), "you", "idiot"][: 1 + i % 3] if toxic else [])
        rows.append((i, None if i == 599 else " ".join(words), 0.5))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    out = score_toxicity(docs, marks).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out) and len(out) == 600
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.95
    flipped = score_toxicity(docs, marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert {r["doc_id"]: r["score"] for r in out} == {r["doc_id"]: r["score"] for r in flipped.collect()}
    assert score_toxicity(docs, marks.limit(0)).where("score between 0 and 1").count() == 600


def test_label_model_shares_weight_among_copies():
    rng = np.random.default_rng(0)
    y = rng.random(800) < 0.3
    fires = lambda p, q: (rng.random(800) < np.where(y, p, q)).astype(np.float32)
    one = fires(0.8, 0.05)
    post, rates, share = label_model(np.stack([one, one, one, fires(0.7, 0.05), fires(0.6, 0.02)], 1), np.full(800, np.nan))
    assert share[:3].max() < 0.45 < share[3:].min() and ((post > 0.5) == y).mean() > 0.85 and rates.shape == (2, 5)


def test_token_files_round_trip(docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    manifest = write_token_files(docs, path, str(tmp_path / "t"), frame_tokens=100, partitions=3)
    got, start = by_id(read_token_files(manifest)), 0
    for i, t in enumerate(texts()):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], bytes(got[i]["ids"])) == (start, ids.tobytes())
        start += len(ids)
    file = manifest.orderBy("part").first()["path"]
    reader = TokenFileReader(file)
    assert len(reader.table) > 1 and all(np.array_equal(reader.document(k), ids) for k, (_, ids) in enumerate(reader))
    with open(file.removeprefix("file:"), "rb") as held:
        raw = bytearray(held.read())
    # a plain decoder passes over both tables, and the file ends with the format's magic number
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(raw)), read_across_frames=True).read()
    assert plain == b"".join(ids.astype("<u4").tobytes() for _, ids in reader) and raw[-4:] == struct.pack("<I", 0x8F92EAB1)
    raw[20] ^= 255
    (tmp_path / "bad.tok").write_bytes(raw)
    with pytest.raises(Exception):
        TokenFileReader(str(tmp_path / "bad.tok")).frame(0)
    assert write_token_files(docs.limit(0), path).count() == 0


def test_sentencepiece_equals_brute_force_and_round_trips(docs):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces = Pieces(file.read())
    encode = SentencePieceEncoder(pieces)
    value = {p: s for p, s, k in zip(pieces.pieces, pieces.scores, pieces.kinds) if k == 1}

    def best(text):
        text = "▁" + text.replace(" ", "▁")
        score, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
        for e in range(1, len(text) + 1):
            for s in range(max(0, e - 48), e):
                v = value.get(text[s:e], pieces.unknown_score if e - s == 1 else None)
                if v is not None and score[s] + v > score[e] + 1e-12:
                    score[e], back[e] = score[s] + v, s
        return score[-1]

    some = [t or "" for t in texts()]
    ids, starts = encode(*texts_of(pa.array(some)))
    for t, a, b in zip(some, starts, starts[1:]):
        mine = ids[a:b].tolist()
        assert pieces.decode(np.array(mine)) == t
        if t:
            at, total = 0, 0.0
            byte_ids = set(pieces.byte_ids.tolist())
            lost = bytes(int(pieces.pieces[i][1:-1], 16) for i in mine if i in byte_ids).decode()
            total = sum(pieces.scores[i] for i in mine if i not in byte_ids) + len(lost) * pieces.unknown_score
            assert at == 0 and abs(total - best(t)) < 1e-6
    rows = by_id(codec_report(docs, public_tokenizers.path("piece_bpe_32k.model")))
    assert all(r["round_trip"] for r in rows.values()) and len(rows) == len(some)
    for i, (a, b) in enumerate(zip(starts, starts[1:])):
        assert (rows[i]["n_ids"], rows[i]["ids_crc32"]) == (b - a, zlib.crc32(ids[a:b].astype("<u4")))
    # a long word is walked alone, to the same end
    odd = [("é日本😀\x00naïve▁" * 40).encode(), " ".join(WORDS).replace(" ", "▁").encode()]
    assert [pieces._walk(w) for w in odd] == pieces.segment(odd)
    # many texts at once are decoded as each alone, bytes that are no UTF-8 included
    mixed = np.concatenate([ids, pieces.byte_ids[[0xFF, 0x41]], ids[:5]])
    cuts = np.concatenate([starts, [len(ids) + 2, len(mixed)]])
    back, at = pieces.decode_block(mixed, cuts)
    for a, b, c, d in zip(cuts, cuts[1:], at, at[1:]):
        assert back[c:d].tobytes().decode("utf-8", "replace") == pieces.decode(mixed[a:b])


def test_codec_reports_each_row_of_odd_tables(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    schema = "doc_id long, text string, n_ids string"
    assert codec_report(spark.createDataFrame([], schema), path).count() == 0
    rows = [(1, "same", "x"), (1, "same", "y"), (None, "no id", "z"), (3, None, None), (4, "w" * 100_000 + " é" * 200_000, "long")]
    got = codec_report(spark.createDataFrame(rows, schema), path)
    assert got.columns == ["doc_id", "n_ids", "ids_crc32", "round_trip"]
    found = sorted(got.collect(), key=str)
    assert len(found) == 5 and all(r["round_trip"] for r in found)
    assert sum(r["doc_id"] == 1 for r in found) == 2 and {r["n_ids"] for r in found if r["doc_id"] == 3} == {0}


def test_shards_are_even_whole_and_stable(spark, docs):
    big = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 < 5, "same text").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")))).alias("text"))
    rows = shard_documents(big, 8).collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) <= 1.01 * sum(load.values()) / 8 + 80 and min(load.values()) > 0.97 * sum(load.values()) / 8
    assert len({r["shard"] for r in rows if r["text"] == "same text"}) == 1
    for shard in load:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) and r["grown_shard"] is None for r in rows)
    odd = by_id(shard_documents(docs))
    assert odd[36]["size"] == 1 and len(odd) == len(texts()) and shard_documents(docs.limit(0)).count() == 0
    places, owner = ring(5)
    more_places, more_owner = ring(6)
    assert [(p, s) for p, s in zip(more_places, more_owner) if s < 5] == list(zip(places, owner))
    weights = {c: 1 for c in range(0, 16000, 7)}
    a, b = place(weights, 5, slack=0.2), place(weights, 6, slack=0.2)
    assert np.mean([a[c] != b[c] for c in weights]) < 0.45


def test_shards_equal_a_plain_ring_at_the_real_slack(spark):
    rng = np.random.default_rng(5)
    weights = {int(c): int(w) for c, w in zip(rng.permutation(1 << 14)[:6000], rng.pareto(2, 6000) * 100 + 1)}

    def plain(shards):
        places, owner = ring(shards)
        limit = 1.001 * sum(weights.values()) / shards
        load, out = Counter(), {}
        heavy = [c for c in weights if weights[c] > limit * 0.001 / 2]
        for cell in sorted(heavy, key=lambda c: (-weights[c], c)) + sorted(c for c in weights if c not in set(heavy)):
            clockwise = sorted(range(len(places)), key=lambda i: (places[i] < cell, i))
            fits = [owner[i] for i in clockwise if load[owner[i]] + weights[cell] <= limit]
            out[cell] = fits[0] if fits else min(range(shards), key=lambda s: (load[s], s))
            load[out[cell]] += weights[cell]
        return out

    for shards in (16, 17):
        assert place(weights, shards) == plain(shards)
    before, after = place(weights, 16), place(weights, 17)
    assert sum(weights[c] for c in weights if before[c] != after[c]) < 0.2 * sum(weights.values())


def test_shards_number_repeated_and_missing_ids(spark):
    rows = [(i % 3 if i % 2 else None, "same" if i % 3 else None, "a", 7) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int").repartition(7)
    got = shard_documents(table, 4).collect()
    assert len(got) == 900 and sorted((r["shard"], r["slot"]) for r in got) == [(s, k) for s in sorted({r["shard"] for r in got}) for k in range(sum(r["shard"] == s for r in got))]
    assert all((r["size"], r["text_crc32"]) == ((1, 0) if r["text"] is None else (5, zlib.crc32(b"same"))) for r in got)
    assert shard_documents(table, 4, keep_text=False).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_near_duplicates_equal_brute_force(spark, docs):
    rows = near_duplicates(docs.unionByName(spark.createDataFrame([(None, "x y", "en", 1, "c")], docs.schema)), block=3).collect()
    got = {r["doc_id"]: r for r in rows}
    assert got.pop(None)["kept"] and len(rows) == len(texts()) + 1
    sets = {}
    for i, t in enumerate(texts()):
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    for i, a in sets.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(a), root[i], root[i] == i)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_sketch_estimates():
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.sort(pool[:2000]), np.sort(pool[400:2400])]
    owner = np.repeat([0, 1], [2000, 2000])
    s = sketches(np.concatenate(sets), owner, 2)
    estimate = likelihood_similarity(s[:1], s[1:], np.array([2000]), np.array([2000]))[0]
    assert abs(estimate - 1600 / 2400) < 0.08


def test_digest_of_kept_text(docs):
    kept = by_id(remove_repeats(docs).select("doc_id", "kept_bytes", F.sha2("kept_bytes", 256).alias("h")))
    assert all(hashlib.sha256(bytes(r["kept_bytes"])).hexdigest() == r["h"] for r in kept.values())


def test_hot_anchors_are_dealt_out_by_window(spark, docs):
    from rillstone.llm import suffix_dedup as X

    rng = np.random.default_rng(8)
    edge = lambda k: "".join(rng.choice(list("abcdefghijklmnop"), k))
    rows = [(i, f"{edge(60)} Licensed under the terms of use. {PASSAGE if i % 2 else PASSAGE[:40]}{edge(60)}") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    columns = ["doc_id", "kept_bytes", "n_removed", "n_spans"]
    for df in (table, docs):
        got = remove_repeats(df, hot=3).select(columns).orderBy("doc_id").collect()
        assert got == remove_repeats(df).select(columns).orderBy("doc_id").collect()
    # no bucket gets the windows of a hot anchor together
    n, buckets = 50, 8
    chunk = {"chunk": 0, "payload": _payload(pa.table({"doc_id": list(range(400)), "text": [f"{edge(60)} Licensed under the terms of use. {edge(60)}" for _ in range(400)]}))}
    most = {}
    for hot in (3, 1 << 15):
        answers = []
        for m in X._grams(chunk, "doc_id", "text", n, buckets):
            row = dict(zip(["chunk", "bucket", "hashes", "narrow", "shared", "times"], m))
            answers += [dict(zip(["chunk", "bucket", "often", "hot"], a)) for a in X._repeated(row["bucket"], [row], hot)]
        sent = [unpack_array(m[3], np.uint8).astype(int) - n + 1 for m in X._stretches(chunk | {"answers": answers}, "doc_id", "text", n, buckets) if m[1] >= 0]
        most[hot] = max(x.sum() for x in sent) / (sum(x.sum() for x in sent) / buckets)
    assert most[3] < 1.6 < most[1 << 15]


def test_an_odd_length_at_the_head_drops_no_other_vector(spark):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(40, 8))
    vectors[1] = vectors[0]
    rows = [(1000, [1.0] * 3)] + [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = by_id(duplicate_vectors(table), "vec_id")
    assert got[0]["n_links"] == got[1]["n_links"] == 1 and got[1000]["n_links"] == 0
    found = top_k_search(table, table, k=3, pivots=4, part_rows=16).collect()
    assert {r["query_id"] for r in found} == set(range(40)) and 1000 not in {r["vec_id"] for r in found}


def test_windows_sorted_in_parts_find_the_same_earlier_holders(monkeypatch):
    from rillstone.llm import suffix_dedup as X

    rng = np.random.default_rng(12)
    data = np.frombuffer(rng.choice(list(b"ab"), 400).astype(np.uint8).tobytes() * 3, np.uint8)
    starts = np.arange(len(data) - 50)
    holder = rng.integers(0, 9, len(starts))
    least: dict[bytes, int] = {}
    windows = [data[a : a + 50].tobytes() for a in starts]
    for w, h in zip(windows, holder.tolist(), strict=True):
        least[w] = min(h, least.get(w, h))
    expected = [least[w] < h for w, h in zip(windows, holder.tolist(), strict=True)]
    for most in (1 << 20, 100):
        monkeypatch.setattr(X, "SORTED", most)
        assert X._foreign(data, starts, holder, 50).tolist() == expected
    assert X._foreign(data, starts[:0], holder[:0], 50).tolist() == []


def test_classes_of_equal_vectors_count_every_row(spark):
    rng = np.random.default_rng(21)
    base = rng.normal(size=(6, 16))
    base[3] = base[2] + 0.05 * rng.normal(size=16)  # two classes that link
    base[4, 0] = 0.0
    rows = [(10 + i, base[i % 5].tolist()) for i in range(700)]
    rows += [(5000 + i, base[0].tolist()) for i in range(900)]
    rows += [(7000, [-0.0, *base[4, 1:].tolist()]), (9000, base[5].tolist()), (9001, (base[5] + 0.02 * rng.normal(size=16)).tolist())]
    # an id with two rows: one a copy in the largest class, one alone with a near vector
    rows += [(8000, base[0].tolist()), (8000, base[5].tolist()), (None, base[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = duplicate_vectors(table, block=64).collect()
    assert len(got) == len(rows)
    at = [(i, np.array(v)) for i, v in rows if i is not None]
    units = np.array([v / np.linalg.norm(v) for _, v in at])
    close = units @ units.T >= 0.9
    np.fill_diagonal(close, False)
    ids = np.array([i for i, _ in at])
    links: dict[int, int] = {}
    root = {i: i for i in ids.tolist()}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids.tolist()):
        links[i] = max(links.get(i, 0), int(close[k].sum()))
        for j in ids[close[k]].tolist():
            a, b = sorted((find(i), find(j)))
            root[b] = a
    for r in got:
        if r["vec_id"] is None:
            assert r["n_links"] == 0 and r["kept"]
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (links[r["vec_id"]], find(r["vec_id"]), find(r["vec_id"]) == r["vec_id"])


@pytest.mark.parametrize("label", [0, 1])
def test_toxicity_with_labels_of_one_class_goes_by_the_fixed_voters(spark, docs, label):
    marks = docs.where("doc_id is not null").select("doc_id", F.lit(label).alias("toxic"))
    got, without = by_id(score_toxicity(docs, marks)), by_id(score_toxicity(docs, marks.limit(0)))
    assert {i: r["score"] for i, r in got.items()} == {i: r["score"] for i, r in without.items()}


def test_rows_of_queries_that_repeat_an_id_are_one_query(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-4, 5, 8).astype(float).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    twice = [(7, [1.0] * 8), (7, [2.0] * 8), (8, [1.0] * 8), (8, [1.0] * 8)]
    got = top_k_search(table, spark.createDataFrame(twice, "vec_id long, embedding array<double>"), k=3, pivots=4, part_rows=16).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == [(q, k) for q in (7, 8) for k in (1, 2, 3)]
    for r in got:
        v = np.array(rows[r["vec_id"]][1])
        assert r["score"] in {int(65536 * (v @ np.array(q))) for i, q in twice if i == r["query_id"]}
