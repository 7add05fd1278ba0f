"""The queries of the numbered operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.bag_search import ranked_search
from rillstone.llm.collocations import collocations
from rillstone.llm.embedding_dedup import duplicate_vectors
from rillstone.llm.line_dedup import drop_common_lines
from rillstone.llm.near_dup import near_duplicates
from rillstone.llm.packing import pack_documents
from rillstone.llm.quality import score_quality
from rillstone.llm.sentencepiece_codec import codec_report
from rillstone.llm.sharding import shard_documents
from rillstone.llm.suffix_dedup import remove_repeats
from rillstone.llm.token_files import read_token_files, write_token_files
from rillstone.llm.toxicity import score_toxicity
from rillstone.llm.topk_search import top_k_search


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k_search(vectors, vectors.where("vec_id % 50 = 0"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.encode("text", "utf-8"), F.lit(b"")), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    docs = read_token_files(manifest)
    return docs.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shard_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return docs.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_packing": op2_packing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_sharding": op9_sharding,
    "op10_near_dup": op10_near_dup,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_quality": op13_quality,
}

SQL: dict[str, str] = {
    "op1_topk_search": """
        WITH whole AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, unnest(range(len(v))) AS i, unnest(v) AS x FROM whole),
        scores AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
          FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5""",
    "op3_embedding_dedup": """
        WITH RECURSIVE good AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        unit AS (
          SELECT vec_id, list_transform(v, lambda x: x / n) AS v FROM (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM good) WHERE n > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) >= 0.9),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
               least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
               e.vec_id <= coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
        FROM embeddings e""",
    "op5_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, unnest(range(len(l))) AS k, unnest(l) AS line
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (
          SELECT doc_id, k, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        often AS (
          SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        judged AS (
          SELECT k.doc_id, k.k, k.line, o.key IS NOT NULL AND k.doc_id <> o.last AS gone
          FROM keyed k LEFT JOIN often o ON k.key = o.key)
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op10_near_dup": r"""
        WITH RECURSIVE cut AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM cut),
        parts AS (SELECT doc_id, unnest(s) AS x FROM sets),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM parts a JOIN parts b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
        least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
        FROM sets LEFT JOIN least_of ON a = doc_id""",
    "op11_ranked_search": r"""
        WITH cut AS (
          SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        asked AS (
          SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM cut WHERE len(t) > 0),
        counts AS (SELECT row, doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT row, doc_id, t, unnest(t) AS term FROM cut) u GROUP BY ALL),
        weights AS (
          SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
          FROM counts, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
        parts AS (
          SELECT row, doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS s
          FROM counts c JOIN weights USING (term), whole),
        scores AS (SELECT item_id, row, doc_id, CAST(sum(s) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0 AND doc_id IS NOT NULL AND item_id IS NOT NULL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op12_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        cut AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
          SELECT lang, unnest(w) AS p, 1 AS size FROM cut
          UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))), 2 FROM cut
          UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))), 3 FROM cut),
        f AS (SELECT lang, p, size, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, p, size, f AS a, string_split(p, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
        cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
        scored AS (
          SELECT c.lang, c.p, c.size, c.a, c.k, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
          FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.w[1:c.k], ' ') JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.w[c.k + 1:c.size], ' ')),
        lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS i FROM scored) s WHERE i = 1),
        around AS (
          SELECT lang, p, max(a) AS longer FROM (
            SELECT lang, array_to_string(w[1:2], ' ') AS p, a FROM candidates WHERE size = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE size = 3) x GROUP BY ALL),
        kept AS (SELECT s.* FROM lowest s LEFT JOIN around o ON o.lang = s.lang AND o.p = s.p WHERE o.longer IS NULL OR 100 * o.longer < 50 * s.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
        SELECT r.lang, rank, p AS phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000""",
}
