"""A corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.line_dedup import drop_common_lines
from rillstone.llm.near_dup import near_duplicates
from rillstone.llm.packing import pack_documents
from rillstone.llm.suffix_dedup import remove_repeats
from rillstone.llm.toxicity import score_toxicity
from rillstone.storage import materialize


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """changed with docs' columns; n_chars follows the text."""
    columns: list[Column] = [F.col(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
        columns = [length if c == "n_chars" else F.col(c) for c in docs.columns]
    return changed.select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted as toxic go."""
    return score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents hold stay in the last of them only."""
    return _like(docs, drop_common_lines(docs))


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds go."""
    return _like(docs, remove_repeats(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dup", near_dup), ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: Toxicity scores and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what one keeps is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not packing:
            docs = materialize(docs, name)
    return docs
