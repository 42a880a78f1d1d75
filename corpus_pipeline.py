"""From raw documents to token ids: quality, exact and near duplicates, mixing, encoding.

Each stage takes what the stage before kept, as a table with the columns of documents; the last adds the
token ids. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from winnow.llm import bpe, exact_dedup, mixing, near_dedup, quality
from winnow.llm.common import Scratch

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the thresholds of their language and source."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in order of virtual time: a row per copy that it takes."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the bytes they decode to."""
    rows = docs.select("doc_id", "text", "lang", "source")
    return bpe.digests(rows, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True).select(
        "doc_id", "lang", "source", "bpe.*")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", byte_bpe),
]

ORACLE_SQL = None       # sketches, hashes and tokens have no SQL form; the tests hold each stage to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), str(i))
        if i:
            scratch.drop(str(i - 1))
    return docs
