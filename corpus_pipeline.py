"""Training corpus from documents: quality, near-duplicates, mixing, tokens; each stage takes all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from genoframe.llm import bpe, mixing, nearcopies, quality
from genoframe.llm.entry import MIX, MIX_REST


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five-word shingles, likeness 0.8 or more) the document with the smallest id."""
    return nearcopies.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources keep to their target weights."""
    return mixing.in_mixed_order(docs, MIX, MIX_REST)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and source of each document, in the order that it comes in, with its tokens, their count, and digests of them and of what they decode to."""
    return bpe.with_digests(bpe.coded(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["source"]))


STAGES = [("quality", keep_quality), ("near-duplicates", drop_near_duplicates), ("mixing", mix_sources), ("BPE", encode)]
#: Trained models, hashes of shingles and merges are not SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
