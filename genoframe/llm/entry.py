"""The queries of this subpackage, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import ann, bpe, centroids, fingerprints, lm, mixing, quality, sharding, simhash, tokencounts, urls, warc, whitening


#: Target parts of the mix: src0, the largest source, is held at a fifth; sources that are not named share the rest.
MIX = {"src0": 20, **{f"src{i}": 4 for i in range(1, 20)}}
MIX_REST = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"), [1.0] * 24)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs, MIX, MIX_REST)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(spark, _table(spark, sf_dir, "pages"))
    return found.where("gap_start is null").select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(_table(spark, sf_dir, "embeddings"))


_QUERIES = (op1_rendezvous, op2_token_counts, op3_neighbours, op4_bpe, op5_fingerprints, op6_mixing, op7_quality, op8_warc, op9_simhash, op10_urls, op11_whitening, op12_lm, op13_centroids)
_SQL = {"op8_warc": warc.ARCHIVED_SQL, "op10_urls": urls.judge_sql(), "op13_centroids": centroids.clusters_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
