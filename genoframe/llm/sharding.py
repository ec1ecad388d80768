"""Sharding by weighted rendezvous hashing of a stable key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.llm.shared import gapless
from genoframe.scratch import written

#: Bytes that a record takes besides its text.
RECORD_BYTES = 8


def _score(key: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u), u in (0, 1) from 53 bits of the hash of key and shard; it does not depend on other shards."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
    return F.lit(-float(weight)) / F.ln(u)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to len(weights) - 1) with the highest score for the key; of equal scores the lowest shard.

    A shard's expected share is its weight's. A shard added at the end takes rows only into itself, about
    its share of all; equal keys always meet. A null key is a key like any other.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, one for each shard")
    best = F.array_max(F.array(*[F.struct(_score(key, s, w).alias("score"), F.lit(-s).alias("shard")) for s, w in enumerate(weights)]))
    return (-best["shard"]).cast("int")


def shards(docs: DataFrame, weights: Sequence[float], added: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus 8. A null text has no bytes and the CRC of the empty text. slot counts
    from 0 without gaps within a shard. grown_shard: the shard if one more shard of weight `added` (by default
    the last one's) stood at the end. Only the key decides on the shard; repeated rows get slots of their own.
    An empty table returns no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), [*weights, weights[-1] if added is None else added]).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    numbered = gapless(written(placed), "shard", [F.col("id"), F.col("_row")], "slot", F.xxhash64("_row"))
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")
