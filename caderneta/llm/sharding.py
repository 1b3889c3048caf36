"""Operator 1, sharding: weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.tables import HASH_BITS, key_hash, load, running_starts, stored

SHARDS = 8


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard that wins ``key``: each shard draws -ln(u) / weight, the least wins.

    A shard's draw depends on the key and that shard alone, so a further shard takes
    rows only into itself, and a changed weight moves only that shard's share.  A null
    key is one key.  Ties go to the lower shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("each shard needs a weight above 0")
    scale = float(2**HASH_BITS)
    draws = [
        F.struct(
            (-F.ln((key_hash(key, str(shard)) + F.lit(0.5)) / F.lit(scale)) / F.lit(float(weight)))
            .alias("draw"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
    ]
    return F.array_min(F.array(*draws))["shard"]


def assign_shards(
    rows: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS,
    shard: str = "shard",
) -> DataFrame:
    """Adds the shard of each row; no row moves between partitions."""
    return rows.withColumn(shard, rendezvous_shard(F.col(key), weights))


def number_in_shards(rows: DataFrame, key: str = "doc_id", slot: str = "slot") -> DataFrame:
    """Adds a gapless number from 0 within each shard, by the hash of the key.

    ``rows`` has ``shard`` and columns narrow enough to shuffle; rows with one key go
    by their other columns, rows equal in all are numbered in a row.
    """
    ordered = rows.withColumn("_h", key_hash(F.col(key), "slot"))
    return running_starts(ordered, "shard", "_h", F.lit(1), slot).drop("_h")


def op1_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by law ``key``, and what a ninth shard would take.

    A null text has size 1 and no CRC; null and repeated ids are one key each, their
    rows still get slots of their own; an empty table gives no rows.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(narrow).withColumn(
        "grown_shard", rendezvous_shard(F.col("doc_id"), (1.0,) * (SHARDS + 1))
    )
    numbered = number_in_shards(stored(placed, "shards"))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _winner(shards: int) -> str:
    """DuckDB text: the shard whose draw is least."""
    draw = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{n}'), 1, 15))::BIGINT"
    draws = ", ".join(
        f"{{'draw': -ln(({draw.format(n=n)} + 0.5) / {float(2**HASH_BITS):.1f}), 'shard': {n}}}"
        for n in range(shards)
    )
    return f"list_min([{draws}]).shard"


# CRC-32 over the bytes, eight steps of its polynomial for each.
_CRC = """
list_reduce(
    list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda crc, byte: list_reduce(
        [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))
"""

ORACLES = {
    "op1_rendezvous_sharding": f"""
WITH placed AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
           xor({_CRC}, 4294967295)::BIGINT AS text_crc32,
           {_winner(SHARDS)} AS shard, {_winner(SHARDS + 1)} AS grown_shard,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':slot'), 1, 15))::BIGINT AS h
    FROM documents)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id, size, text_crc32) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard
FROM placed
"""
}
QUERIES = {"op1_rendezvous_sharding": op1_rendezvous_sharding}
