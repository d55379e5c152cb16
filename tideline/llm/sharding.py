"""Weighted rendezvous hashing of record keys to shards, and gapless slots inside each shard.

Every (key, shard) pair draws a number u in (0, 1) from a hash; the record
goes to the shard with the smallest -ln(u) / weight. Only the key and the
shard's own number and weight enter, so another shard takes records only into
itself, and shares follow the weights. Expressions only.

A NULL key is a key of its own: all its rows share a shard. Rows with equal
keys share a shard; slots number rows, so repeated rows get slots of their
own. NULL or empty texts weigh the fixed part of the size only. Other columns
are left out of the report. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import bucket_bits, md5_bits, running

HEX_DIGITS = 13
#: Rows that one task numbers.
ROWS_PER_BUCKET = 1_000_000


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that the key and the shard decide."""
    digest = F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, HEX_DIGITS)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16**HEX_DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """struct<score, shard> of the winning shard: the smallest score, ties to the smaller number."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct((-F.log(draw(text, i)) / float(w)).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.least(*scores) if len(scores) > 1 else scores[0]


def assign_shards(
    df: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 40, added: float = 1.0
) -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard``, its shard after one more of weight ``added`` has joined."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    n = len(weights)
    df = df.withColumn("_best", rendezvous(F.col(key), weights))
    newcomer = -F.log(draw(text, n)) / float(added)
    return df.withColumns(
        {
            "shard": F.col("_best.shard"),
            "grown_shard": F.when(newcomer < F.col("_best.score"), F.lit(n)).otherwise(F.col("_best.shard")),
        }
    ).drop("_best")


def shard_report(
    df: DataFrame, shards: int = 40, fixed_bytes: int = 16, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """One row per document: size, checksum, shard, its shard after growth, and a slot in hash order.

    Texts are read where they lie; what moves is a few numbers per row. A slot
    is the row's place in its shard by the hash of key and text.
    """
    text = F.coalesce("text", F.lit(""))
    rows = assign_shards(
        df.select(
            "doc_id",
            (F.octet_length(text) + fixed_bytes).cast("bigint").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        ),
        weights=(1.0,) * shards,
    )
    key = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"))
    rows = rows.withColumn("_h", md5_bits(key))
    bits = bucket_bits(df.count() // shards, rows_per_bucket)
    placed = running(rows, "shard", "_h", ["doc_id", "text_crc32", "size"], F.lit(0), bits)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("pos").alias("slot"),
        "grown_shard",
    )
