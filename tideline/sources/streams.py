"""Several streams side by side, start positions and bounded fetches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.sequence import is_sub_record, order_key, place_key, position
from tideline.operators.counters import arrival_counter
from tideline.operators.sizing import lookup
from tideline.schema import SHARD_KEYS, STREAM


def union_streams(streams: Mapping[str, DataFrame]) -> DataFrame:
    """All streams in one DataFrame, each row tagged with its stream's name."""
    if not streams:
        raise ValueError("no streams given")
    tagged = [df.withColumn(STREAM, F.lit(name)) for name, df in streams.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stream_tip(records: DataFrame, keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """Newest position of every shard, one row per shard."""
    return records.groupBy(*keys).agg(F.max(position()).alias("_p")).select(
        *keys, *[F.col(f"_p.{c}").alias(c) for c in ("base", "base_key", "sub", "user_sub", "user_total")]
    )


def _after(records: DataFrame, marks: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Records behind their shard's mark, and all records of unmarked shards."""
    mark_key = [
        place_key("base_key").alias("k_base"),
        F.coalesce(F.col("sub"), F.lit(0)).cast("bigint").alias("k_sub"),
        F.coalesce(F.col("user_sub"), F.lit(0)).cast("bigint").alias("k_user_sub"),
    ]
    marks = marks.filter(F.col("base_key").isNotNull()).select(*keys, F.struct(*mark_key[:parts]).alias("_mark"))
    row_key = F.struct(*[order_key()[f].alias(f) for f in ("k_base", "k_sub", "k_user_sub")[:parts]])
    joined = lookup(records, marks, keys, "left")
    return joined.filter(F.col("_mark").isNull() | (row_key > F.col("_mark"))).drop("_mark")


def initial_position(
    records: DataFrame, position: str = "LATEST", tip: DataFrame | None = None, keys: Sequence[str] = SHARD_KEYS
) -> DataFrame:
    """Where a new shard starts: everything, or only what lies behind ``tip``.

    ``tip`` is a snapshot from :func:`stream_tip`; shards it does not know are new
    since then and are read from their beginning.
    """
    if position == "TRIM_HORIZON":
        return records
    if position != "LATEST":
        raise ValueError("position is 'LATEST' or 'TRIM_HORIZON'")
    if tip is None:
        raise ValueError("LATEST needs a tip snapshot")
    return _after(records, tip, keys, 3)


def resume_from_checkpoint(
    records: DataFrame, checkpoints: DataFrame, granularity: str = "base_sub", keys: Sequence[str] = SHARD_KEYS
) -> DataFrame:
    """Records behind the last checkpoint of their shard; others start from scratch.

    ``base_sub`` resumes as the daemon does: what it stores does not tell the
    records of an own-format aggregate apart, so an aggregate is either passed
    or read again whole. A checkpoint in the middle of an aggregate then re-reads
    it. ``user_sub`` resumes after the very record. A checkpoint may be a marker:
    the beginning (all records follow), the tip or the shard's end (none do).
    """
    if granularity == "user_sub":
        return _after(records, checkpoints, keys, 3)
    if granularity != "base_sub":
        raise ValueError("granularity is 'base_sub' or 'user_sub'")
    inside = is_sub_record()
    # One step back for a checkpoint inside an aggregate: replay the aggregate.
    passed = F.struct(
        place_key("base_key").alias("k_base"),
        (F.coalesce(F.col("sub"), F.lit(0)) - F.when(inside, 1).otherwise(0)).cast("bigint").alias("k_sub"),
    )
    marks = checkpoints.filter(F.col("base_key").isNotNull()).select(*keys, passed.alias("_mark"))
    row_key = F.struct(order_key()["k_base"].alias("k_base"), order_key()["k_sub"].alias("k_sub"))
    joined = lookup(records, marks, keys, "left")
    return joined.filter(F.col("_mark").isNull() | (row_key > F.col("_mark"))).drop("_mark")


def fetch_batches(records: DataFrame, max_records: int = 1000, keys: Sequence[str] = SHARD_KEYS, **sizing) -> DataFrame:
    """Number the bounded deliveries a consumer would receive, ``fetch`` per shard."""
    counted = arrival_counter(records, keys=keys, name="_n", **sizing)
    return counted.withColumn("fetch", F.floor(F.col("_n") / F.lit(max_records)).cast("bigint")).drop("_n")
