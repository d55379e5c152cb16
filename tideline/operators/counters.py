"""Counters per shard and what is counted off them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.sequence import position
from tideline.operators.ordering import dense_counter
from tideline.operators.sizing import keyed_join
from tideline.schema import POSITION_FIELDS, SHARD_KEYS


def drop_ignored(records: DataFrame, ignored: Column) -> DataFrame:
    """Leave out what the sink ignores; such rows get no counter and block nothing."""
    return records.filter(~F.coalesce(ignored, F.lit(False)))


def arrival_counter(
    records: DataFrame,
    ignored: Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
    name: str = "counter",
    **sizing,
) -> DataFrame:
    """Dense 0-based arrival counter per shard over the records not ignored."""
    if ignored is not None:
        records = drop_ignored(records, ignored)
    return dense_counter(records, name=name, keys=keys, **sizing)


def count_checkpoints(
    records: DataFrame, every: int = 11, keys: Sequence[str] = SHARD_KEYS, **sizing
) -> DataFrame:
    """Every ``every``-th record of a shard, numbered: the checkpoints of a worker
    that asks for one once it has counted ``every - 1`` records since the last."""
    counted = arrival_counter(records, keys=keys, **sizing)
    return counted.filter((F.col("counter") + 1) % every == 0).withColumn(
        "checkpoint_no", F.floor(F.col("counter") / F.lit(every)).cast("bigint")
    )


def flush_by_count(
    records: DataFrame,
    capacity: int,
    ignored: Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """Number the batches of a sink that is full at ``capacity`` records.

    The record that finds the sink full starts the next batch, so a batch is
    flushed exactly when it has a successor.
    """
    counted = arrival_counter(records, ignored, keys=keys, **sizing)
    return counted.withColumn("batch_no", F.floor(F.col("counter") / F.lit(capacity)).cast("bigint"))


def latest_checkpoint(records: DataFrame, keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """Newest record of each shard and the number of records, in one map-side combined pass."""
    return records.groupBy(*keys).agg(
        F.max(position()).alias("_p"), F.count(F.lit(1)).alias("n_records")
    ).select(*keys, *[F.col(f"_p.{c}").alias(c) for c in POSITION_FIELDS], "n_records")


def shard_counters(
    records: DataFrame,
    checkpoints: DataFrame | None = None,
    ignored: Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
) -> DataFrame:
    """Records seen (ignored ones not counted) and checkpoints requested, per shard."""
    seen = F.lit(1) if ignored is None else F.when(~F.coalesce(ignored, F.lit(False)), 1)
    counts = records.groupBy(*keys).agg(F.count(seen).alias("n_records"))
    if checkpoints is None:
        return counts.withColumn("n_checkpoints", F.lit(0).cast("bigint"))
    asked = checkpoints.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_checkpoints"))
    # Both sides have one row per shard by now.
    return keyed_join(counts, asked, keys, "left").withColumn(
        "n_checkpoints", F.coalesce("n_checkpoints", F.lit(0))
    )
