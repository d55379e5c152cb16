"""Counters of running streams: per shard in a table, in total as Spark's observed metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.operators.counters import shard_counters
from tideline.schema import SHARD_KEYS


class ShardCounters:
    """``foreachBatch`` sink that counts what goes by.

    A micro-batch adds one row per shard under ``path``, named by the batch's
    id, so a batch that is run again counts once. The same pass observes the
    totals of the batch: :attr:`observed` holds them by batch id, for progress
    reports, without reading anything again.
    """

    def __init__(self, path: str, ignored: Column | None = None, keys: Sequence[str] = SHARD_KEYS):
        self.path = path.rstrip("/")
        self.ignored = ignored
        self.keys = list(keys)
        self.observed: dict[int, dict[str, int]] = {}

    def __call__(self, batch: DataFrame, batch_id: int, checkpoints: DataFrame | None = None) -> None:
        """``checkpoints``: those that the micro-batch has asked for, a row each."""
        skipped = F.lit(False) if self.ignored is None else F.coalesce(self.ignored, F.lit(False))
        seen = Observation(f"counters-{batch_id}")
        batch = batch.observe(
            seen, F.count(F.when(~skipped, 1)).alias("n_records"), F.count(F.when(skipped, 1)).alias("n_ignored")
        )
        counts = shard_counters(batch, checkpoints, self.ignored, self.keys)
        counts.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        self.observed[batch_id] = dict(seen.get)

    def per_batch(self, spark: SparkSession) -> DataFrame:
        """(batch_id, keys, n_records, n_checkpoints)."""
        return spark.read.parquet(self.path)

    def totals(self, spark: SparkSession) -> DataFrame:
        """(keys, n_records, n_checkpoints) since the stream began."""
        return self.per_batch(spark).groupBy(*self.keys).agg(
            *(F.sum(c).cast("bigint").alias(c) for c in ("n_records", "n_checkpoints"))
        )
