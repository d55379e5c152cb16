"""Batching of records for a sink: when batches close and what they complete."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.sequence import order_columns
from tideline.operators.fold import slices_by_key
from tideline.operators.gate import CLOCK, NEEDS, WEIGHT, interval_gate
from tideline.operators.sizing import lookup, materialize
from tideline.schema import SHARD_KEYS


def _weight(ignored: Column | None) -> Column:
    if ignored is None:
        return F.lit(1)
    return F.when(F.coalesce(ignored, F.lit(False)), 0).otherwise(1)


def flush_by_interval(
    records: DataFrame,
    interval_ms: int,
    capacity: int | None = None,
    clock: str = "arrival_ms",
    ignored: Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """Number the batches of a sink flushed by time, and by count if it has a capacity.

    A record that arrives once ``interval_ms`` have passed since the last flush
    is added and then flushed with its batch. An ignored record joins no batch
    but is looked at all the same, so it can close one.
    """
    events = (
        records.withColumn(CLOCK, F.col(clock))
        .withColumn(WEIGHT, _weight(ignored))
        .withColumn(NEEDS, F.lit(False))
    )
    return interval_gate(events, interval_ms, capacity, keys=keys, **sizing)


def payload_bytes() -> Column:
    """What a record takes of a sink that holds its key and its data."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in ("partition_key", "data")]
    return sizes[0] + sizes[1]


def flush_by_bytes(
    records: DataFrame,
    capacity_bytes: int,
    interval_ms: int | None = None,
    size: Column | None = None,
    clock: str = "arrival_ms",
    ignored: Column | None = None,
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """Number the batches of a sink that holds ``capacity_bytes``, and flush by time too if ``interval_ms`` is given.

    A record that would take the open batch above the capacity flushes it and
    starts the next; a record that is too large by itself is a batch of its
    own. ``size`` is at least one byte, by default that of key and data.
    """
    size = payload_bytes() if size is None else size
    events = (
        records.withColumn(CLOCK, F.lit(0).cast("bigint") if interval_ms is None else F.col(clock))
        .withColumn(WEIGHT, (_weight(ignored) * F.greatest(size, F.lit(1))).cast("bigint"))
        .withColumn(NEEDS, F.lit(False))
    )
    return interval_gate(events, interval_ms, capacity_bytes, keys=keys, **sizing)


def heartbeat_flush(
    records: DataFrame,
    heartbeats: DataFrame,
    interval_ms: int,
    capacity: int | None = None,
    clock: str = "arrival_ms",
    keys: Sequence[str] = SHARD_KEYS,
    **sizing,
) -> DataFrame:
    """:func:`flush_by_interval` with empty deliveries in between.

    ``heartbeats`` has the keys and the clock. A heartbeat flushes a batch that
    is due and not empty, and restarts the clock only then. At equal times it
    comes before the records, as the sink is asked before a delivery is worked on.
    """
    kinds = records.withColumn("kind", F.lit("record")).withColumn("_late", F.lit(1))
    ticks = heartbeats.select(*keys, clock).withColumn("kind", F.lit("heartbeat")).withColumn("_late", F.lit(0))
    events = kinds.unionByName(ticks, allowMissingColumns=True)
    beat = F.col("kind") == "heartbeat"
    events = (
        events.withColumn(CLOCK, F.col(clock))
        .withColumn(WEIGHT, F.when(beat, 0).otherwise(1))
        .withColumn(NEEDS, beat)
    )
    order = [F.col(clock), F.col("_late"), *order_columns()]
    return interval_gate(events, interval_ms, capacity, keys=keys, order=order, **sizing).drop("_late")


def flush_log(batched: DataFrame, clock: str = "arrival_ms", keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """One row per flush: which batch, why, when."""
    flushed = F.when(F.col("fired") == "full", F.col("batch_no") - 1).otherwise(F.col("batch_no"))
    return batched.filter(F.col("fired").isNotNull()).select(
        *keys, flushed.alias("batch_no"), "fired", F.col(clock).alias("flushed_ms")
    )


def flush_tokens(batched: DataFrame, keys: Sequence[str] = SHARD_KEYS, final: bool = False) -> DataFrame:
    """Mark which records' batches have been flushed: ``done``, and ``done_round``.

    Batches close in order, so a batch is flushed if a later one exists or the
    gate fired on its own last row. ``final`` flushes the open batch too, as
    when a shard is closed. Ignored records and heartbeats have no token: take
    them out of the result, not of ``batched``, where they may close a batch.
    """
    if final:
        return batched.withColumn("done", F.lit(True)).withColumn("done_round", F.col("batch_no"))
    if "fired" in batched.columns:
        closed = F.max(F.when(F.col("fired") == "interval", F.col("batch_no") + 1).otherwise(F.col("batch_no")))
    else:
        closed = F.max("batch_no")
    flushed = batched.groupBy(*keys).agg(closed.alias("_closed"))
    joined = lookup(batched, flushed, keys)
    done = F.col("batch_no") < F.col("_closed")
    return (
        joined.withColumn("done", done)
        .withColumn("done_round", F.when(done, F.col("batch_no")))
        .drop("_closed")
    )


BatchWriter = Callable[[tuple, int, Iterator[pa.RecordBatch]], None]


def _written(n_keys: int, write_batch: BatchWriter, names: list[str]):
    def pieces(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            yield from slices_by_key(batch, n_keys + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = pieces(batches)
        piece = next(source, None)
        while piece is not None:
            place, rows_written = piece[0], 0
            ahead = [piece]

            def own() -> Iterator[pa.RecordBatch]:
                nonlocal rows_written
                while ahead[0] is not None and ahead[0][0] == place:
                    rows_written += ahead[0][1].num_rows
                    yield ahead[0][1]
                    ahead[0] = next(source, None)

            rows = own()
            write_batch(place[:-1], place[-1], rows)
            for _ in rows:  # what the writer left unread still belongs to this batch
                pass
            piece = ahead[0]
            values = [pa.array([v]) for v in (*place, rows_written)]
            yield pa.RecordBatch.from_arrays(values, names=names)

    return run


def flush_batches(
    batched: DataFrame,
    write_batch: BatchWriter,
    keys: Sequence[str] = SHARD_KEYS,
    final: bool = False,
) -> DataFrame:
    """Hand every closed batch to ``write_batch(key, batch_no, arrow_batches)``.

    Batches are spread over the cluster by (shard, batch), so a hot shard is
    written by many tasks; each batch is written in record order and streamed.
    Returns one row per written batch. The writes happen here, once; a retried
    task writes its batches again, so the writer must overwrite by batch number.
    """
    keys = list(keys)
    # Asked for its last batches and written: numbered once.
    tokens = flush_tokens(materialize(batched), keys, final)
    todo = tokens.filter("done").drop("done", "done_round", "fired")
    todo = todo.select(*keys, "batch_no", *[c for c in todo.columns if c not in (*keys, "batch_no")])
    out = T.StructType(
        [
            *[batched.schema[k] for k in keys],
            T.StructField("batch_no", T.LongType()),
            T.StructField("n_written", T.LongType()),
        ]
    )
    return materialize(
        todo.repartition(*keys, "batch_no")
        .sortWithinPartitions(*keys, "batch_no", *order_columns())
        .mapInArrow(_written(len(keys), write_batch, out.names), out)
    )
