"""Ordered per-group operators that survive a group of any size.

Three of them - dense counter, running maximum, ordered fold - exist in two
forms with equal results:

* while the largest group fits a task: one shuffle by group and a window;
* beyond: rows are range-partitioned by ``(group, order)``, so a hot group is
  spread over as many partitions as its rows need. The sorted partitions are
  checkpointed once, because range bounds come from a sample and a recomputed
  sample must not move a row to another partition. Callers that know which form
  to take say so (``fits``), which saves a pass. They are read in *chunks* of
  a fixed number of rows; what a chunk needs to know of the chunks before it is
  computed from one small row per (group, chunk).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.sequence import order_columns
from tideline.operators.sizing import fits_one_task, lookup, materialize, row_bytes
from tideline.schema import SHARD_KEYS

CHUNK = "_chunk"
POS = "_pos"

#: Rows per chunk.
CHUNK_ROWS = 1_000_000

#: Smaller chunks, where asked for, grow up to ``CHUNK_ROWS`` so that there are no more than about this many:
#: every range partition sends a sample to the driver, and every chunk a summary to its group's task.
MOST_SMALL_CHUNKS = 256

#: About the bytes of rows that a partition of the range shuffle gets.
PARTITION_BYTES = 256 << 20

#: Most partitions of the range shuffle; larger inputs get several chunks per partition.
MAX_PARTITIONS = 50_000

# Bits monotonically_increasing_id leaves for the row inside its partition.
_PARTITION_SHIFT = 33


def _orders(order: Sequence[Column] | None) -> list[Column]:
    return list(order) if order is not None else order_columns()


def grown_chunk_rows(total: int, chunk_rows: int) -> int:
    """Rows per chunk of ``total`` rows, so that small chunks do not multiply with the input."""
    return max(chunk_rows, min(CHUNK_ROWS, math.ceil(total / MOST_SMALL_CHUNKS)))


def ordered_chunks(
    df: DataFrame,
    keys: Sequence[str] = SHARD_KEYS,
    order: Sequence[Column] | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``df`` globally ordered by ``(keys, order)`` on reliable storage.

    ``_pos`` numbers the rows increasingly in that order, with jumps between
    partitions. ``_chunk`` names the run of rows a row lies in by the ``_pos`` of its first; a run has
    ``chunk_rows`` rows, or what :func:`grown_chunk_rows` makes of them. A chunk may hold the end of one group and the
    start of others. Partitions, and with them the chunks of wide rows, are bounded by bytes as well.
    """
    total, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    chunk_rows = grown_chunk_rows(total, chunk_rows)
    wanted = max(math.ceil(total / chunk_rows), math.ceil((size or 0) / PARTITION_BYTES))
    n = min(MAX_PARTITIONS, max(1, wanted))
    row = F.col(POS).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    by = [F.col(k) for k in keys] + _orders(order)
    return materialize(
        df.repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .withColumn(POS, F.monotonically_increasing_id())
        .withColumn(CHUNK, F.col(POS) - row % chunk_rows)
    )


def _before(keys: Sequence[str], agg: Column) -> Column:
    """``agg`` over the chunks before this one in the same group."""
    return agg.over(W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1))


def dense_counter(
    df: DataFrame,
    name: str = "counter",
    keys: Sequence[str] = SHARD_KEYS,
    order: Sequence[Column] | None = None,
    max_group_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Add a gapless 0-based counter per group.

    The chunked form needs no window over the rows: a row's place in its
    partition follows from ``_pos``, and one small table holds where each group
    starts in each partition and how many rows it has before.
    """
    keys = list(keys)
    if fits_one_task(df, keys, max_group_rows) if fits is None else fits:
        w = W.partitionBy(*keys).orderBy(*_orders(order))
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))
    chunks = ordered_chunks(df, keys, order, chunk_rows)
    chunks = chunks.withColumn(CHUNK, F.shiftright(POS, _PARTITION_SHIFT))
    starts = chunks.groupBy(*keys, CHUNK).agg(F.min(POS).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    offset = F.coalesce(_before(keys, F.sum("_rows")), F.lit(0))
    starts = starts.withColumn("_shift", offset - F.col("_first")).select(*keys, CHUNK, "_shift")
    counted = lookup(chunks, starts, [*keys, CHUNK])
    return counted.withColumn(name, (F.col(POS) + F.col("_shift")).cast("bigint")).select(*df.columns, name)


def running_max(
    df: DataFrame,
    value: Column,
    name: str,
    keys: Sequence[str] = SHARD_KEYS,
    order: Sequence[Column] | None = None,
    max_group_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Add the maximum of ``value`` over a row and all rows before it in its group."""
    keys = list(keys)
    df = df.withColumn("_v", value)
    columns = [c for c in df.columns if c != "_v"]
    if fits_one_task(df, keys, max_group_rows) if fits is None else fits:
        w = W.partitionBy(*keys).orderBy(*_orders(order)).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumn(name, F.max("_v").over(w)).select(*columns, name)
    chunks = ordered_chunks(df, keys, order, chunk_rows)
    tops = chunks.groupBy(*keys, CHUNK).agg(F.max("_v").alias("_top"))
    tops = tops.withColumn("_before", _before(keys, F.max("_top"))).select(*keys, CHUNK, "_before")
    inside = W.partitionBy(*keys, CHUNK).orderBy(POS).rowsBetween(W.unboundedPreceding, 0)
    joined = lookup(chunks, tops, [*keys, CHUNK])
    return joined.withColumn(name, F.greatest(F.max("_v").over(inside), F.col("_before"))).select(*columns, name)
