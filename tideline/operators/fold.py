"""Ordered fold: a stateful pass over each group's rows in order.

A fold is given slices of one group as Arrow batches and carries a small state
from slice to slice; no group is ever materialised. Groups that fit a task are
shuffled by group and sorted by Spark. For larger groups a fold that can
summarise a run of rows without knowing the state before it (``splittable``) is
evaluated chunk by chunk: summaries of all chunks in parallel, a pass over one
summary per chunk to get the state each chunk starts from, then all chunks in
parallel from those states. A fold without summaries is sequential per group by
its nature and streams through one task per group.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.ordering import CHUNK, CHUNK_ROWS, POS, _before, _orders, ordered_chunks
from tideline.operators.sizing import fits_one_task, ordered_lookup
from tideline.schema import SHARD_KEYS

CARRY = "_carry"
ENTRY = "_entry"
FINAL = "_final"
FIRST = "_first"

#: About the bytes of rows that a fold is given at once; Arrow batches of wide rows are larger.
STEP_BYTES = 8 << 20


class OrderedFold:
    """Base class; subclasses must be picklable."""

    #: Whether ``summarize`` and ``advance`` are implemented.
    splittable = False

    def start(self, key: tuple):
        """State before the first row of a group."""
        return None

    def step(self, key: tuple, state, rows: pa.RecordBatch):
        """Consume a slice; return the new state and output rows or None."""
        raise NotImplementedError

    def finish(self, key: tuple, state):
        """Output rows after the last row of a group, or None."""
        return None

    def summarize(self, slices: list[pa.RecordBatch]):
        """What ``advance`` needs to know of a run of rows; much smaller than the rows."""
        raise NotImplementedError

    def advance(self, state, summary):
        """State after a run of rows, from the state before it and its summary."""
        raise NotImplementedError

    def freeze(self, state):
        """A state in plain values, to go from worker to worker: classes of this package are not the same there."""
        return state

    def thaw(self, frozen):
        return frozen

    #: ``combine(first, second)``: summary of two runs, one after the other; None if only a whole run can be summarised.
    combine = None

    def summary(self, slices: Iterator[pa.RecordBatch]):
        """``summarize`` of slices that come one at a time; with ``combine``, one slice is held, otherwise all are."""
        if self.combine is None:
            return self.summarize(list(slices))
        return reduce(self.combine, (self.summarize([s]) for s in slices))


def slices_by_key(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Cut a batch where one of its first ``n_keys`` columns changes."""
    n = batch.num_rows
    if n == 0:
        return
    cut = np.zeros(n - 1, dtype=bool)
    for i in range(n_keys):
        col = batch.column(i)
        differs = pc.fill_null(pc.not_equal(col.slice(1), col.slice(0, n - 1)), True)
        cut |= differs.to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(cut) + 1).tolist(), n]
    for lo, hi in zip(bounds, bounds[1:]):
        key = tuple(batch.column(i)[lo].as_py() for i in range(n_keys))
        yield key, batch.slice(lo, hi - lo)


def _portions(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A slice cut so that a step has about ``STEP_BYTES`` at a time, as values and in what it puts out."""
    n = rows.num_rows
    size = max(1, n * STEP_BYTES // max(rows.nbytes, STEP_BYTES))
    for lo in range(0, n, size):
        yield rows.slice(lo, size)


def _emit(out) -> Iterator[pa.RecordBatch]:
    if out is None:
        return
    for piece in out if isinstance(out, list) else [out]:
        if piece.num_rows:
            yield piece


def _run(fold: OrderedFold, n_keys: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            for key, rows in slices_by_key(batch, n_keys):
                if key != current:
                    if current is not None:
                        yield from _emit(fold.finish(current, state))
                    current, state = key, fold.start(key)
                for some in _portions(rows):
                    state, out = fold.step(key, state, some)
                    yield from _emit(out)
        if current is not None:
            yield from _emit(fold.finish(current, state))

    return run


def _summaries(fold: OrderedFold, n_keys: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The chunk is the column after the keys; the row's place in all rows comes after it.
        slices = (found for batch in batches for found in slices_by_key(batch, n_keys + 1))
        for place, run_of in groupby(slices, key=itemgetter(0)):
            run_of = (rows for _, rows in run_of)
            head = next(run_of)
            first = head.column(POS)[0].as_py()
            blob = zlib.compress(pickle.dumps(fold.summary(chain([head], run_of))), 1)
            values = [*place, first, blob]
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, schema)], schema=schema)

    return run


def _entries(fold: OrderedFold, n_keys: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            for key, rows in slices_by_key(batch, n_keys):
                if key != current:
                    current, state = key, fold.start(key)
                entries = []
                for blob in rows.column("_summary"):
                    entries.append(pickle.dumps(fold.freeze(state)))
                    state = fold.advance(state, pickle.loads(zlib.decompress(blob.as_py())))
                kept = [rows.column(i) for i in range(n_keys)] + [rows.column(c) for c in (CHUNK, FIRST, FINAL)]
                names = [*rows.schema.names[:n_keys], CHUNK, FIRST, FINAL, ENTRY]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(entries, pa.binary())], names=names)

    return run


def _run_chunks(fold: OrderedFold, n_keys: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, final = None, None, False
        for batch in batches:
            for place, rows in slices_by_key(batch, n_keys + 1):
                key = place[:n_keys]
                if place != current:
                    if current is not None and final:
                        yield from _emit(fold.finish(current[:n_keys], state))
                    current = place
                    state = fold.thaw(pickle.loads(rows.column(ENTRY)[0].as_py()))
                    final = rows.column(FINAL)[0].as_py()
                bare = rows.drop_columns([CHUNK, ENTRY, FINAL])
                for some in _portions(bare):
                    state, out = fold.step(key, state, some)
                    yield from _emit(out)
        if current is not None and final:
            yield from _emit(fold.finish(current[:n_keys], state))

    return run


def ordered_fold(
    df: DataFrame,
    fold: OrderedFold,
    out_schema: T.StructType,
    keys: Sequence[str] = SHARD_KEYS,
    order: Sequence[Column] | None = None,
    columns: Sequence[str] | None = None,
    summary_columns: Sequence[str] = (),
    carry_max: str | None = None,
    clustered: bool = False,
    max_group_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Run ``fold`` over every group of ``df``.

    The fold sees the key columns first, then ``columns``, by default all others
    of ``df``; what is only needed for the order then stays out of Python.
    ``clustered`` says that ``df`` is already partitioned so that no group spans
    two partitions, which saves the shuffle. For a splittable fold
    ``summary_columns`` are the columns ``summarize`` reads (besides the keys);
    with ``carry_max`` it also gets, in ``_carry``, the maximum of that column
    over the group's earlier chunks.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys] if columns is None else list(columns)
    by = [F.col(k) for k in keys] + _orders(order)
    if not fold.splittable or clustered or (fits_one_task(df, keys, max_group_rows) if fits is None else fits):
        if not clustered:
            df = df.repartition(*keys)
        return df.sortWithinPartitions(*by).select(*keys, *rest).mapInArrow(_run(fold, len(keys)), out_schema)

    chunks = ordered_chunks(df, keys, order, chunk_rows)
    key_fields = [df.schema[k] for k in keys]
    wanted = list(summary_columns)
    source = chunks.select(*keys, CHUNK, POS, *wanted)
    if carry_max is not None:
        tops = chunks.groupBy(*keys, CHUNK).agg(F.max(carry_max).alias("_top"))
        tops = tops.withColumn(CARRY, _before(keys, F.max("_top"))).select(*keys, CHUNK, CARRY)
        source, in_order = ordered_lookup(chunks, tops, [*keys, CHUNK])
        if not in_order:
            source = source.sortWithinPartitions(*by)
        source = source.select(*keys, CHUNK, POS, *wanted, CARRY)
    summary_schema = T.StructType(
        [
            *key_fields,
            T.StructField(CHUNK, T.LongType()),
            T.StructField(FIRST, T.LongType()),
            T.StructField("_summary", T.BinaryType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    summaries = source.mapInArrow(_summaries(fold, len(keys), to_arrow_schema(summary_schema)), summary_schema)
    later = F.lead(CHUNK).over(W.partitionBy(*keys).orderBy(CHUNK))
    summaries = summaries.withColumn(FINAL, later.isNull())
    entry_schema = T.StructType(
        [
            *key_fields,
            T.StructField(CHUNK, T.LongType()),
            T.StructField(FIRST, T.LongType()),
            T.StructField(FINAL, T.BooleanType()),
            T.StructField(ENTRY, T.BinaryType()),
        ]
    )
    entries = (
        summaries.repartition(*keys)
        .sortWithinPartitions(*keys, CHUNK)
        .mapInArrow(_entries(fold, len(keys)), entry_schema)
    )
    placed, in_order = ordered_lookup(chunks, entries, [*keys, CHUNK])
    # States may be large: only the first row of a chunk carries one, and no sort or worker sees it more than once.
    placed = placed.withColumn(ENTRY, F.when(F.col(POS) == F.col(FIRST), F.col(ENTRY)))
    if not in_order:
        placed = placed.sortWithinPartitions(*by)
    placed = placed.select(*keys, CHUNK, *rest, FINAL, ENTRY)
    return placed.mapInArrow(_run_chunks(fold, len(keys)), out_schema)
