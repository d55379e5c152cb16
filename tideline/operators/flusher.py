"""Sinks that complete records when they like: in part, out of order, and later than the flush that handed them over.

A flusher takes records as they come and, at each occasion (a flush that the gate
asks for, or a heartbeat), says which of the records it holds are
done, by their arrival counters. Those tokens are a completion table: joined to the
records they tell what is open, and what the frontier may pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.sequence import order_columns
from tideline.operators.fold import OrderedFold, ordered_fold
from tideline.operators.sizing import keyed_join
from tideline.schema import SHARD_KEYS


class Flusher:
    """A sink of one shard; subclasses and their states must be picklable.

    Tokens are arrival counters, as a list or an array. Only records that were
    added and not yet completed may be named.
    """

    def initialize(self, shard: tuple):
        """State before a shard's first record."""
        return None

    def add(self, shard: tuple, state, records: pa.RecordBatch):
        """Next state with some records of the open batch."""
        raise NotImplementedError

    def flush(self, shard: tuple, state, full: bool):
        """Next state and tokens. ``full``: the shard closes, so nothing may be left open."""
        raise NotImplementedError

    def heartbeat(self, shard: tuple, state):
        """Next state and tokens; asked whether or not there were records."""
        return state, []


class _Flushing(OrderedFold):
    """Tokens as a flusher gives them. State: the flusher's, its open counters, and the number of occasions."""

    def __init__(self, flusher: Flusher, schema: pa.Schema, counter: str, clock: str, final: bool):
        self.flusher, self.schema = flusher, schema
        self.counter, self.clock, self.final = counter, clock, final

    def start(self, key):
        return self.flusher.initialize(key), set(), 0, None

    def _tokens(self, key, open_: set, tokens, occasion: int, now) -> pa.RecordBatch | None:
        tokens = np.asarray(tokens, np.int64).tolist()
        for t in tokens:
            if t not in open_:
                raise ValueError(f"shard {'/'.join(map(str, key))}: record {t} is not open, so it cannot be completed")
            open_.remove(t)
        if not tokens:
            return None
        n = len(tokens)
        columns = [*(pa.array([k] * n) for k in key), pa.array(tokens), pa.array([occasion] * n), pa.array([now] * n)]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)

    def step(self, key, state, rows):
        inner, open_, occasion, now = state
        fired = rows.column("fired").to_pylist()
        beats = rows.column("kind").to_pylist() if "kind" in rows.schema.names else [None] * rows.num_rows
        clocks = rows.column(self.clock).to_pylist()
        out, at = [], 0

        def add(until: int) -> None:
            nonlocal inner, at
            some = rows.slice(at, until - at)
            some = some.filter(some.column(self.counter).is_valid())
            if some.num_rows:
                inner = self.flusher.add(key, inner, some)
                open_.update(some.column(self.counter).to_pylist())
            at = until

        def ask(call) -> None:
            nonlocal inner, occasion
            inner, tokens = call()
            out.append(self._tokens(key, open_, tokens, occasion, now))
            occasion += 1

        for i, (why, kind) in enumerate(zip(fired, beats, strict=True)):
            if why is None and kind != "heartbeat":
                continue
            # The record that finds a batch full belongs to the next one; any other is added before the flush.
            add(i if why == "full" else i + 1)
            now = clocks[i]
            if kind == "heartbeat":
                ask(lambda: self.flusher.heartbeat(key, inner))
            if why is not None:
                ask(lambda: self.flusher.flush(key, inner, False))
        add(rows.num_rows)
        now = clocks[-1]
        return (inner, open_, occasion, now), [o for o in out if o is not None]

    def finish(self, key, state):
        inner, open_, occasion, now = state
        if not self.final:
            return None
        inner, tokens = self.flusher.flush(key, inner, True)
        found = self._tokens(key, open_, tokens, occasion, now)
        if open_:
            raise ValueError(f"shard {'/'.join(map(str, key))}: {len(open_)} records left open by the closing flush")
        return found


def _flush_order(batched: DataFrame, clock: str) -> list[Column]:
    if "kind" not in batched.columns:
        return order_columns()
    return [F.col(clock), F.when(F.col("kind") == "heartbeat", 0).otherwise(1), *order_columns()]


def run_flusher(
    batched: DataFrame,
    flusher: Flusher,
    columns: Sequence[str] = (),
    counter: str = "counter",
    clock: str = "arrival_ms",
    final: bool = False,
    keys: Sequence[str] = SHARD_KEYS,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The completion table of a flusher: (keys, counter, ``done_round``, ``done_ms``).

    ``batched`` is the result of a flush operator with arrival counters; rows
    without one are not added, but may be occasions. ``columns`` are what the
    flusher reads besides the counter. Occasions are numbered per shard:
    without heartbeats, the n-th is the flush of batch n. ``final`` closes every
    shard with a full flush. A flusher may keep any state, so a shard is one
    task's, one Arrow batch at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = list(keys)
    long = T.LongType()
    out = T.StructType(
        [
            *[T.StructField(k, batched.schema[k].dataType) for k in keys],
            T.StructField(counter, long), T.StructField("done_round", long), T.StructField("done_ms", long),
        ]
    )
    kind = ["kind"] if "kind" in batched.columns else []
    wanted = list(dict.fromkeys([counter, clock, "fired", *kind, *columns]))
    fold = _Flushing(flusher, to_arrow_schema(out), counter, clock, final)
    by = list(order) if order is not None else _flush_order(batched, clock)
    return ordered_fold(batched, fold, out, keys=keys, order=by, columns=wanted)


def partial_tokens(
    batched: DataFrame, tokens: DataFrame, counter: str = "counter", keys: Sequence[str] = SHARD_KEYS
) -> DataFrame:
    """``batched`` with ``done`` and ``done_round`` from a completion table, which may name any records in any order.

    The table may be the union of what many flushes and heartbeats, or several
    flushers, have filled in. A record completed more than once counts from the
    first time; records the table does not name are open. Heartbeats and ignored records, which have no
    counter, are left out.
    """
    keys = list(keys)
    first = tokens.groupBy(*keys, counter).agg(F.min("done_round").alias("done_round"))
    records = batched.filter(F.col(counter).isNotNull())
    joined = keyed_join(records, first, [*keys, counter], "left")
    return joined.withColumn("done", F.col("done_round").isNotNull())


def open_records(completions: DataFrame, keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """Per shard: records handed over and not yet completed, and the least and greatest counter of them."""
    waiting = ~F.coalesce(F.col("done"), F.lit(False))
    return completions.groupBy(*keys).agg(
        F.count(F.when(waiting, 1)).alias("n_open"),
        F.min(F.when(waiting, F.col("counter"))).alias("first_open"),
        F.max(F.when(waiting, F.col("counter"))).alias("last_open"),
    )

