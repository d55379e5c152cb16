"""Partial and late tokens: against a walk, with heartbeats, and what the frontier makes of them."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import records
from tideline.operators.counters import arrival_counter
from tideline.operators.flush import flush_by_bytes, flush_by_interval, heartbeat_flush
from tideline.operators.flusher import Flusher, open_records, partial_tokens, run_flusher
from tideline.operators.frontier import frontier, frontier_history

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Odd(Flusher):
    """At a flush, completes what is even, greatest first; at a heartbeat, one of the odd ones."""

    def initialize(self, shard):
        return []

    def add(self, shard, state, records):
        return [*state, *records.column("counter").to_pylist()]

    def flush(self, shard, state, full):
        done = [n for n in reversed(state) if full or n % 2 == 0]
        return [n for n in state if n not in done], done

    def heartbeat(self, shard, state):
        odd = [n for n in state if n % 2]
        return [n for n in state if n not in odd[:1]], odd[:1]


def stream(spark, n=300, shards=2):
    rng = random.Random(2)
    rows, clock = [], 0
    for i in range(n):
        clock += rng.randrange(0, 40)
        rows.append((f"s{i % shards}", 100 + i, None, None, clock))
    beats = [("s", f"s{rng.randrange(shards)}", rng.randrange(clock)) for _ in range(60)]
    return records(spark, rows), rows, spark.createDataFrame(beats, "stream_name string, shard_id string, arrival_ms long"), beats


def walk(events, capacity, interval):
    """Rows (clock, counter or None) of one shard to {counter: occasion} and the occasions' clocks."""
    state, flusher, held, last, occasion, done, when = [], Odd(), 0, None, 0, {}, []

    def note(tokens, clock):
        nonlocal occasion
        done.update({t: occasion for t in tokens})
        when.append(clock)
        occasion += 1

    for clock, n in events:
        last = clock if last is None else last
        if n is None:
            due = clock - last >= interval and held > 0
            state, tokens = flusher.heartbeat(None, state)
            note(tokens, clock)
            if due:
                state, tokens = flusher.flush(None, state, False)
                note(tokens, clock)
                held, last = 0, clock
            continue
        if held >= capacity:
            state, tokens = flusher.flush(None, state, False)
            note(tokens, clock)
            state, held, last = [*state, n], 1, clock
            continue
        state, held = [*state, n], held + 1
        if clock - last >= interval:
            state, tokens = flusher.flush(None, state, False)
            note(tokens, clock)
            held, last = 0, clock
    return done, state


@pytest.mark.parametrize("with_beats", [False, True])
def test_tokens_equal_a_walk(spark, with_beats):
    df, rows, ticks, beats = stream(spark)
    counted = arrival_counter(df)
    batched = heartbeat_flush(counted, ticks, 100, 5) if with_beats else flush_by_interval(counted, 100, 5)
    tokens = run_flusher(batched, Odd())
    got = {(r.shard_id, r.counter): r.done_round for r in tokens.collect()}
    want = {}
    for shard in ("s0", "s1"):
        mine = [(r[4], 1, i) for i, r in enumerate(r for r in rows if r[0] == shard)]
        ticks_of = [(c, 0, None) for _, s, c in beats if s == shard] if with_beats else []
        done, _ = walk([(c, n) for c, _, n in sorted(mine + ticks_of, key=lambda x: (x[0], x[1], x[2] or 0))], 5, 100)
        want |= {(shard, n): r for n, r in done.items()}
    assert got == want
    joined = partial_tokens(batched, tokens)
    assert joined.count() == len(rows)
    assert {(r.shard_id, r.counter): r.done_round for r in joined.filter("done").collect()} == want
    # Odd records stay open, so the frontier stops before the first of them.
    reached = {r.shard_id: r.base for r in frontier(joined).collect()}
    history = frontier_history(joined).groupBy("shard_id").agg(F.max(F.col("base").cast("int")).alias("base"))
    assert {r.shard_id: str(r.base) for r in history.collect()} == {k: v for k, v in reached.items() if v is not None}
    counts = {r.shard_id: r.n_open for r in open_records(joined).collect()}
    assert sum(counts.values()) == len(rows) - len(want)


def test_closing_flush_leaves_nothing(spark):
    df, rows, *_ = stream(spark, 50)
    batched = flush_by_interval(arrival_counter(df), 100, 5)
    assert run_flusher(batched, Odd(), final=True).count() == len(rows)
    with pytest.raises(PySparkException, match="left open"):
        run_flusher(batched, Forgetful(), final=True).collect()
    with pytest.raises(PySparkException, match="is not open"):
        run_flusher(batched, Twice()).collect()


class Forgetful(Odd):
    def flush(self, shard, state, full):
        return super().flush(shard, state, False)


class Twice(Odd):
    def flush(self, shard, state, full):
        return state, state


def test_a_completion_table_of_several_flushers(spark):
    df, *_ = stream(spark, 20, 1)
    batched = flush_by_interval(arrival_counter(df), 100, 5)
    table = spark.createDataFrame(
        [("s", "s0", n, r) for n, r in [(3, 7), (3, 5), (0, 1), (19, 2)]], "stream_name string, shard_id string, counter long, done_round long"
    )
    done = {r.counter: r.done_round for r in partial_tokens(batched, table).filter("done").collect()}
    assert done == {3: 5, 0: 1, 19: 2}


@pytest.mark.parametrize("sizing", [{}, {"fits": False, "chunk_rows": 7}])
def test_byte_capacity_equals_a_walk(spark, sizing):
    rng = random.Random(5)
    sizes = [rng.choice([1, 3, 10, 40, 99, 100, 101, 500]) for _ in range(200)]
    rows = [("s0", 1000 + i, None, None, 10 * i) for i in range(200)]
    df = records(spark, rows).withColumn("size", F.element_at(F.array(*map(F.lit, sizes)), (F.col("base").cast("int") - 999)))
    for interval in (None, 170):
        got = {int(r.base) - 1000: (r.batch_no, r.fired) for r in flush_by_bytes(df, 100, interval, F.col("size"), **sizing).collect()}
        held, number, last = 0, 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > 100:
                number, held, last = number + 1, n, 10 * i
                assert got[i] == (number, "full"), i
                continue
            held += n
            due = interval is not None and 10 * i - last >= interval
            assert got[i] == (number, "interval" if due else None), i
            if due:
                number, held, last = number + 1, 0, 10 * i
    default = flush_by_bytes(df.withColumn("partition_key", F.repeat(F.lit("k"), 30)), 100)
    assert default.filter("fired = 'full'").count() > 0
