import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import records, walk_gate
from tideline.operators.fold import CARRY
from tideline.operators.flush import flush_batches, flush_by_interval, heartbeat_flush
from tideline.operators.gate import CLOCK, NEEDS, WEIGHT, _Gate, interval_gate


def batch(rows, before=None):
    clock, weight, needs = zip(*rows)
    return pa.RecordBatch.from_pydict(
        {
            CLOCK: pa.array(clock, pa.int64()),
            WEIGHT: pa.array(weight, pa.int32()),
            NEEDS: pa.array(needs, pa.bool_()),
            CARRY: pa.array([before] * len(rows), pa.int64()),
        }
    )


def random_rows(rng, n, kinds, step, backwards=False):
    clock, rows = 1000, []
    for _ in range(n):
        clock += rng.choice([0, 0, 1, rng.randrange(step + 1)])
        kind = rng.choice(kinds)
        shown = clock - rng.randrange(4) if backwards else clock
        rows.append((shown, 0 if kind in ("ignored", "beat") else 1, kind == "beat"))
    return rows


@pytest.mark.parametrize("kinds", [["record"], ["record", "ignored"], ["record", "beat"], ["record", "ignored", "beat"]])
def test_gate_equals_walk_in_slices_and_in_chunks(kinds):
    rng = random.Random(len(kinds) * 7 + len(kinds[-1]))
    for trial in range(250):
        rows = random_rows(rng, rng.randrange(1, 60), kinds, rng.choice([1, 5, 30]), backwards=trial % 3 == 0)
        interval = rng.choice([None, 0, 1, 7, 40, 1000])
        capacity = rng.choice([None, 1, 2, 5, 50])
        expected = walk_gate(rows, interval, capacity)
        gate = _Gate(interval, capacity)
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(6)))) if len(rows) > 1 else []
        pieces = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]

        state, got, entries = None, [], []
        for piece in pieces:
            entries.append(state)
            state, out = gate.step(("s",), state, batch(piece))
            got += list(zip(out.column("batch_no").to_pylist(), out.column("fired").to_pylist()))
        assert got == expected

        state, top = None, None
        for piece, entry in zip(pieces, entries):
            assert state is None or tuple(map(int, state)) == tuple(map(int, entry))
            half = len(piece) // 2
            slices = [batch(piece[:half], top), batch(piece[half:], top)] if half else [batch(piece, top)]
            state = gate.advance(state, gate.summarize(slices))
            top = max([c for c, _, _ in piece] + ([top] if top is not None else []))


@pytest.mark.parametrize("interval, capacity", [(6 * 3_600_000, None), (6 * 3_600_000, 1000), (60_000, 100_000)])
def test_summaries_are_smaller_than_the_clocks_they_sum_up(interval, capacity):
    import zlib

    n = 200_000
    clock = np.cumsum(np.random.default_rng(1).integers(0, 60, n))
    columns = {CLOCK: clock, WEIGHT: np.ones(n, np.int64), NEEDS: np.zeros(n, bool), CARRY: pa.array([None] * n, pa.int64())}
    summary = _Gate(interval, capacity).summarize([pa.RecordBatch.from_pydict(columns)])
    assert len(zlib.compress(pickle.dumps(summary), 1)) < 4 * n


def test_summary_stays_small_when_records_are_dense():
    rows = [(t // 10, 1, False) for t in range(100_000)]
    summary = _Gate(1000, None).summarize([batch(rows)])
    assert len(summary["free"][0]) <= 1002


@pytest.mark.parametrize("max_group_rows", [None, 0])
@pytest.mark.parametrize("capacity", [None, 4])
def test_flush_by_interval(spark, max_group_rows, capacity):
    rng = random.Random(3)
    rows, expected = [], {}
    for shard, n in (("hot", 400), ("cold", 9), ("one", 1)):
        clock, events = 0, []
        for i in range(n):
            clock += rng.choice([0, 1, 2, 9])
            ignored = rng.random() < 0.2
            rows.append((shard, i * 3, None, None, clock, ignored))
            events.append((clock, 0 if ignored else 1, False))
        for i, got in enumerate(walk_gate(events, 20, capacity)):
            expected[shard, str(i * 3)] = got
    df = records(spark, rows, "ignored boolean")
    out = flush_by_interval(
        df, 20, capacity, ignored=F.col("ignored"), max_group_rows=max_group_rows, chunk_rows=50
    ).collect()
    assert {(r.shard_id, r.base): (r.batch_no, r.fired) for r in out} == expected
    assert len(out) == len(rows)


@pytest.mark.parametrize("max_group_rows", [None, 0])
def test_heartbeat_flushes_only_a_batch_that_is_due_and_not_empty(spark, max_group_rows):
    df = records(spark, [("a", 1, None, None, 0), ("a", 2, None, None, 5), ("a", 3, None, None, 40)])
    beats = spark.createDataFrame([("s", "a", t) for t in (8, 12, 30, 55)], "stream_name string, shard_id string, arrival_ms bigint")
    out = heartbeat_flush(df, beats, 10, max_group_rows=max_group_rows, chunk_rows=2).collect()
    got = {(r.kind, r.arrival_ms): (r.batch_no, r.fired) for r in out}
    assert got == {
        ("record", 0): (0, None),
        ("record", 5): (0, None),
        ("heartbeat", 8): (0, None),
        ("heartbeat", 12): (0, "interval"),
        ("heartbeat", 30): (1, None),  # due, but empty: the clock stays at 12
        ("record", 40): (1, "interval"),
        ("heartbeat", 55): (2, None),
    }


def test_full_flush_is_not_followed_by_an_interval_check(spark):
    df = records(spark, [("a", i, None, None, t) for i, t in enumerate((0, 1, 50, 51))])
    out = {r.base: (r.batch_no, r.fired) for r in flush_by_interval(df, 10, 2).collect()}
    # Row 2 finds the sink full: flush, restart the clock, open batch 1 with it.
    assert out == {"0": (0, None), "1": (0, None), "2": (1, "full"), "3": (1, None)}


def test_records_without_a_clock_fail(spark):
    df = records(spark, [("a", 1, None, None, 0), ("a", 2, None, None, None)])
    with pytest.raises(Exception, match="no clock"):
        flush_by_interval(df, 10).collect()


def test_gate_refuses_settings_that_cannot_work(spark):
    df = spark.createDataFrame([("s", "a")], "stream_name string, shard_id string")
    with pytest.raises(ValueError):
        interval_gate(df, 10, capacity=0)
    with pytest.raises(ValueError):
        interval_gate(df, -1)


def test_batches_are_numbered_once_to_be_written(spark):
    worked = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = records(spark, [("a", i, None, None, i) for i in range(50)]).withColumn("batch_no", F.floor(F.col("base") / 10).cast("bigint"))
    written = flush_batches(rows.mapInArrow(work, rows.schema), lambda shard, batch_no, batches: None)
    assert sorted((r.batch_no, r.n_written) for r in written.collect()) == [(i, 10) for i in range(4)]
    assert worked.value == 50
