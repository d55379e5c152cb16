import importlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import records, walk_frontier, walk_gate
from tideline.operators.counters import flush_by_count
from tideline.operators.flush import flush_batches, flush_by_interval, flush_tokens
from tideline.operators.frontier import (
    checkpoint_schedule,
    final_checkpoints,
    frontier,
    frontier_history,
    stalled_shards,
)
from tideline.operators.sizing import materialize


def reached(spark, done, subs=None, **kw):
    subs = subs or {}
    rows = [("a", i, *subs.get(i, (None, None)), 0, i in done) for i in range(5)]
    return frontier(records(spark, rows, "done boolean"), **kw).first().base


@pytest.mark.parametrize("done, expected", [(set(), None), ({1, 2}, None), ({0, 1, 3}, "1"), ({0, 1, 2, 3}, "3")])
def test_frontier_stops_at_a_gap(spark, done, expected):
    assert reached(spark, done) == expected


SUBS = {i: (i, 3) for i in range(3)}


@pytest.mark.parametrize(
    "done, whole, inside",
    [({0, 2}, None, "0"), ({0, 1, 2}, "2", "2"), ({0, 1, 2, 3}, "3", "3"), ({0, 1}, None, "1")],
)
def test_frontier_with_sub_records(spark, done, whole, inside):
    assert reached(spark, done, SUBS) == whole
    assert reached(spark, done, SUBS, subsequence=True) == inside


def random_history(rng, n):
    """Records in order as (base, user_sub, user_total, done_round or None)."""
    rows, base = [], 0
    while len(rows) < n:
        base += rng.randrange(1, 4)
        total = rng.choice([None, 1, 2, 5])
        for sub in range(total or 1):
            done = None if rng.random() < 0.03 else rng.randrange(len(rows) // 5 + 1) + rng.randrange(3)
            rows.append((base, sub if total else None, total, done))
    return rows


@pytest.mark.parametrize("subsequence", [False, True])
def test_frontier_and_history_equal_an_ordered_walk(spark, subsequence):
    rng = random.Random(8)
    rows, walks = [], {}
    for s in range(40):
        history = random_history(rng, rng.randrange(1, 60))
        rows += [(f"sh{s}", b, sub, total, 0, rnd) for b, sub, total, rnd in history]
        walks[f"sh{s}"] = history
    df = records(spark, rows, "done_round bigint")
    cutoff = 4
    got = {r.shard_id: (r.base, r.user_sub) for r in frontier(df.withColumn("done", F.col("done_round") <= cutoff), subsequence=subsequence).collect()}
    for shard, history in walks.items():
        at = walk_frontier([(s, t, d is not None and d <= cutoff) for _, s, t, d in history], subsequence)
        expected = (None, None) if at is None else (str(history[at][0]), history[at][1])
        assert got[shard] == expected

    for sizing in ({}, {"max_group_rows": 0, "chunk_rows": 100}):
        advances = {}
        for r in frontier_history(df, subsequence=subsequence, **sizing).collect():
            advances.setdefault(r.shard_id, []).append((r.round, r.base, r.user_sub))
        for shard, history in walks.items():
            expected, last = [], None
            for rnd in range(max((d for *_, d in history if d is not None), default=-1) + 1):
                at = walk_frontier([(s, t, d is not None and d <= rnd) for _, s, t, d in history], subsequence)
                if at is not None and at != last:
                    expected.append((rnd, str(history[at][0]), history[at][1]))
                    last = at
            assert sorted(advances.get(shard, [])) == expected


@pytest.mark.parametrize("max_group_rows", [None, 0])
def test_checkpoints_are_throttled(spark, max_group_rows):
    rng = random.Random(4)
    clocks, t = [], 0
    for _ in range(120):
        t += rng.randrange(6)
        clocks.append(t)
    moves = {r: 10 * r for r in range(120) if rng.random() < 0.3}
    rounds = spark.createDataFrame([("s", "a", r, c) for r, c in enumerate(clocks)], "stream_name string, shard_id string, round bigint, clock_ms bigint")
    history = records(spark, [("a", b, None, None, 0, r) for r, b in moves.items()], "round bigint")
    out = checkpoint_schedule(rounds, history, 15, max_group_rows=max_group_rows, chunk_rows=20).collect()
    walked = walk_gate([(c, int(r in moves), True) for r, c in enumerate(clocks)], 15, None)
    expected = []
    for r, (number, fired) in enumerate(walked):
        if fired:
            expected.append((number, r, clocks[r], str(max(b for m, b in moves.items() if m <= r))))
    assert sorted((x.checkpoint_no, x.round, x.clock_ms, x.base) for x in out) == expected
    assert len(expected) > 5


ENDS = "stream_name string, shard_id string, reason string"


def test_final_checkpoints(spark):
    done = records(
        spark,
        [("a", 1, 0, 2, 0, True), ("a", 1, 1, 2, 0, True), ("z", 5, None, None, 0, False)],
        "done boolean",
    )
    ends = spark.createDataFrame([("s", "a", "TERMINATE"), ("s", "empty", "TERMINATE"), ("s", "z", "ZOMBIE")], ENDS)
    got = {r.shard_id: (r.kind, r.base, r.user_sub) for r in final_checkpoints(done, ends).collect()}
    assert got == {"a": ("frontier", "1", 1), "empty": ("latest", None, None)}


@pytest.mark.parametrize(
    "row, reason, error",
    [
        (("a", 1, None, None, 0, False), "TERMINATE", "left over"),
        (("a", 1, 0, 2, 0, True), "TERMINATE", "left over"),  # the aggregate's last record is missing
        (("a", 1, None, None, 0, True), "SOMETHING", "unknown shutdown reason"),
    ],
)
def test_final_checkpoint_errors(spark, row, reason, error):
    done = records(spark, [row], "done boolean")
    ends = spark.createDataFrame([("s", "a", reason)], ENDS)
    with pytest.raises(PySparkException, match=error):
        final_checkpoints(done, ends).collect()


def test_stalls(spark):
    df = records(spark, [("a", i, None, None, t) for i, t in enumerate((0, 90, 190, 500, 501, 800))] + [("b", 1, None, None, 790)])
    got = {(r.shard_id, r.since_ms, r.until_ms, r.silent_ms) for r in stalled_shards(df, 100).collect()}
    assert got == {("a", 190, 500, 310), ("a", 501, 800, 299)}
    got = {(r.shard_id, r.since_ms, r.until_ms, r.silent_ms) for r in stalled_shards(df, 100, now_ms=895).collect()}
    assert got == {("a", 190, 500, 310), ("a", 501, 800, 299), ("b", 790, None, 105)}


def test_tokens_of_flushed_batches(spark):
    df = records(spark, [("a", i, None, None, t) for i, t in enumerate((0, 5, 12, 13))] + [("b", 1, None, None, 0)])
    got = {(r.shard_id, r.base): (r.done, r.done_round) for r in flush_tokens(flush_by_interval(df, 10)).collect()}
    assert got == {
        ("a", "0"): (True, 0),
        ("a", "1"): (True, 0),
        ("a", "2"): (True, 0),
        ("a", "3"): (False, None),
        ("b", "1"): (False, None),
    }
    closing = flush_tokens(flush_by_count(df, 2), final=True)
    assert closing.filter("not done").count() == 0


def test_batches_are_written_once_in_order(spark, tmp_path):
    import json

    df = records(spark, [(s, i, None, None, i) for s in ("a", "b") for i in range(25)])
    target = str(tmp_path)

    def write(shard, number, batches):
        bases = [b for batch in batches for b in batch.column("base").to_pylist()]
        with open(f"{target}/{shard[1]}-{number}.json", "w") as out:
            json.dump(bases, out)

    written = flush_batches(flush_by_count(df, 10), write)
    assert {(r.shard_id, r.batch_no, r.n_written) for r in written.collect()} == {
        (s, n, 10) for s in ("a", "b") for n in (0, 1)
    }
    files = {p.name: json.loads(p.read_text()) for p in tmp_path.iterdir()}
    assert files == {f"{s}-{n}.json": [str(10 * n + i) for i in range(10)] for s in ("a", "b") for n in (0, 1)}


def test_a_writer_may_leave_rows_unread(spark):
    df = records(spark, [("a", i, None, None, i) for i in range(25)])
    written = flush_batches(flush_by_count(df, 10), lambda shard, number, batches: None, final=True)
    assert {(r.batch_no, r.n_written) for r in written.collect()} == {(0, 10), (1, 10), (2, 5)}


@pytest.mark.parametrize("subsequence", [False, True])
def test_computed_completions_are_kept_only_as_far_as_they_matter(spark, subsequence, monkeypatch):
    rng = random.Random(14)
    rows = []
    for s in range(30):
        rows += [(f"sh{s}", b, sub, total, 0, rnd is not None) for b, sub, total, rnd in random_history(rng, 300)]
    # A shard whose records no checkpoint may name is still a shard; one has nothing open; a flag may be NULL.
    rows += [("inside", 1, 0, 3, 0, True), ("done", 1, None, None, 0, True), ("done", 10, None, None, 0, True)]
    rows += [("null", 1, None, None, 0, True), ("null", 2, None, None, 0, None), ("null", 3, None, None, 0, True)]
    every = records(spark, rows, "done boolean")
    kept = []

    def counted(df):
        found = materialize(df)
        kept.append(found.count())
        return found

    monkeypatch.setattr(importlib.import_module("tideline.operators.frontier"), "materialize", counted)

    def result(df, **kw):
        found = frontier(df, subsequence=subsequence, **kw).collect()
        return sorted((tuple(r) for r in found), key=lambda r: r[1])

    want = result(every)
    assert len(want) == 33 and dict((r[1], r[2]) for r in want)["done"] == "10"
    assert result(every, computed=True) == want
    # In order a task sees the first open record before what lies behind it.
    sorted_rows = every.coalesce(1).sortWithinPartitions("base_key", F.coalesce("user_sub", F.lit(0)))
    assert result(sorted_rows, computed=True) == want
    assert len(kept) == 2 and kept[1] < kept[0] < len(rows) and kept[1] < len(rows) / 4
