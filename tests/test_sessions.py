"""Worker sessions: against a walk over the lines of each shard, whatever way files are cut."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.operators import ordering
from tideline.operators.counters import arrival_counter
from tideline.operators.sizing import ordered_lookup
from tideline.plans import queries
from tideline.sources import read_lines, sessions
from tideline.sources.envelopes import LINE_PLACE, parse_envelopes, stream_records
from tideline.sources.sessions import SESSION_KEYS, session_bounds, worker_sessions

OPEN = '{{"action":"initialize","shardId":"{0}","sequenceNumber":"{1}"}}'
RECORD = '{{"action":"processRecords","records":[{{"data":"YQ==","partitionKey":"k","sequenceNumber":"{0}"}}]}}'
CLOSE = ['{"action":"shutdown","reason":"TERMINATE"}', '{"action":"shutdown","reason":"ZOMBIE"}', '{"action":"shutdownRequested"}']


def written(tmp_path, files):
    """``files``: {shard: [lines of a file, ...]}."""
    for shard, parts in files.items():
        folder = tmp_path / f"shard_id={shard}"
        folder.mkdir()
        for i, lines in enumerate(parts):
            (folder / f"{i:05d}.txt").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def random_files(rng):
    files, want = {}, {}
    for shard in ("a", "b", "c"):
        lines, session, is_open, n = [], -1, False, 0
        for _ in range(rng.randrange(2, 9)):
            if not is_open or rng.random() < 0.2:  # a lost worker is followed by the next one
                lines.append(OPEN.format(shard, n))
                session, is_open = session + 1, True
            for _ in range(rng.randrange(0, 12)):
                lines.append(RECORD.format(f"{n}"))
                want[shard, f"{n}"] = session
                n += 1
            if rng.random() < 0.1:
                lines.append("")
            if rng.random() < 0.7:
                lines.append(rng.choice(CLOSE))
                is_open = False
        cuts = sorted(rng.sample(range(1, len(lines)), min(3, len(lines) - 1)))
        files[shard] = [lines[i:j] for i, j in zip([0, *cuts], [*cuts, len(lines)], strict=True)]
    return files, want


@pytest.mark.parametrize("seed", range(3))
def test_sessions_equal_a_walk(spark, tmp_path, seed):
    files, want = random_files(random.Random(seed))
    # Small parts, so that a file is read by several tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = worker_sessions(read_lines(spark, written(tmp_path, files), "s", places=True))
        records = stream_records(parse_envelopes(lines.drop(*LINE_PLACE)))
        got = {(r.shard_id, r.base): r for r in arrival_counter(records, keys=SESSION_KEYS).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k: r.session for k, r in got.items()} == want
    seen = {}
    for (shard, base), r in sorted(got.items(), key=lambda x: (x[0][0], int(x[0][1]))):
        assert r.counter == seen.get((shard, r.session), 0)
        seen[shard, r.session] = r.counter + 1


def test_bounds_and_reasons(spark, tmp_path):
    files = {"a": [[OPEN.format("a", 5), RECORD.format(5), CLOSE[1], OPEN.format("a", 6)], [RECORD.format(6), RECORD.format(7), CLOSE[2], OPEN.format("a", 8)]]}
    lines = worker_sessions(read_lines(spark, written(tmp_path, files), "s", places=True))
    got = [(r.session, r.start, r.reason, r.n_deliveries) for r in session_bounds(lines).orderBy("session").collect()]
    assert got == [(0, "5", "ZOMBIE", 1), (1, "6", "ZOMBIE", 2), (2, "8", None, 0)]


def test_lines_outside_any_session(spark, tmp_path):
    files = {"a": [[OPEN.format("a", 1), CLOSE[0], RECORD.format(1)]]}
    lines = read_lines(spark, written(tmp_path, files), "s", places=True)
    with pytest.raises(PySparkException, match="outside any session"):
        worker_sessions(lines).collect()
    found = worker_sessions(lines, on_error="null").filter(F.col("session").isNull()).collect()
    assert len(found) == 1 and "processRecords" in found[0].value
    with pytest.raises(ValueError):
        worker_sessions(lines, on_error="drop")
    with pytest.raises(ValueError):
        read_lines(spark, str(tmp_path), "s", places=True, streaming=True)
    assert worker_sessions(lines.limit(0)).collect() == []


def test_lines_are_compared_with_few_sessions(spark, tmp_path, monkeypatch):
    """One part of a file with one long session and many short ones: pairs grow with the lines, not with lines times sessions."""
    lines, want, n = [], {}, 0
    for session, length in enumerate([600, *[1] * 300, 400]):
        lines.append(OPEN.format("a", n))
        for n in range(n, n + length):
            lines.append(RECORD.format(n))
            want[f"{n}"] = session
        n += 1
        lines.append(CLOSE[session % 3])
    pairs = []

    def counted(rows, side, keys, *args):
        pairs.append(rows.join(side, list(keys)).count())
        return ordered_lookup(rows, side, keys, *args)

    monkeypatch.setattr(sessions, "ordered_lookup", counted)
    found = worker_sessions(read_lines(spark, written(tmp_path, {"a": [lines]}), "s", places=True))
    records = stream_records(parse_envelopes(found.drop(*LINE_PLACE)))
    assert {r.base: r.session for r in records.collect()} == want
    assert sum(pairs) < 20 * len(lines)


def test_session_counters_ask_for_no_largest_session(spark, monkeypatch):
    monkeypatch.setattr(ordering, "fits_one_task", None)
    assert queries.session_counters_query(spark, "/root/testdata/sf0.001").count() > 0
