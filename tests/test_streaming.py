import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import records, walk_frontier
from tideline.operators.deaggregate import deaggregate
from tideline.operators.frontier import frontier
from tideline.operators.processor import process_shards
from tideline.plans.queries import BYTE_MARKS, ByteMarks
from tideline.plans import stream_queries
from tideline.plans.streams import packed_orders
from tideline.sources import parse_envelopes, read_dir, read_lines, stream_records, to_request_lines
from tideline.streaming import (
    FrontierTracker,
    completion_runs,
    flush_stream,
    process_shards_stream,
    stalled_shards_stream,
)

SF = "/root/testdata/sf0.001"


def drain(df, path, **options):
    """Run a stream over all files there are and return what it wrote."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/out")
    )
    query.awaitTermination()
    batches = len([p for p in query.recentProgress if p["numInputRows"] > 0])
    return df.sparkSession.read.parquet(f"{path}/out"), batches


def file_stream(spark, df, path, n_files, order):
    """``df`` as a stream of files in the given order, one file per trigger."""
    ordered = df.withColumn("_f", F.ntile(n_files).over(__import__("pyspark").sql.Window.orderBy(order))).persist()
    for i in range(1, n_files + 1):
        ordered.filter(F.col("_f") == i).drop("_f").coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.02)
    ordered.unpersist()
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_envelopes_are_deaggregated_on_a_stream(spark, tmp_path):
    packed = packed_orders(spark, SF).drop("n_records")
    for part in range(3):
        some = packed.filter(F.col("base").cast("bigint") % 3 == part)
        to_request_lines(some).drop("stream_name").coalesce(1).write.mode("append").partitionBy("shard_id").text(
            str(tmp_path / "in")
        )
    stream = read_lines(spark, str(tmp_path / "in"), "lineitem", streaming=True, maxFilesPerTrigger=5)
    out, batches = drain(deaggregate(stream_records(parse_envelopes(stream))), tmp_path)
    assert batches >= 2
    columns = ["shard_id", "partition_key", "base", "sub", "user_sub", "user_total", "data"]
    expected = deaggregate(packed).select(columns)
    assert out.count() == expected.count()
    assert out.select(columns).exceptAll(expected).count() == 0


def test_a_directory_is_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / name).write_bytes(name.encode())
    out, _ = drain(read_dir(spark, str(tmp_path / "in"), streaming=True, maxFilesPerTrigger=1), tmp_path)
    assert {(r.partition_key[-1], bytes(r.data)) for r in out.collect()} == {("a", b"a"), ("b", b"b")}


def completions(spark, rng, shards, n):
    """Records with counters that complete out of order, some never."""
    rows = []
    for s in range(shards):
        base, sub, total = 0, 0, 1
        for counter in range(n):
            if sub >= total:
                base, sub, total = base + rng.randrange(1, 5), 0, rng.choice([1, 1, 3])
            done = rng.random() > 0.004
            rows.append((f"sh{s}", base, sub if total > 1 else None, total if total > 1 else None, 0, counter, counter + rng.randrange(40), done))
            sub += 1
    return records(spark, rows, "counter bigint, finished bigint, done boolean"), rows


@pytest.mark.parametrize("subsequence", [False, True])
def test_streamed_frontier_equals_the_batch_frontier_also_after_a_restart(spark, tmp_path, subsequence):
    rng = random.Random(21)
    df, _ = completions(spark, rng, 4, 150)
    df = df.cache()
    done = df.filter("done")
    tracker = FrontierTracker(str(tmp_path / "frontier"), subsequence=subsequence)
    stream = file_stream(spark, done, tmp_path / "in", 5, "finished")

    def run(sink):
        query = (
            stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def fails_once(batch, batch_id):
        tracker(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost after the state was written")

    with pytest.raises(Exception, match="lost after"):
        run(fails_once)
    run(tracker)

    expected = frontier(df, subsequence=subsequence).filter("base is not null")
    cols = ["shard_id", "base", "user_sub", "user_total"]
    assert sorted(map(tuple, tracker.current(spark).select(cols).collect())) == sorted(map(tuple, expected.select(cols).collect()))
    moves = tracker.advances(spark)
    assert moves.groupBy("shard_id", "base_key", "user_sub").count().filter("count > 1").count() == 0
    assert moves.select("batch_id").distinct().count() > 2
    # Gaps only: far fewer runs than records, and none of them touch.
    runs = spark.read.parquet(str(tmp_path / "frontier" / "state" / "batch_id=4"))
    assert runs.count() < 40


def test_runs_are_the_same_for_hot_shards(spark):
    df, _ = completions(spark, random.Random(2), 2, 120)
    done = df.filter("done")
    plain = completion_runs(done.unionByName(done)).drop("at").collect()
    chunked = completion_runs(done, max_group_rows=0, chunk_rows=50).drop("at").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, chunked))


def test_processor_state_survives_triggers_and_restarts(spark, tmp_path):
    df = records(spark, [(s, i, None, None, i) for s in ("a", "b") for i in range(120)]).select(
        "stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data"
    )
    stream = file_stream(spark, df, tmp_path / "in", 3, "base_key")
    out, batches = drain(process_shards_stream(stream, ByteMarks(20), BYTE_MARKS), tmp_path)
    assert batches == 3
    more = records(spark, [(s, i, None, None, i) for s in ("a", "b") for i in range(120, 150)]).select(df.columns)
    more.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out, _ = drain(process_shards_stream(stream, ByteMarks(20), BYTE_MARKS), tmp_path)
    expected = process_shards(df.unionByName(more), ByteMarks(20), BYTE_MARKS)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))


def test_batches_on_a_stream_by_count(spark, tmp_path):
    df = records(spark, [("a", i, None, None, i, i % 10 == 3) for i in range(50)], "skip boolean")
    stream = file_stream(spark, df, tmp_path / "in", 3, "base_key")
    flushed = flush_stream(stream, interval_ms=None, capacity=7, ignored="skip")
    out, batches = drain(flushed, tmp_path)
    assert batches == 3
    rows = sorted(out.collect(), key=lambda r: int(r.base))
    assert [r.counter for r in rows if r.counter is not None] == list(range(45))
    assert [r.base for r in rows if r.counter is None] == ["3", "13", "23", "33", "43"]
    assert all(r.batch_no == r.counter // 7 for r in rows if r.counter is not None)
    assert all((r.fired == "full") == (r.counter is not None and r.counter > 0 and r.counter % 7 == 0) for r in rows)


def until(condition, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def test_idle_shards_are_flushed_by_heartbeat_and_reported_as_stalled(spark, tmp_path):
    df = records(spark, [("a", i, None, None, i) for i in range(5)])
    stream = file_stream(spark, df, tmp_path / "in", 1, "base_key")
    started = []
    for name, source in (
        ("beats", flush_stream(stream, interval_ms=1500, heartbeat_ms=500)),
        ("stalls", stalled_shards_stream(stream, 1000)),
    ):
        started.append(
            source.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"{name}-checkpoint"))
            .trigger(processingTime="200 milliseconds")
            .start(str(tmp_path / name))
        )

    def seen(name, condition):
        try:
            return spark.read.parquet(str(tmp_path / name)).filter(condition).count() > 0
        except Exception:
            return False

    try:
        assert until(lambda: seen("beats", "kind = 'heartbeat'"))
        assert until(lambda: seen("stalls", "shard_id = 'a'"))
        time.sleep(2)
    finally:
        for query in started:
            query.stop()
    beats = spark.read.parquet(str(tmp_path / "beats")).collect()
    assert [(r.batch_no, r.fired) for r in beats if r.kind == "heartbeat"] == [(0, "interval")]
    assert {(r.base, r.batch_no, r.fired) for r in beats if r.kind == "record"} == {(str(i), 0, None) for i in range(5)}
    stalls = spark.read.parquet(str(tmp_path / "stalls")).collect()
    assert len(stalls) == 1 and stalls[0].noticed_ms - stalls[0].since_ms >= 1000


def test_landed_files_are_bounded_and_in_order(spark, tmp_path, monkeypatch):
    few = stream_queries.staged_events(spark, SF, str(tmp_path / "few"))
    whole = sorted(map(tuple, stream_queries.stream_flush(spark, SF).collect()))
    rows = spark.read.parquet(f"{SF}/events.parquet").count()
    monkeypatch.setattr(stream_queries, "FILE_BYTES", 20_000)
    groups = stream_queries.staged_events(spark, SF, str(tmp_path / "many"))
    assert len(few) == stream_queries.LEAST_FILES < len(groups)
    sizes, last = [], -1
    for paths in groups:
        ids = [r.event_id for r in spark.read.parquet(*paths).select("event_id").collect()]
        assert min(ids) > last
        sizes.append(len(ids))
        last = max(ids)
    assert sum(sizes) == rows and max(sizes) < 2 * rows / len(groups)
    assert sorted(map(tuple, stream_queries.stream_flush(spark, SF).collect())) == whole


def test_tracker_works_a_micro_batch_out_once(spark, tmp_path):
    worked = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = records(spark, [("a", i, None, None, i) for i in range(50)]).withColumn("counter", F.col("base").cast("bigint"))
    tracker = FrontierTracker(str(tmp_path / "frontier"))
    tracker(rows.mapInArrow(work, rows.schema), 0)
    assert [r.base for r in tracker.current(spark).collect()] == ["49"]
    assert worked.value == 50


def test_landings_are_worked_out_once(spark, tmp_path):
    worked, landed = spark.sparkContext.accumulator(0), []

    def work(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = spark.range(40).withColumn("landing", F.col("id") % 3)
    rows = rows.mapInArrow(work, rows.schema)
    sink = lambda batch, batch_id: landed.append(sorted(r.id for r in batch.collect()))
    stream_queries.in_landings(spark, rows, "landing", str(tmp_path), sink, landings=3)
    assert landed == [list(range(i, 40, 3)) for i in range(3)]
    assert worked.value == 40
