import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import records
from tideline.operators.counters import arrival_counter, count_checkpoints, flush_by_count, latest_checkpoint, shard_counters
from tideline.operators.ordering import CHUNK, POS, ordered_chunks, running_max
from tideline.operators.pack import with_lanes
from tideline.operators.processor import process_shards
from tideline.operators.sizing import ensure_checkpoint_dir, largest_group, ordered_lookup
from tideline.plans.queries import BYTE_MARKS, ByteMarks


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = [("hot", 10**54 + i * 7, None, None, i, rng.randrange(1000)) for i in range(900)]
    rows += [(f"cold{s}", i, None, None, i, rng.randrange(1000)) for s in range(6) for i in range(20)]
    rng.shuffle(rows)
    return records(spark, rows, "v int").cache()


def test_chunks_spread_a_hot_group_in_order(skewed):
    chunks = ordered_chunks(skewed, chunk_rows=100).cache()
    hot = chunks.filter("shard_id = 'hot'")
    assert hot.select(CHUNK).distinct().count() > 4
    rows = hot.orderBy(POS).collect()
    assert [int(r.base) for r in rows] == sorted(int(r.base) for r in rows)
    assert largest_group(chunks, [CHUNK]) < 500


def test_a_partition_may_hold_many_chunks(skewed, monkeypatch):
    from tideline.operators import ordering

    expected = {}
    for limit in (ordering.MAX_PARTITIONS, 2):
        monkeypatch.setattr(ordering, "MAX_PARTITIONS", limit)
        chunks = ordered_chunks(skewed, chunk_rows=50).cache()
        assert chunks.rdd.getNumPartitions() <= limit
        assert largest_group(chunks, [CHUNK]) <= 50
        source = skewed.select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data")
        marks = process_shards(
            source, ByteMarks(300), BYTE_MARKS, summary_columns=["data"], max_group_rows=0, chunk_rows=50
        )
        top = running_max(skewed, F.col("v"), "m", max_group_rows=0, chunk_rows=50)
        got = (sorted(map(tuple, marks.collect())), sorted((r.shard_id, r.base, r.m) for r in top.collect()))
        assert expected.setdefault("first", got) == got


def test_small_chunks_do_not_multiply_with_the_input(spark):
    rows = spark.range(30_000).select(F.lit("all").alias("shard_id"), F.col("id").alias("base"))
    chunks = ordered_chunks(rows, ["shard_id"], [F.col("base")], chunk_rows=20).cache()
    # Every range partition costs the driver a sample of 300 keys.
    assert 200 < chunks.rdd.getNumPartitions() <= 256
    assert chunks.select(CHUNK).distinct().count() <= 512
    assert [r.base for r in chunks.orderBy(POS).collect()] == list(range(30_000))


def test_counter_is_the_same_in_both_forms(skewed):
    plain = arrival_counter(skewed, ignored=F.col("v") > 900)
    chunked = arrival_counter(skewed, ignored=F.col("v") > 900, max_group_rows=0, chunk_rows=100)
    a = {(r.shard_id, r.base): r.counter for r in plain.collect()}
    b = {(r.shard_id, r.base): r.counter for r in chunked.collect()}
    assert a == b
    hot = sorted((int(k[1]), n) for k, n in a.items() if k[0] == "hot")
    assert [n for _, n in hot] == list(range(len(hot)))


def test_running_max_is_the_same_in_both_forms(skewed):
    value = F.when(F.col("v") % 5 > 0, F.col("v"))
    plain = running_max(skewed, value, "m").collect()
    chunked = running_max(skewed, value, "m", max_group_rows=0, chunk_rows=100).collect()
    assert {(r.shard_id, r.base): r.m for r in plain} == {(r.shard_id, r.base): r.m for r in chunked}
    top, seen = None, {(r.shard_id, r.base): r.m for r in plain}
    for r in sorted((r for r in plain if r.shard_id == "hot"), key=lambda r: int(r.base)):
        if r.v % 5 > 0:
            top = r.v if top is None else max(top, r.v)
        assert seen["hot", r.base] == top


@pytest.mark.parametrize("max_group_rows", [None, 0])
def test_processor_runs_over_shards_and_over_chunks(skewed, max_group_rows):
    source = skewed.select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data")
    out = process_shards(
        source, ByteMarks(500), BYTE_MARKS, summary_columns=["data"], max_group_rows=max_group_rows, chunk_rows=100
    ).collect()
    expected, total = set(), 0
    for base in sorted(int(r.base) for r in source.filter("shard_id = 'hot'").collect()):
        size = len(str(base))
        total += size
        if total // 500 > (total - size) // 500:
            expected.add((str(base), total))
    assert {(r.base, r.n_bytes) for r in out if r.shard_id == "hot"} == expected


def test_processor_without_summary_streams_and_can_end_a_shard(skewed):
    import pyarrow as pa

    from tideline.operators.processor import RecordProcessor

    class Count(RecordProcessor):
        def initialize(self, shard):
            return 0

        def process(self, shard, state, records):
            return state + records.num_rows, None

        def shutdown(self, shard, state):
            return pa.RecordBatch.from_pydict({"stream_name": [shard[0]], "shard_id": [shard[1]], "n": [state]})

    schema = T.StructType(
        [T.StructField("stream_name", T.StringType()), T.StructField("shard_id", T.StringType()), T.StructField("n", T.LongType())]
    )
    out = process_shards(skewed, Count(), schema, max_group_rows=0).collect()
    assert {r.shard_id: r.n for r in out} == {"hot": 900, **{f"cold{i}": 20 for i in range(6)}}


def test_counts_and_batches(spark):
    df = records(spark, [("a", i, None, None, i) for i in range(23)] + [("b", 1, None, None, 0)])
    cps = {r.base: r.checkpoint_no for r in count_checkpoints(df).collect()}
    assert cps == {"10": 0, "21": 1}
    batches = {r.base: r.batch_no for r in flush_by_count(df.filter("shard_id = 'a'"), 10).collect()}
    assert [batches[str(i)] for i in (0, 9, 10, 22)] == [0, 0, 1, 2]
    newest = {r.shard_id: (r.base, r.n_records) for r in latest_checkpoint(df).collect()}
    assert newest == {"a": ("22", 23), "b": ("1", 1)}
    counts = shard_counters(df, count_checkpoints(df), ignored=F.col("base") == "0").collect()
    assert {r.shard_id: (r.n_records, r.n_checkpoints) for r in counts} == {"a": (22, 2), "b": (1, 0)}


def test_lanes_bound_a_hot_producer(skewed):
    laned = with_lanes(skewed, ["shard_id"], [F.col("base_key")], rows_per_lane=64, max_group_rows=0, chunk_rows=100)
    assert largest_group(laned, ["shard_id", "lane"]) == 64


@pytest.mark.parametrize("max_rows, broadcast", [(101, True), (100, False)])
def test_only_a_small_side_is_broadcast(spark, max_rows, broadcast):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, F.col("id") % 100).alias("k"), "id")
    joined, in_order = ordered_lookup(rows, rows.groupBy("k").count(), ["k"], max_rows=max_rows)
    assert in_order is broadcast
    assert ("strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()) is broadcast
    # Rows without a key are a group like any other.
    assert joined.count() == 1000 and joined.filter("k is null and count = 100").count() == 100


def test_checkpoints_go_where_the_session_says(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in ensure_checkpoint_dir(spark)
