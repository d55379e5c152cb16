import math
import random

import pytest
from pyspark.errors import PySparkException

from tideline.llm.topk import topk_report

SCHEMA = "vec_id long, embedding array<double>, score string, rank string"


def brute(rows, k, every=20):
    whole = []
    for vec_id, v, *_ in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for query_id, q in whole:
        if query_id is None or query_id % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i) for i, v in whole if i != query_id]
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(query_id, r + 1, i, -s) for r, (s, _, i) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("spread", [0.0, 1.0, 4.0])
@pytest.mark.parametrize("dims", [2, 16])
def test_top_k_equals_brute_force(spark, spread, dims, monkeypatch):
    rng = random.Random(dims)
    rows = []
    for i in range(700):
        scale = math.exp(rng.gauss(0, spread)) * 0.2
        center = 1.0 if i % 3 == 0 else 0.0
        rows.append((i, [scale * (rng.gauss(center, 0.3)) for _ in range(dims)], "c", "c"))
    hot = rows[3][1]
    rows += [(1000 + i, hot, None, None) for i in range(300)]
    bad = [None, [], [None] * dims, [math.nan] * dims, [math.inf] * dims, [0.0] * dims, hot[:1], [*hot, 1.0]]
    rows += [(2000 + 20 * i, v, None, None) for i, v in enumerate(bad)] + [(None, hot, None, None), (-20, hot, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    from tideline.llm import topk

    for bucket, block in ((50, 7), (4096, 512)):
        got = topk.top_k(df, df.vec_id % 20 == 0, 20, bucket_rows=bucket, query_rows=block)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_large_components_and_few_rows(spark):
    rows = [(0, [float(1 << 31), 3.0], None, None), (20, [float(1 << 20), -1.0], None, None), (21, [1.5, 2.5], None, None)]
    got = topk_report(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_components_near_the_end_of_doubles(spark):
    rows = [(0, [1e301, 0.0], None, None), (20, [0.0, 3.0], None, None), (21, [0.0, -2.0], None, None), (40, [-1e305, 0.0], None, None)]
    few = rows[:3]
    assert sorted((tuple(r) for r in topk_report(spark.createDataFrame(few, SCHEMA)).collect()), key=str) == brute(few, 20)
    # A score beyond 64 bits fails and is not left out.
    with pytest.raises(PySparkException):
        topk_report(spark.createDataFrame(rows, SCHEMA)).collect()


def test_buckets_are_full_whatever_the_partitions():
    from tideline.llm.topk import _partitions

    assert [_partitions(n, 100, 200) for n in (0, 99, 250, 19_999, 20_000, 10**6, 10**8)] == [1, 1, 2, 199, 200, 200, 15_625]


def test_vectors_move_for_surviving_pairs_only(spark):
    """Short buckets are excluded on narrow rows: no block of queries is sent to them."""
    from tideline.llm import topk

    rows = [(i, [2.0 if i < 300 else 0.01, 0.01], None, None) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seen = spark.sparkContext.accumulator(0)
    inner = topk.compare_blobs

    def counting(k):
        run = inner(k)

        def counted(batches):
            def each():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            return run(each())

        return counted

    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    topk.compare_blobs = counting
    try:
        # A query with a long vector has k long ones before it; the sixteen buckets and more of short ones are left out.
        got = topk.top_k(df, (df.vec_id % 20 == 0) & (df.vec_id < 300), 20, bucket_rows=100, query_rows=100).collect()
    finally:
        topk.compare_blobs = inner
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert sorted((tuple(r) for r in got), key=str) == [r for r in brute(rows, 20) if r[0] < 300]
    blocks = 4
    assert seen.value <= blocks * 6


def test_nothing(spark):
    assert topk_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert topk_report(spark.createDataFrame([(0, [1.0], None, None)], SCHEMA)).collect() == []
