"""Packing of a producer that is cut into chunks against packing in one pass."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline.operators.codec import OpenAggregate
from tideline.operators.filling import chains, ends
from tideline.operators.pack import _Pack, pack

SLACK = 64


def walk(keys, hashes, lengths, batches, limit, start):
    """The row before which an aggregate that begins at ``start`` is closed, record by record."""
    agg = OpenAggregate()
    for i in range(start, len(keys)):
        head, size = agg.head(keys[i], lengths[i], hashes[i])
        if i > start and (batches[i] != batches[start] or agg.estimate + size > limit):
            return i
        agg.add(keys[i], b"", hashes[i], head, size)
    return len(keys)


def some_records(seed, n=700, n_keys=300, most=60, n_batches=1):
    rng = random.Random(seed)
    keys = [("k" * rng.randrange(1, 40) + str(rng.randrange(n_keys))).encode() for _ in range(n)]
    hashes = [None if rng.random() < 0.4 else str(rng.randrange(n_keys)).encode() for _ in range(n)]
    return keys, hashes, [rng.randrange(most) for _ in range(n)], [i * n_batches // n for i in range(n)]


@pytest.mark.parametrize("n_keys, most", [(1, 60), (300, 20), (3000, 130)])
@pytest.mark.parametrize("limit", [150, 4000, 20_000, 10**7])
def test_ends_equal_a_walk_from_every_record(n_keys, most, limit):
    for seed in range(2):
        rows = some_records(seed, n_keys=n_keys, most=most, n_batches=1 + seed * 3)
        assert ends(*rows, limit).tolist() == [walk(*rows, limit, i) for i in range(700)]


def test_indexes_of_three_bytes():
    n = 16_800
    keys = [str(i % 16_700).encode() for i in range(n)]
    got = ends(keys, [None] * n, [0] * n, [0] * n, 200_000)
    for start in (0, 1, 90, 400, 5_000):
        assert got[start] == walk(keys, [None] * n, [0] * n, [0] * n, 200_000, start)


def test_equal_sizes_never_meet_and_still_chain():
    found = ends([b"k"] * 50, [None] * 50, [10] * 50, [0] * 50, 20 + 1 + 3 + 7 * 16)
    last, hops = chains(found)
    for start in range(50):
        at, n = start, 0
        while found[at] < 50:
            at, n = found[at], n + 1
        assert (last[start], hops[start]) == (at, n)


def fold(batch_key=None, max_bytes=2000):
    own = [T.StructField("b", T.LongType())] if batch_key else []
    out = T.StructType(
        [T.StructField("lane", T.LongType()), *own]
        + [T.StructField(c, t) for c, t in (("batch_no", T.LongType()), ("partition_key", T.StringType()), ("data", T.BinaryType()))]
        + [T.StructField(c, t) for c, t in (("explicit_hash_key", T.StringType()), ("n_records", T.LongType()), ("est_bytes", T.LongType()))]
    )
    return _Pack(to_arrow_schema(out), 1, batch_key, max_bytes, False)


@pytest.mark.parametrize("batch_key", [None, "b"])
@pytest.mark.parametrize("size", [1, 3, 40, 333])
def test_states_from_summaries_equal_states_from_rows(batch_key, size):
    keys, hashes, lengths, batches = some_records(9, n=400, n_batches=5)
    rng = random.Random(1)
    rows = pa.RecordBatch.from_pydict(
        {
            "lane": [0] * 400,
            "partition_key": [k.decode() for k in keys],
            "data": [rng.randbytes(n) for n in lengths],
            "explicit_hash_key": pa.array([h and h.decode() for h in hashes], pa.string()),
            "b": batches,
        }
    )
    f = fold(batch_key)
    walked, jumped = f.start((0,)), f.start((0,))
    for at in range(0, 400, size):
        piece = rows.slice(at, size)
        halves = [h for h in (piece.slice(0, size // 2), piece.slice(size // 2)) if h.num_rows]
        walked, _ = f.step((0,), walked, piece)
        jumped = f.advance(jumped, f.summary(iter(halves)))
        assert walked[1:] == jumped[1:]
        for name in OpenAggregate.__slots__:
            assert getattr(walked[0], name) == getattr(jumped[0], name)


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_hot_producer_has_the_same_aggregates_in_chunks(spark, monkeypatch, broadcast):
    from tideline.operators import sizing

    if not broadcast:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    keys, hashes, lengths, _ = some_records(4, n=900)
    rng = random.Random(2)
    rows = [
        ("hot" if i % 10 else None, i, keys[i].decode(), rng.randbytes(lengths[i]), hashes[i] and hashes[i].decode()) for i in range(900)
    ]
    ddl = "producer string, n int, partition_key string, data binary, explicit_hash_key string"
    df = spark.createDataFrame(rows, ddl).repartition(3)
    plain = pack(df, ["producer"], [F.col("n")], max_bytes=3000, fits=True)
    cut = pack(df, ["producer"], [F.col("n")], max_bytes=3000, fits=False, chunk_rows=100)
    assert plain.count() > 20
    assert sorted(plain.collect(), key=str) == sorted(cut.collect(), key=str)


def test_nothing_to_pack_in_chunks(spark):
    ddl = "producer string, n int, partition_key string, data binary, explicit_hash_key string"
    assert pack(spark.createDataFrame([], ddl), ["producer"], [F.col("n")], fits=False).collect() == []


def test_a_summary_holds_less_than_an_aggregate_of_data():
    n = 20_000
    rng = random.Random(3)
    sizes = [rng.randrange(40, 60) for _ in range(n)]
    rows = pa.RecordBatch.from_pydict(
        {
            "lane": [0] * n,
            "partition_key": [str(rng.randrange(500)) for _ in range(n)],
            "data": [bytes(s) for s in sizes],
            "explicit_hash_key": pa.nulls(n, pa.string()),
        }
    )
    summary = fold(max_bytes=20_000).summary(rows.slice(at, 64) for at in range(0, n, 64))
    assert sum(map(len, summary["tail"][2])) < 20_000 < sum(sizes)
    assert len(summary["head"][0]) < 20_000 // 40
    assert len(summary["last"]) == len(summary["hops"]) == len(summary["head"][0])
