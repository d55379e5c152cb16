import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.functions import checksum_matches, record_format, record_size, varint_size, verify_checksum
from tideline.operators import codec
from tideline.operators.deaggregate import deaggregate
from tideline.operators.pack import key_dictionary, lone_size, oversize_records, pack, pack_header
from tideline.schema import MAGIC_DEFLATED, MAGIC_PLAIN, MAX_RECORD_BYTES

# Aggregates made by an independent implementation of the format.
SIMPLE = (
    "0a03706b310a03706b32120465686b31120465686b321a0b080010001a0564617461311a0b080110011a056461746132"
    "f4295d9badbe3a1ef0dfd8081acd5604"
)
SHARED = (
    "0a05616c7068610a04626574610a07636861726c696512047a756c75120679616e6b65651204787261791a0b080010001a056461746131"
    "1a0b080110011a0564617461321a0b080010021a0564617461331a0b080210011a0564617461341a0b080110001a056461746135"
    "4e43a0ce1601219a03066eeb09e53564"
)
SECOND = (
    "0a03706b330a03706b34120465686b33120465686b341a0b080010001a0564617461331a0b080110011a056461746134"
    "607c976639a3ce8d43194c3dc4fc4e0c"
)


def golden(body):
    return MAGIC_PLAIN + bytes.fromhex(body)


def users(spark, rows, n_partitions=2):
    ddl = "lane int, n int, partition_key string, data binary, explicit_hash_key string"
    return spark.createDataFrame([(0, i, *r) for i, r in enumerate(rows)], ddl).repartition(n_partitions)


def packed(spark, rows, **kw):
    return pack(users(spark, rows), ["lane"], [F.col("n")], **kw)


def unpacked(df):
    none = F.lit(None).cast("bigint")
    return deaggregate(df.withColumn("user_sub", none).withColumn("user_total", none))


def test_golden_simple(spark):
    rows = packed(spark, [("pk1", b"data1", "ehk1"), ("pk2", b"data2", "ehk2")]).collect()
    assert len(rows) == 1
    assert bytes(rows[0].data) == golden(SIMPLE)
    assert (rows[0].partition_key, rows[0].explicit_hash_key, rows[0].n_records) == ("pk1", "ehk1", 2)
    assert rows[0].est_bytes == len(golden(SIMPLE)) + len("pk1")


def test_golden_shared_keys(spark):
    rows = packed(
        spark,
        [
            ("alpha", b"data1", "zulu"),
            ("beta", b"data2", "yankee"),
            ("alpha", b"data3", "xray"),
            ("charlie", b"data4", "yankee"),
            ("beta", b"data5", "zulu"),
        ],
    ).collect()
    assert [bytes(r.data) for r in rows] == [golden(SHARED)]
    assert (rows[0].partition_key, rows[0].explicit_hash_key) == ("alpha", "zulu")


def test_nothing_to_pack(spark):
    assert packed(spark, []).collect() == []
    assert codec.OpenAggregate().estimate == 20


def test_fullness(spark):
    rows = packed(
        spark, [("pk1", b"X" * 500_000, "ehk1"), ("pk2", b"Y" * 600_000, "ehk2"), ("pk3", b"Z" * 200_000, "ehk3")]
    )
    got = sorted(rows.collect(), key=lambda r: r.batch_no)
    assert [(r.partition_key, r.explicit_hash_key, r.n_records) for r in got] == [("pk1", "ehk1", 1), ("pk2", "ehk2", 2)]
    keys = [codec.unpacker()(bytes(r.data))[0] for r in got]
    assert keys == [[b"pk1"], [b"pk2", b"pk3"]]


def test_random_records_fill_an_aggregate(spark):
    rng = random.Random(11)
    rows = [
        (str(rng.randrange(1, 1001)), "".join(str(rng.randrange(1, 1000)) for _ in range(rng.randrange(2, 1002))).encode(), None)
        for _ in range(2500)
    ]
    got = sorted(packed(spark, rows).collect(), key=lambda r: r.batch_no)
    assert len(got) > 2
    for r in got[:-1]:
        assert MAX_RECORD_BYTES - 4096 <= len(r.data) + len(r.partition_key) <= MAX_RECORD_BYTES
        assert r.est_bytes == len(r.data) + len(r.partition_key)
    pairs = [p for r in got for p in zip(*codec.unpacker()(bytes(r.data)))]
    assert pairs == [(k.encode(), d) for k, d, _ in rows]


def test_deflated(spark):
    rows = packed(spark, [("pk1", b"data1", "ehk1")], deflate=True).collect()
    data = bytes(rows[0].data)
    assert data[:4] == MAGIC_DEFLATED
    body = zlib.decompress(data[4:])
    assert hashlib.md5(body[:-16]).digest() == body[-16:]
    assert [(r.partition_key, bytes(r.data)) for r in unpacked(packed(spark, [("pk1", b"data1", "ehk1")], deflate=True)).collect()] == [
        ("pk1", b"data1")
    ]


def test_a_lone_record_up_to_the_limit_is_taken_and_one_beyond_fails(spark):
    fits = users(spark, [("k", b"x" * (1000 - 15), None)])
    assert fits.select(lone_size()).first()[0] == 1000 - 15 + 3 + 2 + 3 + 3
    limit = fits.select(lone_size()).first()[0]
    assert pack(fits, ["lane"], [F.col("n")], max_bytes=limit).count() == 1
    assert oversize_records(fits, limit).count() == 0
    assert oversize_records(fits, limit - 1).count() == 1
    with pytest.raises(PySparkException, match="does not fit"):
        pack(fits, ["lane"], [F.col("n")], max_bytes=limit - 1).collect()


def test_a_batch_closes_on_a_key_it_already_holds(spark):
    rows = [("key", b"a" * 400, None), ("key", b"b" * 400, None), ("key", b"c" * 400, None)]
    got = sorted(packed(spark, rows, max_bytes=1000).collect(), key=lambda r: r.batch_no)
    assert [r.n_records for r in got] == [2, 1]
    # The key's own bytes count again in the second aggregate.
    assert all(r.est_bytes == len(r.data) + 3 for r in got)


def test_batch_key_closes_an_aggregate(spark):
    df = users(spark, [("a", b"1", None), ("b", b"2", None), ("c", b"3", "h")]).withColumn("order", F.floor(F.col("n") / 2))
    got = pack(df, ["lane"], [F.col("n")], batch_key="order").collect()
    assert {(r.order, r.partition_key, r.explicit_hash_key, r.n_records) for r in got} == {(0, "a", None, 2), (1, "c", "h", 1)}


def test_key_dictionary_and_header(spark):
    df = users(spark, [("foo", b"", None), ("bar", b"", "h2"), ("foo", b"", "h1"), ("baz", b"", "h2")])
    keys = {r.partition_key: r.key_index for r in key_dictionary(df, ["lane"], F.col("n")).collect()}
    assert keys == {"foo": 0, "bar": 1, "baz": 2}
    hashes = {r.explicit_hash_key: r.key_index for r in key_dictionary(df, ["lane"], F.col("n"), "explicit_hash_key").collect()}
    assert hashes == {"h2": 0, "h1": 1}
    header = pack_header(df, ["lane"], F.col("n")).first()
    assert (header.partition_key, header.explicit_hash_key, header.n_records) == ("foo", "h2", 4)


def test_sizes(spark):
    values = [(0, 1), (1, 1), (127, 1), (128, 2), (9999999, 4), (999999999999, 6)]
    df = spark.createDataFrame(values, "n bigint, size bigint")
    assert df.filter(varint_size("n") != F.col("size")).count() == 0
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        pk, ehk = "k" * rng.randrange(1, 300), "h" * rng.randrange(1, 200)
        data = b"d" * rng.choice([0, 1, 120, 127, 128, 20_000])
        agg = codec.OpenAggregate()
        agg.keys = {str(i).encode(): i for i in range(rng.choice([0, 3, 127, 128, 500]))}
        _, expected = agg.head(pk.encode(), len(data), ehk.encode() if len(ehk) % 2 else None)
        rows.append((len(pk), len(agg.keys), len(data), len(ehk) if len(ehk) % 2 else None, expected))
    df = spark.createDataFrame(rows, "pk int, idx int, d int, ehk int, expected bigint")
    got = record_size("pk", F.lit(True), "idx", "d", "ehk", F.lit(True), F.lit(0))
    assert df.filter(got != F.col("expected")).count() == 0


ENVELOPE_DDL = "partition_key string, base string, sub bigint, user_sub bigint, user_total bigint, data binary"


def test_deaggregation_of_mixed_records(spark):
    rows = [
        ("PK", "665", None, None, None, b"whatever"),
        ("ignored", "666", 0, None, None, golden(SIMPLE)),
        ("ignored", "667", 0, None, None, golden(SECOND)),
        ("pk1", "668", 123, None, None, b"data1"),
        ("pk2", "668", 124, None, None, b"data2"),
        ("k", "669", 0, None, None, b""),
        ("k", "670", 0, None, None, bytes.fromhex("f3899ac2") + b"x"),
    ]
    df = spark.createDataFrame(rows, ENVELOPE_DDL).coalesce(1)
    got = [(r.partition_key, bytes(r.data), r.base, r.sub, r.user_sub, r.user_total) for r in deaggregate(df).collect()]
    assert got == [
        ("PK", b"whatever", "665", None, None, None),
        ("pk1", b"data1", "666", 0, 0, 2),
        ("pk2", b"data2", "666", 0, 1, 2),
        ("pk3", b"data3", "667", 0, 0, 2),
        ("pk4", b"data4", "667", 0, 1, 2),
        ("pk1", b"data1", "668", 123, None, None),
        ("pk2", b"data2", "668", 124, None, None),
        ("k", b"", "669", 0, None, None),
        ("k", bytes.fromhex("f3899ac2") + b"x", "670", 0, None, None),
    ]


def test_an_aggregate_of_nothing_yields_nothing(spark):
    empty = MAGIC_PLAIN + hashlib.md5(b"").digest()
    df = spark.createDataFrame([("k", "1", 0, None, None, empty), ("k", "2", 0, None, None, b"x")], ENVELOPE_DDL)
    assert [r.base for r in deaggregate(df).collect()] == ["2"]


@pytest.mark.parametrize(
    "damaged, error",
    [
        (golden(SIMPLE)[:-1] + b"\0", "checksum"),
        (MAGIC_PLAIN + b"short", "shorter"),
        (MAGIC_DEFLATED + b"not zlib", "Error"),
        (MAGIC_PLAIN + (b := bytes.fromhex("1a0608051a026161")) + hashlib.md5(b).digest(), "key table"),
    ],
)
def test_damaged_aggregates_fail(spark, damaged, error):
    df = spark.createDataFrame([("k", "1", 0, None, None, damaged)], ENVELOPE_DDL)
    with pytest.raises(PySparkException, match=error):
        deaggregate(df).collect()


def test_checksum_can_be_switched_off(spark):
    damaged = golden(SIMPLE)[:-1] + b"\0"
    df = spark.createDataFrame([("k", "1", 0, None, None, damaged)], ENVELOPE_DDL)
    assert deaggregate(df, check=False).count() == 2
    assert not df.select(checksum_matches("data")).first()[0]
    with pytest.raises(PySparkException, match="does not match"):
        df.select(verify_checksum("data")).collect()


def test_formats(spark):
    rows = [(golden(SIMPLE), "aggregated"), (MAGIC_DEFLATED + b"x", "deflated"), (b"\x00\x89", "plain"), (b"", "plain")]
    df = spark.createDataFrame(rows, "data binary, kind string")
    assert df.filter(record_format("data") != F.col("kind")).count() == 0


def test_keys_need_not_be_text(spark):
    key, data = b"\xff\xfe", b"d"
    agg = codec.OpenAggregate()
    agg.add(key, data, None, *agg.head(key, len(data), None))
    df = spark.createDataFrame([("k", "1", 0, None, None, agg.finish(False))], ENVELOPE_DDL)
    assert bytes(deaggregate(df).select(F.col("partition_key").cast("binary")).first()[0]) == key
    rows = spark.createDataFrame([(0, 0, key, data, None)], "lane int, n int, k binary, data binary, explicit_hash_key string")
    out = pack(rows.withColumn("partition_key", F.col("k").cast("string")), ["lane"], [F.col("n")])
    assert bytes(out.select(F.col("partition_key").cast("binary")).first()[0]) == key
    assert bytes(out.select("data").first()[0]) == agg.finish(False)


def test_clustered_input_is_not_shuffled_again(spark):
    df = users(spark, [("a", b"1", None), ("b", b"2", None)]).repartition("lane")
    once = pack(df, ["lane"], [F.col("n")], clustered=True)
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [r.n_records for r in once.collect()] == [2]


def test_unknown_fields_and_tags_are_skipped(spark):
    record = bytes.fromhex("0800") + b"\x1a\x01d" + b"\x22\x03\x0a\x01t"  # with a tag
    body = b"\x0a\x01k" + b"\x1a" + bytes([len(record)]) + record + b"\x7a\x01z"
    blob = MAGIC_PLAIN + body + hashlib.md5(body).digest()
    df = spark.createDataFrame([("k", "1", 0, None, None, blob)], ENVELOPE_DDL)
    assert [(r.partition_key, bytes(r.data)) for r in deaggregate(df).collect()] == [("k", b"d")]


def test_a_fold_is_given_wide_rows_in_portions():
    from tideline.operators.fold import STEP_BYTES, OrderedFold, _run

    class Widths(OrderedFold):
        seen: list = []

        def step(self, key, state, rows):
            self.seen.append((rows.num_rows, rows.nbytes))
            return state, None

    wide = pa.RecordBatch.from_pydict({"k": ["a"] * 40, "data": [bytes(1 << 20)] * 40})
    assert list(_run(Widths(), 1)([wide])) == []
    assert sum(n for n, _ in Widths.seen) == 40 and max(size for _, size in Widths.seen) <= STEP_BYTES
