import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import records
from tideline.functions import (
    base_key,
    decode_base,
    decode_data,
    encode_checkpoint,
    is_sub_record,
    keep_lines,
    shutdown_reason,
)
from tideline.operators.counters import flush_by_count
from tideline.operators.deaggregate import deaggregate
from tideline.sources import (
    dump_to_dir,
    fetch_batches,
    initial_position,
    parse_envelopes,
    parse_requests,
    read_dir,
    read_lines,
    resume_from_checkpoint,
    shard_ends,
    shard_starts,
    stream_records,
    stream_tip,
    to_request_lines,
    union_streams,
)

LINES = [
    '{"action":"initialize","shardId":"a","sequenceNumber":"007","subSequenceNumber":3}',
    "",
    '{"action":"processRecords","records":[{"data":"d2hhdGV2ZXI=","partitionKey":"PK","sequenceNumber":"666"}]}\r',
    '{"action":"processRecords","millisBehindLatest":12,"records":[{"action":"record","data":"ZGF0YTE=","partitionKey":"pk1",'
    '"sequenceNumber":"0667","subSequenceNumber":123,"approximateArrivalTimestamp":99},'
    '{"action":"record","data":"ZGF0YTI=","partitionKey":"pk2","sequenceNumber":"667","subSequenceNumber":124}]}',
    '{"action":"processRecords","millisBehindLatest":0,"records":[]}',
    '{"action":"shutdown","reason":"TERMINATE"}',
    '{"action":"shutdownRequested"}',
]


def lines(spark, rows=LINES):
    return spark.createDataFrame([("s", "a", v) for v in rows], "stream_name string, shard_id string, value string")


def test_records_of_both_protocol_versions(spark):
    got = stream_records(parse_envelopes(lines(spark))).orderBy("base", "sub").collect()
    assert [
        (r.partition_key, r.base, r.sub, r.user_sub, r.user_total, r.arrival_ms, r.delay_ms, bytes(r.data)) for r in got
    ] == [
        ("PK", "666", None, None, None, None, None, b"whatever"),
        ("pk1", "667", 123, None, None, 99, 12, b"data1"),
        ("pk2", "667", 124, None, None, None, 12, b"data2"),
    ]
    versions = {r.partition_key: r.is_v2 for r in parse_envelopes(lines(spark)).collect()}
    assert versions == {"PK": False, "pk1": True, "pk2": True}


def test_starts_and_ends(spark):
    start = shard_starts(lines(spark)).collect()
    assert [(r.stream_name, r.shard_id, r.base, r.sub, r.user_sub) for r in start] == [("s", "a", "7", 3, 3)]
    none = shard_starts(lines(spark, ['{"action":"initialize","shardId":"a","sequenceNumber":null}'])).first()
    assert (none.base, none.sub) == (None, None)
    assert [r.reason for r in shard_ends(lines(spark)).collect()] == ["TERMINATE", "ZOMBIE"]
    reasons = spark.createDataFrame([("TERMINATE",), ("ZOMBIE",), ("X",)], "r string").select(shutdown_reason("r")).collect()
    assert [r[0] for r in reasons] == ["terminate", "zombie", "unknown"]


def test_bad_lines_fail_or_are_set_aside(spark):
    broken = lines(spark, [LINES[2], '{"action":'])
    with pytest.raises(Exception, match="Malformed"):
        parse_envelopes(broken).collect()
    rows = parse_requests(broken, on_error="route").collect()
    assert sorted((r.request is None, r._corrupt_record) for r in rows) == [(False, None), (True, '{"action":')]
    with pytest.raises(ValueError):
        parse_requests(broken, on_error="ignore")


def test_text_files_by_shard(spark, tmp_path):
    for shard in ("x", "y"):
        (tmp_path / f"shard_id={shard}").mkdir()
        (tmp_path / f"shard_id={shard}" / "0001").write_bytes((LINES[2] + "\n\n" + LINES[3] + "\n").encode())
    df = parse_envelopes(read_lines(spark, str(tmp_path), "s"))
    assert {(r.shard_id, r.sequence_number) for r in df.collect()} == {
        (s, n) for s in "xy" for n in ("666", "0667", "667")
    }


def test_round_trip_through_the_wire(spark):
    df = records(spark, [("a", 10**55 + i, None, None, i) for i in range(5)]).withColumn("delay_ms", F.lit(4).cast("bigint"))
    back = deaggregate(stream_records(parse_envelopes(to_request_lines(df))))
    cols = ["stream_name", "shard_id", "partition_key", "base", "base_key", "sub", "user_sub", "user_total", "arrival_ms", "delay_ms", "data"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, df.select(cols).collect()))


def test_base64_is_strict_and_replaceable(spark):
    df = spark.createDataFrame([("aGk=",)], "d string")
    assert bytes(df.select(decode_data("d")).first()[0]) == b"hi"
    wrapped = spark.createDataFrame([("aGk=\n",), ("a\nGk=",)], "d string")
    assert [bytes(r[0]) for r in wrapped.select(decode_data("d")).collect()] == [b"hi", b"hi"]
    assert df.select(decode_data("d", lambda c: F.upper(c))).first()[0] == "AGK="
    with pytest.raises(PySparkException):
        spark.createDataFrame([("%%%",)], "d string").select(decode_data("d")).collect()


def test_sequence_numbers(spark):
    big = "49590338271490256608559692538361571095921575989136588898"
    df = spark.createDataFrame([("000",), ("0012",), (big,), ("LATEST",), ("9",)], "t string")
    got = [r.b for r in df.select(decode_base("t").alias("b")).orderBy(base_key("b")).collect()]
    assert got == ["0", "9", "12", big, "LATEST"]
    with pytest.raises(PySparkException, match="not a sequence number"):
        spark.createDataFrame([("12ab",)], "t string").select(decode_base("t")).collect()


def test_sub_records(spark):
    df = spark.createDataFrame([(0, 2, True), (1, 2, False), (None, None, False), (0, None, False)], "s bigint, t bigint, e boolean")
    assert df.filter(is_sub_record("s", "t") != F.col("e")).count() == 0


def test_checkpoint_lines(spark):
    df = spark.createDataFrame([("5", 2), ("5", None), (None, 7)], "base string, sub bigint").coalesce(1)
    v2 = [json.loads(r[0]) for r in df.select(encode_checkpoint()).collect()]
    assert v2 == [
        {"action": "checkpoint", "sequenceNumber": "5", "subSequenceNumber": 2},
        {"action": "checkpoint", "sequenceNumber": "5", "subSequenceNumber": None},
        {"action": "checkpoint", "sequenceNumber": None, "subSequenceNumber": None},
    ]
    v1 = [json.loads(r[0]) for r in df.select(encode_checkpoint(v2=False)).collect()]
    assert v1[0] == {"action": "checkpoint", "checkpoint": "5"} and v1[2] == {"action": "checkpoint", "checkpoint": None}


def test_noise(spark):
    text = "\n".join(
        [
            "INFO: Received response x",
            "",
            "real trouble",
            "at com.amazonaws.services.kinesis.multilang.LineReaderTask call",
            "com.amazonaws.services.kinesis.multilang.LineReaderTask call failed",
            "INFO: Message size == 40 bytes for shard 3",
            "INFO: Message size == 41 bytes for shard 3",
        ]
    )
    df = spark.createDataFrame([(1, text)], "id int, text string")
    assert [r.line for r in keep_lines(df, "text").collect()] == [
        "real trouble",
        "com.amazonaws.services.kinesis.multilang.LineReaderTask call failed",
        "INFO: Message size == 41 bytes for shard 3",
    ]


def test_directory_there_and_back(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    (source / "sub").mkdir(parents=True)
    target.mkdir()
    (source / "a").write_bytes(b"a\n")
    (source / "b").write_bytes(b"\x00\xff")
    (source / "sub" / "c").write_bytes(b"not entered")
    files = read_dir(spark, str(source))
    assert {(r.partition_key, bytes(r.data)) for r in files.collect()} == {
        (f"{source}/a", b"a\n"),
        (f"{source}/b", b"\x00\xff"),
    }
    first = records(spark, [("s1", 9, None, None, 0), ("s2", 1, None, None, 0), ("s2", 2, None, None, 0)])
    # The last shard listed wins, and in it the last record.
    assert 1 == dump_to_dir(first.withColumn("partition_key", F.lit("k/one")), target.as_uri())
    assert [(p.name, p.read_bytes()) for p in target.rglob("*") if p.is_file()] == [("one", b"2")]
    with pytest.raises(PySparkException, match="does not name a file"):
        assert 1 == dump_to_dir(first.withColumn("partition_key", F.lit("../up")), target.as_uri())


def test_streams_side_by_side(spark):
    a, b = records(spark, [("x", 1, None, None, 0)]), records(spark, [("x", 1, None, None, 0)]).drop("data")
    both = union_streams({"one": a, "two": b})
    assert {(r.stream_name, r.shard_id) for r in flush_by_count(both, 2).filter("counter = 0").collect()} == {("one", "x"), ("two", "x")}
    with pytest.raises(ValueError):
        union_streams({})


def test_positions(spark):
    df = records(spark, [("a", i, None, None, 0) for i in range(5)] + [("new", 0, None, None, 0)])
    tip = stream_tip(df.filter("shard_id = 'a' and base <= '2'"))
    assert {(r.shard_id, r.base) for r in initial_position(df, "LATEST", tip).collect()} == {("a", "3"), ("a", "4"), ("new", "0")}
    assert initial_position(df, "TRIM_HORIZON").count() == 6
    with pytest.raises(ValueError):
        initial_position(df, "SOMEWHERE")
    with pytest.raises(ValueError):
        initial_position(df, "LATEST")


@pytest.mark.parametrize(
    "at, granularity, expected",
    [
        ((1, 1, 3), "base_sub", {(1, 0), (1, 1), (1, 2), (2, None)}),
        ((1, 2, 3), "base_sub", {(2, None)}),
        ((1, 1, 3), "user_sub", {(1, 2), (2, None)}),
        ((2, None, None), "base_sub", set()),
    ],
)
def test_resume(spark, at, granularity, expected):
    df = records(spark, [("a", 1, i, 3, 0) for i in range(3)] + [("a", 2, None, None, 0), ("b", 1, None, None, 0)])
    checkpoint = records(spark, [("a", *at, 0)])
    got = resume_from_checkpoint(df, checkpoint, granularity).collect()
    assert {(int(r.base), r.user_sub) for r in got if r.shard_id == "a"} == expected
    assert any(r.shard_id == "b" for r in got)


def test_a_null_checkpoint_starts_from_scratch(spark):
    df = records(spark, [("a", 1, None, None, 0)])
    nothing = df.withColumn("base", F.lit(None).cast("string")).withColumn("base_key", F.lit(None).cast("string"))
    assert resume_from_checkpoint(df, nothing).count() == 1
    with pytest.raises(ValueError):
        resume_from_checkpoint(df, nothing, "row")


def test_fetches_are_bounded(spark):
    df = records(spark, [("a", i, None, None, 0) for i in range(25)])
    sizes = {r.fetch: r["count"] for r in fetch_batches(df, 10).groupBy("fetch").count().collect()}
    assert sizes == {0: 10, 1: 10, 2: 5}
