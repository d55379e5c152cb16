import base64
import gzip
import hashlib
import io
import zlib

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.llm.warc import Cursor, archive_report, decode_payload, encode_record, page_records, records, register

PAGES = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"http://h/{i}\r\nX: é", "<p>" + "xé" * (i % 7) + "</p>", "clash") for i in range(60)]
    out += [(100, None, None, None), (101, "u", "", None), (-5, "u", "WARC/1.1\r\n\r\nHTTP", None), (3, "v", "<p>xéxéxé</p>", "c")]
    return out + [(70, "u", "same", None)] * 3 + [(71, "u", "same", None), (None, "u", "same", None), (None, "u", "alone", None)]


def digest(html):
    return base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_come_back(spark, rows, min_bytes):
    groups, want = {}, []
    for page_id, _, html, _ in rows:
        groups.setdefault(html or "", []).append(page_id)
    for html, ids in groups.items():
        n = len(html.encode())
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, page_id in enumerate(ids):
            later = k > 0 and n >= min_bytes
            want.append((page_id, n, digest(html), "revisit" if later else "response", ids[0] if later else None))
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    got = [tuple(r) for r in archive_report(df, min_bytes).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert archive_report(spark.createDataFrame([], PAGES)).collect() == []


def test_files_are_rolled_and_headers_tested_before_payloads(spark, rows, tmp_path):
    register(spark)
    path = f"file://{tmp_path}/w"
    written = page_records(spark.createDataFrame(rows, PAGES).coalesce(2))
    written.write.format("warc").option("file_bytes", 2000).mode("append").save(path)
    assert len(list((tmp_path / "w").glob("*.warc"))) > 4
    back = spark.read.format("warc").option("partition_bytes", 3000).load(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, written.withColumn("target_uri", F.regexp_replace(F.regexp_replace("target_uri", "\r", "%0D"), "\n", "%0A")).collect()))
    assert back.rdd.getNumPartitions() > 2
    some = back.filter("record_type = 'revisit' and record_id like 'urn:page:7%'")
    assert {r.record_id for r in some.collect()} == {f"urn:page:{i}" for i in (7, 70, 71)}
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert bare.filter("payload is not null").count() == 0 and bare.count() == len(rows)


def test_unwanted_payloads_are_not_read():
    row = {"record_type": "response", "record_id": "a", "target_uri": None, "refers_to": None, "payload_digest": None, "payload_bytes": 3}
    good, broken = encode_record(row | {"payload": b"abc"}), encode_record(row | {"record_id": "b", "payload": b"x"})
    broken = broken.replace(b"Content-Length: 21", b"Content-Length: 00")
    file = pa.PythonFile(io.BytesIO(good + broken + good), "r")
    got = list(records(file, lambda r: r["record_id"] == "a", payload=True))
    assert [r["payload"] for r in got] == [b"abc", b"abc"]
    assert decode_payload(b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi") == b"hi"
    assert decode_payload(b"HTTP/1.1 204 No Content\r\n\r\n") is None
    assert decode_payload(b"HTTP/1.1 200 OK\r\n\r\n") == b"" and decode_payload(b"HTTP/1.1 200 OK\r\n\r\n", "revisit") is None


ROW = {"record_type": "response", "record_id": "a", "target_uri": None, "refers_to": None, "payload_digest": None, "payload_bytes": 3}


def load(spark, path, **options):
    register(spark)
    return spark.read.format("warc").options(**options).load(str(path))


def test_jobs_append_and_overwrite(spark, tmp_path):
    register(spark)
    path = f"{tmp_path}/w"
    for i in (1, 2, 3):
        mode = "append" if i < 3 else "overwrite"
        page_records(spark.createDataFrame([(i, "u", f"html {i}", "c")], PAGES)).write.format("warc").mode(mode).save(path)
        want = {2: [1, 2], 1: [1], 3: [3]}[i]
        assert sorted(r.record_id for r in load(spark, path).collect()) == [f"urn:page:{k}" for k in want]
    assert len(list((tmp_path / "w").glob("*.warc"))) == 1


@pytest.mark.parametrize("payload", ["true", "false"])
@pytest.mark.parametrize("cut", [1, 3, 5, 40])
@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
def test_truncated_archives_fail(spark, tmp_path, payload, cut, name):
    data = encode_record(ROW | {"payload": b"abc"}) * 2
    data = gzip.compress(data) if name.endswith("gz") else data
    (tmp_path / name).write_bytes(data)
    assert load(spark, tmp_path, payload=payload).count() == 2
    (tmp_path / name).write_bytes(data[:-cut])
    with pytest.raises(PySparkException):
        load(spark, tmp_path, payload=payload).collect()


def test_foreign_archives(spark, tmp_path):
    def record(kind, block, more=b"", content=b"application/http; msgtype=response"):
        head = b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\n" + more + b"Content-Type: " + content
        return head + b"\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    ok, wide = b"HTTP/1.1 200 OK\r\n", b"x" * 3_000_000
    bodies = [
        (record(b"warcinfo", b"software: x", content=b"application/warc-fields"), b"software: x"),
        (record(b"response", ok + b"Server: x\r\n\r\nto the end"), b"to the end"),
        (record(b"response", ok + b"Transfer-Encoding: chunked\r\n\r\n3;a=b\r\nabc\r\nA\r\n0123456789\r\n0\r\n\r\n"), b"abc0123456789"),
        (record(b"response", ok + b"Content-Encoding: deflate\r\n\r\n" + zlib.compress(b"deflated")), b"deflated"),
        (record(b"response", ok + b"Content-Encoding: gzip\r\n\r\n" + gzip.compress(b"two ") + gzip.compress(b"members")), b"two members"),
        (record(b"response", ok + b"Content-Length: 99\r\n\r\nearly", b"WARC-Truncated: length\r\n"), b"early"),
        (record(b"response", ok + b"\r\n" + wide), wide),
        (record(b"request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n"), b""),
        (record(b"revisit", ok + b"Server: x\r\n\r\n"), None),
    ]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r, _ in bodies))
    (tmp_path / "y.warc").write_bytes(b"".join(r for r, _ in bodies))
    got = load(spark, tmp_path).collect()
    assert sorted(map(str, (r.payload and bytes(r.payload) for r in got))) == sorted(map(str, [b or (None if b is None else b) for _, b in bodies] * 2))
    assert load(spark, tmp_path, payload="false").count() == 18
    short = record(b"response", ok + b"Content-Length: 99\r\n\r\nearly")
    coded = record(b"response", ok + b"Content-Encoding: br\r\n\r\n??")
    for bad in (short, coded):
        (tmp_path / "y.warc").write_bytes(bad)
        with pytest.raises(PySparkException):
            load(spark, tmp_path).collect()
    assert b"??" in [r.payload and bytes(r.payload) for r in load(spark, tmp_path, undecodable="raw").collect()]
    with pytest.raises(PySparkException):
        load(spark, tmp_path, undecodable="drop").collect()


def test_urls_of_repeated_pages_stay(spark, tmp_path):
    rows = [(1, u, "same", "c") for u in ("b", "a", "a", None)] + [(2, "z", "same", "c")]
    got = [(r.record_type, r.target_uri, r.refers_to) for r in page_records(spark.createDataFrame(rows, PAGES)).collect()]
    one = "urn:page:1"
    assert sorted(got, key=str) == sorted(
        [("response", "a", None), ("revisit", "a", one), ("revisit", "b", one), ("revisit", None, one), ("revisit", "z", one)], key=str
    )


def test_marks_across_blocks():
    data = b"a" * 10 + b"\r\n\r\n" + b"b" * 5
    cursor = Cursor(pa.PythonFile(io.BytesIO(data), "r"))
    cursor.file = type("Small", (), {"read": lambda self, n, f=io.BytesIO(data): f.read(min(n, 3))})()
    assert cursor.until(b"\r\n\r\n") == b"a" * 10
    assert cursor.take(1) == b"b"
