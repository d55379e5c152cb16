"""WARC files as a PySpark data source, and pages written to and read from them.

Reading: the driver lists the archives (what the manifests name, or all
``.warc`` and ``.warc.gz`` files) and packs whole files into partitions by size. A task parses a record's
headers first. Predicates on them that were pushed down are tested there; a
record that fails, or whose payload is not asked for, is passed over by a
seek, neither read nor decoded. ``spark.sql.python.filterPushdown.enabled``
must be on, which :func:`register` sees to.

Writing: a task rolls its file at ``file_bytes``. Names carry the attempt, so
a retried task never meets its other attempt, and readers only see what
manifests list. Each job writes one when all its tasks have ended: jobs that
append add to the folder, one that overwrites replaces what others listed.
Bodies are compressed each by itself, as HTTP content.

Payloads: of HTTP records the body, with chunks joined and ``gzip`` or
``deflate`` undone; without a length it reaches to the end of the block. Of
other records the block. Status 204 and revisits without body have none
(NULL). A record or body that ends early fails, whether its payload is asked
for or not, unless it says that it was truncated (``WARC-Truncated``); so
does another content coding, unless ``undecodable`` is ``raw``, which leaves the bytes as they are.

Options: ``payload`` (false: leave it NULL), ``undecodable``,
``partition_bytes``, ``file_bytes``. Paths may have any scheme that pyarrow opens.

Columns: record_type, record_id, target_uri, refers_to, payload_digest,
payload_bytes, payload. NULL headers are left out and read as NULL; line ends
in headers are percent-encoded; a NULL payload is written without body and
read as NULL, an empty one as empty.
"""

from __future__ import annotations

import gzip
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tideline.llm.shared import checkpointed, scratch

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
#: Names of header fields, and the profile of records that repeat a payload.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}
BRACKETED = ("record_id", "refers_to")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "_manifest"
END = b"\r\n\r\n"

READ_BYTES = 1 << 20
BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20


def _clean(value: str) -> str:
    return "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value)


def encode_record(row: dict) -> bytes:
    """One record: header, and an HTTP response with the compressed payload unless that is NULL."""
    head = [VERSION.decode(), f"WARC-Date: {DATE}"]
    for name, field in FIELDS.items():
        value = row[name]
        if value is not None:
            value = _clean(str(value))
            head.append(f"{field}: <{value}>" if name in BRACKETED else f"{field}: {value}")
    if row["record_type"] == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
    status = b"204 No Content" if row["payload"] is None else b"200 OK"
    block = b"HTTP/1.1 " + status + b"\r\nContent-Type: text/html; charset=utf-8\r\n"
    if row["payload"] is None:
        block += b"\r\n"
    else:
        body = gzip.compress(row["payload"], 6, mtime=0)
        block += b"Content-Encoding: gzip\r\nContent-Length: " + str(len(body)).encode() + END + body
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def _unchunked(body: bytes, truncated: bool) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size:
            if truncated:
                return b"".join(out)
            raise ValueError("a body ends within its chunks")
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        if len(out[-1]) < n and not truncated:
            raise ValueError("a body ends within its chunks")
        at = end + 2 + n + 2


def _inflated(body: bytes, wbits: int, truncated: bool) -> bytes:
    out = []
    while body:
        one = zlib.decompressobj(wbits)
        out.append(one.decompress(body) + one.flush())
        if not one.eof and not truncated:
            raise ValueError("a body ends within its compressed data")
        # A body may hold several members.
        body = one.unused_data if one.eof and wbits == 31 else b""
    return b"".join(out)


def decode_payload(
    block: bytes, record_type: str | None = "response", http: bool = True, truncated: bool = False, undecodable: str = "fail"
) -> bytes | None:
    """The payload of a record's block; NULL if it says that it has none."""
    if not http or not block.startswith((b"HTTP/", b"http/")) and record_type == "response":
        return block
    head, _, body = block.partition(END)
    status, *lines = head.split(b"\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(b":") for line in lines)}
    if not body and (status.split(b" ")[1:2] in ([b"204"], [b"304"]) or record_type == "revisit"):
        return None
    if b"chunked" in fields.get(b"transfer-encoding", b"").lower():
        body = _unchunked(body, truncated)
    elif b"content-length" in fields:
        length = int(fields[b"content-length"])
        if len(body) < length and not truncated:
            raise ValueError("a body is shorter than its length")
        body = body[:length]
    for coding in reversed(fields.get(b"content-encoding", b"").lower().split(b",")):
        coding = coding.strip()
        if coding in (b"gzip", b"x-gzip"):
            body = _inflated(body, 31, truncated)
        elif coding == b"deflate":
            # Some send zlib's format, some the bare one.
            body = _inflated(body, 15 if body[:1] and body[0] & 15 == 8 else -15, truncated)
        elif coding not in (b"", b"identity"):
            if undecodable == "raw":
                return body
            raise ValueError(f"content coding {coding.decode()} cannot be undone")
    return body


class Cursor:
    """Reads a file forward in blocks; skipping beyond the block seeks."""

    def __init__(self, file) -> None:
        self.file, self.buffer, self.at = file, b"", 0
        #: Bytes of a file in which seeking is cheap.
        self.size = file.size() if isinstance(file, pa.NativeFile) and file.seekable() else None

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without a mark; None at the end of the file."""
        searched = self.at
        while (found := self.buffer.find(mark, searched)) < 0:
            searched = max(0, len(self.buffer) - self.at - len(mark) + 1)
            more = self.file.read(READ_BYTES)
            if not more:
                if self.buffer[self.at :].strip():
                    raise ValueError("archive ends within a header")
                return None
            self.buffer, self.at = self.buffer[self.at :] + more, 0
        out, self.at = self.buffer[self.at : found], found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        held = self.buffer[self.at : self.at + n]
        self.at += len(held)
        if len(held) < n:
            held += self.file.read(n - len(held))
            self.buffer, self.at = b"", 0
            if len(held) < n:
                raise ValueError("archive ends within a record")
        return held

    def skip(self, n: int) -> None:
        """Pass over bytes; that they are there is checked, though they are not read."""
        held = len(self.buffer) - self.at
        if n <= held:
            self.at += n
            return
        n -= held
        self.buffer, self.at = b"", 0
        if self.size is not None:
            if self.file.tell() + n > self.size:
                raise ValueError("archive ends within a record")
            self.file.seek(n, 1)
            return
        while n:
            some = self.file.read(min(n, READ_BYTES))
            if not some:
                raise ValueError("archive ends within a record")
            n -= len(some)


def parse_header(head: bytes) -> tuple[dict, int, bool, bool]:
    """Columns of a record's header, the length of its block, whether that is HTTP, and whether it was truncated."""
    version, *lines = head.lstrip(b"\r\n").split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"no record starts here: {version[:40]!r}")
    fields = {}
    for line in lines:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode()
    row = {name: fields.get(field.lower().encode()) for name, field in FIELDS.items()}
    for name in BRACKETED:
        if row[name] is not None:
            row[name] = row[name].removeprefix("<").removesuffix(">")
    row["payload_bytes"] = None if row["payload_bytes"] is None else int(row["payload_bytes"])
    http = fields.get(b"content-type", "").replace(" ", "").lower().startswith("application/http")
    return row, int(fields[b"content-length"]), http, b"warc-truncated" in fields


def records(
    file: pa.NativeFile, wanted: Callable[[dict], bool], payload: bool, undecodable: str = "fail"
) -> Iterator[dict]:
    cursor = Cursor(file)
    while (head := cursor.until(END)) is not None:
        row, length, http, truncated = parse_header(head)
        if payload and wanted(row):
            block = cursor.take(length)
            row["payload"] = decode_payload(block, row["record_type"], http, truncated, undecodable)
            yield row
        else:
            cursor.skip(length)
            row["payload"] = None
            if wanted(row):
                yield row
        if cursor.take(len(END)) != END:
            raise ValueError("a record's length is wrong")


def opened(system: pafs.FileSystem, path: str):
    """An archive to read forward; compressed ones are members behind each other, as a rule one a record."""
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=system.open_input_stream(path, compression=None))
    return system.open_input_file(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]

    def __init__(self, paths: tuple[str, ...]) -> None:
        super().__init__(paths)
        self.paths = paths


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _uri(path: str) -> str:
    """Hadoop writes local paths as file:/x, pyarrow reads file:///x."""
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = _uri(options["path"])
        self.payload = options.get("payload", "true").lower() == "true"
        self.undecodable = options.get("undecodable", "fail")
        if self.undecodable not in ("fail", "raw"):
            raise ValueError("undecodable is 'fail' or 'raw'")
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Predicates on headers are tested here; all others go back to Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in FIELDS and type(f) in (EqualTo, In, IsNull, IsNotNull, StringStartsWith):
                self.tests.append((name, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            own = row[name]
            if kind == "IsNull":
                fits = own is None
            elif own is None:
                fits = False
            elif kind == "EqualTo":
                fits = own == value
            elif kind == "In":
                fits = own in value
            elif kind == "StringStartsWith":
                fits = own.startswith(value)
            else:
                fits = True
            if not fits:
                return False
        return True

    def partitions(self) -> list[Files]:
        system, path = file_system(self.path)
        found = system.get_file_info(pafs.FileSelector(path))
        listed = manifests(found)
        if listed:
            files = sorted((x["name"], x["bytes"]) for m in listed for x in _manifest(system, m))
        else:
            files = sorted((x.base_name, x.size) for x in found if x.base_name.endswith((".warc", ".warc.gz")))
        out: list[Files] = []
        some: list[str] = []
        size = 0
        for name, n in files:
            if some and size + n > self.partition_bytes:
                out.append(Files(tuple(some)))
                some, size = [], 0
            some.append(name)
            size += n
        return [*out, Files(tuple(some))] if some else out or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, path = file_system(self.path)
        rows: list[dict] = []
        size = 0
        for name in partition.paths:
            with opened(system, f"{path}/{name}") as file:
                for row in records(file, self.wanted, self.payload, self.undecodable):
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def manifests(found: list[pafs.FileInfo]) -> list[str]:
    """Paths of the manifests among a folder's files."""
    return sorted(x.path for x in found if x.base_name.startswith(MANIFEST) and x.base_name.endswith(".json"))


def _manifest(system: pafs.FileSystem, path: str) -> list[dict]:
    with system.open_input_stream(path) as f:
        return json.loads(f.read())


ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool = False) -> None:
        self.overwrite = overwrite
        self.path = _uri(options["path"])
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator) -> Written:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        task = TaskContext.get()
        # Task ids start again with each application, so a part of its own tells jobs apart.
        stem = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:12]}"
        files: list[tuple[str, int]] = []
        out, size = None, 0
        for row in iterator:
            data = encode_record(row.asDict())
            if out is not None and size + len(data) > self.file_bytes:
                out.close()
                files[-1] = (files[-1][0], size)
                out = None
            if out is None:
                files.append((f"{stem}-{len(files)}.warc", 0))
                out, size = system.open_output_stream(f"{path}/{files[-1][0]}"), 0
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
            files[-1] = (files[-1][0], size)
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        before = manifests(system.get_file_info(pafs.FileSelector(path))) if self.overwrite else []
        files = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{path}/{MANIFEST}-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([{"name": name, "bytes": size} for name, size in files]).encode())
        for old in before:
            gone = _manifest(system, old)
            system.delete_file(old)
            for x in gone:
                system.delete_file(f"{path}/{x['name']}")

    def abort(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                system.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


#: The digits of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: every five hexadecimal digits are four digits of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _urn(key: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit("none")))


def _key(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A record per row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of ``min_bytes`` or more, the one with the
    smallest page_id (NULL counts as largest), of several that with the smallest
    url (NULL last), of repeated rows one, carries the payload; the others refer
    to it. Every record has the url of its row. An empty table gives no records. Who is first is found from digests; only
    payloads that are written move, and the join on a payload that many pages
    share is narrow.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    facts = {
        "id": F.sha2(payload, 256),
        "payload_bytes": F.octet_length(payload).cast("bigint"),
        "payload_digest": F.concat(F.lit("sha1:"), base32_sha1(payload)),
    }
    rows = pages.withColumns(facts).drop("html")
    shared = rows.filter(F.col("payload_bytes") >= min_bytes)
    place = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url").isNull(), F.col("url"), F.col("n"))
    counted = shared.groupBy("id", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("id").agg(F.min(place).alias("p"))
    first = checkpointed(
        first.select("id", F.col("p.page_id").alias("first_id"), F.col("p.url").alias("first_url"), F.col("p.n").alias("ties"))
    )
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    none = F.lit(None).cast("string")

    def records_of(df: DataFrame, kind: str, refers_to: Column, body: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("record_type"),
            _urn(F.col("page_id")).alias("record_id"),
            F.col("url").alias("target_uri"),
            refers_to.alias("refers_to"),
            "payload_digest",
            "payload_bytes",
            body.cast("binary").alias("payload"),
        )

    joined = shared.join(first, "id")
    # Rows that share the first id: one of them is the response, the rest refer to it like any other.
    later = joined.filter(~is_first)
    tied = not first.filter("ties > 1").isEmpty()
    if tied:
        again = (
            joined.filter(is_first & (F.col("ties") > 1))
            .select("id", "first_id", "first_url", "ties", "page_id", "url", "payload_digest", "payload_bytes")
            .distinct()
            .withColumn("i", F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("ties"))))
        )
        later = later.unionByName(again.select(joined.columns))
    revisits = records_of(later, "revisit", _urn(F.col("first_id")), F.lit(None))
    whole = pages.withColumns(facts).withColumn("payload", payload)
    small = whole.filter(F.col("payload_bytes") < min_bytes)
    match = (F.col("id") == F.col("_id")) & is_first
    keyed = first.withColumnRenamed("id", "_id")
    responses = whole.filter(F.col("payload_bytes") >= min_bytes).join(keyed, match)
    if tied:
        one = responses.filter("ties > 1").dropDuplicates(["id"])
        responses = responses.filter("ties = 1").unionByName(one)
    return (
        records_of(responses, "response", none, F.col("payload"))
        .unionByName(records_of(small, "response", none, F.col("payload")))
        .unionByName(revisits)
    )


def archive_report(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Writes archives of ``pages`` and reads them: one row per record.

    Payloads are decoded for responses only, and measured as they come back.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or scratch(spark, "warc")
    page_records(pages, min_bytes).write.format("warc").mode("append").save(path)
    columns = (
        _key(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_bytes")).alias("payload_bytes"),
        F.coalesce(base32_sha1(F.col("payload")), F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        _key(F.col("refers_to")).alias("refers_to"),
    )
    responses = spark.read.format("warc").load(path).filter("record_type = 'response'")
    revisits = spark.read.format("warc").option("payload", "false").load(path).filter("record_type = 'revisit'")
    return responses.select(*columns).unionByName(revisits.select(*columns))
