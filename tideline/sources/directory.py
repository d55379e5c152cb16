"""Directories of files as a source and a sink of records."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.sequence import order_key
from tideline.operators.sizing import keyed_join
from tideline.schema import SHARD


#: Bytes of files that a task reads, and about the bytes of a batch.
READ_BYTES = 64 << 20


def arrow_uri(path: str) -> str:
    """A location as pyarrow names it: Hadoop writes local ones as ``file:/x`` or ``/x``."""
    if path.startswith("/"):
        return "file://" + path
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def _files(spark: SparkSession, path: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The qualified directory, and name, size and time of each regular file directly in it."""
    directory = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = directory.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [s for s in fs.listStatus(directory) if s.isFile() and not s.getPath().getName().startswith(".")]
    files = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found]
    return fs.makeQualified(directory).toString(), files


def _reader(uri: str):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            first, size, data = 0, 0, []
            for i, name in enumerate(batch.column("name").to_pylist()):
                with fs.open_input_stream(posixpath.join(root, name)) as f:
                    data.append(f.read())
                size += len(data[-1])
                if size >= READ_BYTES or i + 1 == batch.num_rows:
                    piece = batch.slice(first, len(data))
                    columns = [piece.column("partition_key"), piece.column("arrival_ms"), pa.array(data, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["partition_key", "arrival_ms", "data"])
                    first, size, data = i + 1, 0, []

    return read


def read_dir(spark: SparkSession, path: str, *, streaming: bool = False, **options) -> DataFrame:
    """One record per regular file directly in ``path``, keyed ``<path>/<name>``.

    Subdirectories are not entered, files whose name starts with ``.`` are
    hidden. The driver lists names; tasks read the bytes, as many files each as
    make up ``READ_BYTES``. A stream uses Spark's own reader (with ``options``),
    which also hides names that start with ``_``.
    """
    key = path.rstrip("/") + "/"
    if streaming:
        reader = spark.readStream.schema("path string, modificationTime timestamp, length bigint, content binary")
        files = reader.format("binaryFile").options(**{k: str(v) for k, v in options.items()}).load(path)
        return files.select(
            F.concat(F.lit(key), F.regexp_extract("path", r"([^/]+)$", 1)).alias("partition_key"),
            F.unix_millis("modificationTime").alias("arrival_ms"),
            F.col("content").alias("data"),
        )
    root, files = _files(spark, path)
    names = spark.createDataFrame(files, "name string, size bigint, arrival_ms bigint")
    parts = max(1, min(len(files), -(-sum(size for _, size, _ in files) // READ_BYTES)))
    dealt = names.withColumn("partition_key", F.concat(F.lit(key), F.col("name"))).repartition(parts, F.xxhash64("name"))
    return dealt.mapInArrow(_reader(arrow_uri(root)), "partition_key string, arrival_ms bigint, data binary")


def latest_per_key(records: DataFrame, keys: Sequence[str] = ("partition_key",)) -> DataFrame:
    """The record that is written last for each key.

    Shards are written in the order of their ids and each shard in record order.
    The last place of each key is found on narrow columns; only records at that
    place, one per key but for repeated ones, are then aggregated. Of unequal
    data at one place the hash decides, so reruns agree.
    """
    keys = list(keys)
    place = F.struct(F.col(SHARD), order_key())
    last = records.groupBy(*keys).agg(F.max(place).alias("_place"))
    at = keyed_join(records.withColumn("_place", place), last, [*keys, "_place"])
    record = F.struct(SHARD, "base", "sub", "user_sub", "data")
    one = F.max_by(record, F.struct(F.xxhash64("data"), F.col("data"))).alias("_last")
    return at.groupBy(*keys).agg(one).select(*keys, "_last.*")


def _relative(key: str | None) -> str | None:
    """The file that a key names below a directory, in its shortest spelling; None if there is none."""
    relative = posixpath.normpath((key or "").lstrip("/"))
    return None if relative in ("", ".", "..") or relative.startswith("../") else relative


def file_name(key: Column) -> Column:
    """The file each key names; keys that name no file fail."""

    def names(keys: pa.Array) -> pa.Array:
        found = [_relative(k) for k in keys.to_pylist()]
        if None in found:
            bad = keys[found.index(None)].as_py()
            raise ValueError(f"partition key does not name a file in the directory: {bad!r}")
        return pa.array(found, pa.string())

    names.__annotations__ = {"keys": pa.Array, "return": pa.Array}
    return F.arrow_udf(names, "string")(key)


def _writer(uri: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        made: set[str] = set()
        for batch in batches:
            for name, data in zip(batch.column("partition_key").to_pylist(), batch.column("data")):
                path = posixpath.join(root, name)
                parent = posixpath.dirname(path)
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                # A retried or duplicated task rewrites the same bytes; readers never see half a file.
                partial = posixpath.join(parent, f".{uuid.uuid4().hex}.tmp")
                with fs.open_output_stream(partial) as out:
                    out.write(data.as_buffer())
                fs.move(partial, path)
            yield pa.RecordBatch.from_pydict({"n_files": pa.array([batch.num_rows], pa.int64())})

    return write


def dump_to_dir(records: DataFrame, uri: str) -> int:
    """Write the last record of every key to a file named by the key; return how many.

    ``uri`` is a location every executor reaches (``hdfs://``, ``s3://``,
    ``file:///`` on a shared mount). Keys that spell one file differently are one key.
    """
    named = records.withColumn("partition_key", file_name(F.col("partition_key")))
    latest = latest_per_key(named).select("partition_key", "data")
    written = latest.mapInArrow(_writer(arrow_uri(uri)), "n_files bigint").agg(F.sum("n_files")).first()[0]
    return int(written or 0)
