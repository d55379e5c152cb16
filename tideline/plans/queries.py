"""One query per operator, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import (
    checksum_matches,
    decode_base,
    decode_data,
    encode_checkpoint,
    is_sub_record,
    keep_lines,
    record_format,
    record_size,
    varint_size,
    verify_checksum,
)
from tideline.functions.sequence import base_key
from tideline.operators.checkpoint_log import log_checkpoints, processor_checkpoints, read_checkpoint_log
from tideline.operators.counters import (
    arrival_counter,
    count_checkpoints,
    flush_by_count,
    latest_checkpoint,
    shard_counters,
)
from tideline.operators.deaggregate import deaggregate
from tideline.operators.flush import flush_batches, flush_by_bytes, flush_by_interval, flush_log, flush_tokens, heartbeat_flush
from tideline.operators.flusher import Flusher, partial_tokens, run_flusher
from tideline.operators.frontier import (
    checkpoint_schedule,
    final_checkpoints,
    frontier,
    frontier_history,
    stalled_shards,
)
from tideline.operators.pack import key_dictionary, oversize_records, pack, pack_header, with_lanes
from tideline.operators.processor import RecordProcessor, process_shards
from tideline.operators.sizing import ensure_checkpoint_dir
from tideline.plans.stream_queries import (
    HOT,
    HOUR,
    CountingWorker,
    land,
    landed,
    staged_events,
    stream_checkpoint_schedule,
    stream_deaggregate,
    stream_end_to_end,
    stream_final_checkpoints,
    stream_flush,
    stream_flush_hot,
    stream_frontier,
    stream_processor_checkpoints,
    stream_shard_counters,
    work_folder,
)
from tideline.plans.streams import (
    document_records,
    event_stream,
    line_stream,
    packed_orders,
    table,
)
from tideline.sources.directory import arrow_uri, dump_to_dir, latest_per_key, read_dir
from tideline.sources.envelopes import (
    LINE_PLACE,
    deliveries,
    parse_envelopes,
    parse_requests,
    read_lines,
    stream_records,
    to_request_lines,
)
from tideline.sources.sessions import SESSION_KEYS, worker_sessions
from tideline.sources.streams import (
    fetch_batches,
    initial_position,
    resume_from_checkpoint,
    stream_tip,
    union_streams,
)
from tideline.streaming.processor import process_shards_stream

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_PER_REQUEST = 100
DOCS_PER_BATCH = 50
DOCS_PER_LANE = 100
SUMMARY_BYTES = 1 << 18
CAPACITY_BYTES = 400
NOISE = ("^The ", "^(Is|Au) ", "en\\.$")


def text(c: str = "data"):
    return F.decode(c, "UTF-8").alias("data")


def events_open(spark, sf_dir):
    """Events with a sparse scatter of records still open."""
    return event_stream(spark, sf_dir).withColumn("done", F.col("value") < 300)


def lines_open(spark, sf_dir):
    return line_stream(spark, sf_dir).withColumn("done", F.col("l_quantity") < 50)


def request_lines(spark, sf_dir):
    """Several event records per request line, as a consumer receives them."""
    record = F.struct(
        F.lit("record").alias("action"),
        F.base64("data").alias("data"),
        F.col("partition_key").alias("partitionKey"),
        F.col("base").alias("sequenceNumber"),
        F.col("sub").alias("subSequenceNumber"),
        F.col("arrival_ms").alias("approximateArrivalTimestamp"),
    )
    request = F.floor(F.col("event_id") / EVENTS_PER_REQUEST).alias("request")
    # Groups are bounded: at most EVENTS_PER_REQUEST ids share a request.
    grouped = event_stream(spark, sf_dir).groupBy("stream_name", "shard_id", request).agg(
        F.collect_list(record).alias("records"), (F.max("arrival_ms") - F.min("arrival_ms")).alias("delay")
    )
    body = F.struct(
        F.lit("processRecords").alias("action"), F.col("delay").alias("millisBehindLatest"), F.col("records")
    )
    return grouped.select("stream_name", "shard_id", F.concat(F.to_json(body), F.lit("\r")).alias("value"))


# --- sources ------------------------------------------------------------------------------


def parse_envelopes_query(spark, sf_dir):
    parsed = parse_envelopes(request_lines(spark, sf_dir))
    return parsed.select(
        "shard_id", "partition_key", "sequence_number", "sub", "arrival_ms", "delay_ms", "data"
    )


def route_bad_lines_query(spark, sf_dir):
    """One line per event; some hold more than one request, an end too many, or a record without data."""
    lines = to_request_lines(event_stream(spark, sf_dir).withColumn("shard_id", F.col("base")))
    kind = F.col("shard_id").cast("bigint") % 13
    value = F.col("value")
    damaged = (
        F.when(kind == 0, F.concat(value, F.lit(" xyz")))
        .when(kind == 1, F.concat(value, value))
        .when(kind == 2, F.regexp_replace(value, '"data":"[^"]*",', ""))
        .when(kind == 3, F.regexp_replace(value, "processRecords", "process"))
        .otherwise(value)
    )
    routed = parse_requests(lines.withColumn("value", damaged), on_error="route")
    number = F.col("request.records")[0]["sequenceNumber"]
    return routed.select(
        F.col("shard_id").alias("line"),
        F.col("_corrupt_record").isNotNull().cast("bigint").alias("routed"),
        number.alias("sequence_number"),
    )


def delivery_heartbeats_query(spark, sf_dir):
    """Views arrive as deliveries without records; every delivery is a sign of life."""
    events = event_stream(spark, sf_dir)
    record = F.struct(F.base64("data").alias("data"), F.col("base").alias("sequenceNumber"))
    none = F.array(record).cast("array<struct<data:string,sequenceNumber:string>>")
    body = F.struct(
        F.lit("processRecords").alias("action"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("millisBehindLatest"),
        F.when(F.col("event_type") == "view", F.slice(none, 1, 0)).otherwise(F.array(record)).alias("records"),
    )
    named = F.to_json(body, {"ignoreNullFields": "false"})
    bare = F.to_json(body)
    value = F.when(F.col("event_id") % 2 == 0, named).otherwise(bare)
    lines = events.select("stream_name", "shard_id", "arrival_ms", value.alias("value"))
    return deliveries(lines, clock="arrival_ms").select(
        "shard_id", "arrival_ms", "n_records", "delay_ms", F.col("is_v2").cast("bigint").alias("is_v2")
    )


def keyed_events(spark, sf_dir):
    """Events keyed by names of files, some with a leading underscore."""
    key = F.concat_ws("-", F.col("event_type"), (F.col("event_id") % 37).cast("string"))
    return event_stream(spark, sf_dir).withColumn(
        "partition_key", F.concat(F.when(F.col("event_id") % 37 < 9, "/_").otherwise("./"), key)
    )


def read_dir_query(spark, sf_dir):
    """The last event of each key to a file in the shared folder, and the folder back."""
    target = f"{ensure_checkpoint_dir(spark)}/events-{uuid.uuid4().hex}"
    dump_to_dir(keyed_events(spark, sf_dir), target)
    files = read_dir(spark, target)
    return files.select(
        F.regexp_extract("partition_key", "([^/]+)$", 1).alias("name"),
        F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.md5("data").alias("digest"),
    )


def dump_latest_query(spark, sf_dir):
    keyed = event_stream(spark, sf_dir).withColumn(
        "partition_key", F.concat_ws("-", F.col("event_type"), (F.col("event_id") % 37).cast("string"))
    )
    return latest_per_key(keyed).select("partition_key", "shard_id", "base", text())


def union_streams_query(spark, sf_dir):
    both = union_streams({"clicks": event_stream(spark, sf_dir), "orders": line_stream(spark, sf_dir)})
    return both.select("stream_name", "shard_id", "base", "user_sub", "partition_key")


def initial_position_query(spark, sf_dir):
    events = event_stream(spark, sf_dir)
    before = (F.col("arrival_ms") < 1_705_276_800_000) & (F.col("shard_id") != "shard-4")
    tip = stream_tip(events.filter(before))
    return initial_position(events, "LATEST", tip).select("shard_id", "base", text())


def resume_query(spark, sf_dir):
    lines = line_stream(spark, sf_dir)
    rare = table(spark, sf_dir, "lineitem").agg(F.avg("l_orderkey").alias("middle"))
    some = line_stream(spark, sf_dir).filter((F.col("shard_id") != "shard-4") & (F.col("user_sub") < 2))
    half = some.join(F.broadcast(rare), F.col("base").cast("bigint") < F.col("middle"), "left_semi")
    return resume_from_checkpoint(lines, stream_tip(half)).select("shard_id", "base", "user_sub", "user_total")


def resume_markers_query(spark, sf_dir):
    """One shard at its beginning, one at the tip, one at its end, one at a number; one knows nothing."""
    places = spark.createDataFrame(
        [("shard-0", "TRIM_HORIZON"), ("shard-1", "LATEST"), ("shard-2", "SHARD_END"), ("shard-3", "5000")],
        "shard_id string, base string",
    )
    none = F.lit(None).cast("bigint")
    marks = places.select(
        F.lit("events").alias("stream_name"),
        "shard_id",
        "base",
        base_key("base").alias("base_key"),
        none.alias("sub"),
        none.alias("user_sub"),
        none.alias("user_total"),
    )
    return resume_from_checkpoint(event_stream(spark, sf_dir), marks).select("shard_id", "base")


def fetch_batches_query(spark, sf_dir):
    return fetch_batches(event_stream(spark, sf_dir), 100).select("shard_id", "base", "fetch")


def encode_checkpoints_query(spark, sf_dir):
    lines = line_stream(spark, sf_dir)
    v2 = F.col("base").cast("bigint") % 2 == 0
    newest = F.when(F.col("user_sub") > 0, F.col("base"))
    return lines.select("base", "user_sub", encode_checkpoint(newest, F.col("user_sub"), v2).alias("line"))


# --- projections --------------------------------------------------------------------------


def b64_decode_query(spark, sf_dir):
    parsed = parse_envelopes(to_request_lines(event_stream(spark, sf_dir)))
    return parsed.select("sequence_number", decode_data("data").alias("data")).select("sequence_number", text())


def decode_seqno_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    long = F.concat(F.repeat(F.lit("7"), 125), number)
    kind = F.col("event_id") % 10
    wire = F.when(kind == 3, F.upper("event_type")).when(kind == 4, long).otherwise(F.lpad(number, 56, "0"))
    return events.select("event_id", decode_base(wire).alias("base"))


def stream_records_query(spark, sf_dir):
    parsed = parse_envelopes(to_request_lines(event_stream(spark, sf_dir)))
    records = deaggregate(stream_records(parsed))
    return records.select(
        "stream_name",
        "shard_id",
        "partition_key",
        "base",
        "sub",
        "user_sub",
        "user_total",
        "arrival_ms",
        "delay_ms",
        text(),
    )


def classify_format_query(spark, sf_dir):
    events = event_stream(spark, sf_dir)
    kind = F.col("event_id") % 4
    head = (
        F.when(kind == 0, F.unhex(F.lit("00899AC2")))
        .when(kind == 1, F.unhex(F.lit("01899AC2")))
        .when(kind == 2, F.unhex(F.lit("F3899AC2")))
        .otherwise(F.unhex(F.lit("")))
    )
    data = F.concat(head, F.col("data"))
    return events.select("event_id", record_format(data).alias("format"))


def verify_checksum_query(spark, sf_dir):
    packed = packed_orders(spark, sf_dir)
    return packed.select(
        "base",
        "n_records",
        checksum_matches("data").cast("bigint").alias("intact"),
        record_format(verify_checksum("data")).alias("format"),
    )


def is_sub_record_query(spark, sf_dir):
    lines = line_stream(spark, sf_dir)
    return lines.select("base", "user_sub", is_sub_record().cast("bigint").alias("is_sub"))


def varint_size_query(spark, sf_dir):
    n = F.col("l_partkey") * F.col("l_orderkey") * F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(n.alias("n"), varint_size(n).alias("n_bytes"))


def doc_batches(spark, sf_dir):
    docs = document_records(spark, sf_dir)
    return docs.withColumn("batch", F.floor(F.col("doc_id") / DOCS_PER_BATCH).cast("bigint"))


def record_size_query(spark, sf_dir):
    docs = doc_batches(spark, sf_dir)
    pos = F.col("doc_id")
    batch = ["lang", "batch"]
    pk = key_dictionary(docs, batch, pos)
    ehk = key_dictionary(docs, batch, pos, key="explicit_hash_key").withColumnRenamed("key_index", "ehk_index")
    first_pk = W.partitionBy(*batch, "partition_key").orderBy("doc_id")
    first_ehk = W.partitionBy(*batch, "explicit_hash_key").orderBy("doc_id")
    placed = (
        docs.withColumn("pk_new", F.row_number().over(first_pk) == 1)
        .withColumn("ehk_new", F.row_number().over(first_ehk) == 1)
        .join(pk, [*batch, "partition_key"])
        .join(ehk, [*batch, "explicit_hash_key"], "left")
    )
    size = record_size(
        F.octet_length("partition_key"),
        F.col("pk_new"),
        F.col("key_index"),
        F.octet_length("data"),
        F.octet_length("explicit_hash_key"),
        F.col("ehk_new"),
        F.coalesce("ehk_index", F.lit(0)),
    )
    return placed.select("doc_id", size.alias("n_bytes"))


def ignored_records_query(spark, sf_dir):
    counted = arrival_counter(event_stream(spark, sf_dir), ignored=F.col("event_type") == "view")
    return counted.select("shard_id", "base", "counter")


def noise_filter_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return keep_lines(docs, "text", NOISE)


# --- aggregation --------------------------------------------------------------------------


def unpacked_orders(spark, sf_dir, deflate=False):
    packed = packed_orders(spark, sf_dir, deflate).drop("n_records")
    return deaggregate(stream_records(parse_envelopes(to_request_lines(packed))))


def deaggregate_query(deflate: bool) -> Query:
    def query(spark, sf_dir):
        records = unpacked_orders(spark, sf_dir, deflate)
        return records.select("shard_id", "base", "sub", "user_sub", "user_total", "partition_key", text())

    return query


def packed_documents(spark, sf_dir, max_bytes, deflate=False):
    docs = with_lanes(document_records(spark, sf_dir), ["lang"], [F.col("doc_id")], DOCS_PER_LANE)
    return pack(docs, ["lang", "lane"], [F.col("doc_id")], max_bytes=max_bytes, deflate=deflate, fits=True)


def pack_roundtrip_query(deflate: bool) -> Query:
    def query(spark, sf_dir):
        none = F.lit(None).cast("bigint")
        packed = packed_documents(spark, sf_dir, SUMMARY_BYTES, deflate)
        unpacked = deaggregate(packed.withColumn("user_sub", none).withColumn("user_total", none))
        # Order survives: user_sub within batch within lane is the order of the documents.
        return unpacked.select(
            "lang", "lane", "batch_no", "user_sub", "user_total", "partition_key", F.md5("data").alias("digest")
        )

    return query


def pack_summary_query(spark, sf_dir):
    return packed_documents(spark, sf_dir, SUMMARY_BYTES).select(
        "lang", "lane", "batch_no", "partition_key", "explicit_hash_key", "n_records", "est_bytes"
    )


def pack_hot_query(spark, sf_dir):
    """All documents from one producer, packed without lanes by many chunks."""
    docs = document_records(spark, sf_dir).withColumn("producer", F.lit("all"))
    packed = pack(docs, ["producer"], [F.col("doc_id")], max_bytes=SUMMARY_BYTES, **HOT)
    return packed.select("producer", "batch_no", "partition_key", "explicit_hash_key", "n_records", "est_bytes")


def key_dictionary_query(spark, sf_dir):
    return key_dictionary(doc_batches(spark, sf_dir), ["lang", "batch"], F.col("doc_id"))


def pack_header_query(spark, sf_dir):
    return pack_header(doc_batches(spark, sf_dir), ["lang", "batch"], F.col("doc_id"))


def oversize_query(spark, sf_dir):
    return oversize_records(document_records(spark, sf_dir), 10_000).select("doc_id", "lone_bytes")


# --- ordered per shard --------------------------------------------------------------------


def arrival_counter_query(spark, sf_dir):
    return arrival_counter(event_stream(spark, sf_dir)).select("shard_id", "base", "counter")


def hot_events(spark, sf_dir):
    """All events in one shard."""
    return event_stream(spark, sf_dir).withColumn("shard_id", F.lit("all"))


def arrival_counter_hot_query(spark, sf_dir):
    return arrival_counter(hot_events(spark, sf_dir), **HOT).select("shard_id", "base", "counter")


def flush_by_interval_hot_query(spark, sf_dir):
    batched = flush_by_interval(
        hot_events(spark, sf_dir), 6 * HOUR, capacity=12, ignored=F.col("event_type") == "view", **HOT
    )
    return batched.select("shard_id", "base", "batch_no", "fired")


def frontier_history_hot_query(spark, sf_dir):
    rounds = done_in_rounds(spark, sf_dir).withColumn("shard_id", F.lit("all"))
    return frontier_history(rounds, **HOT).select("shard_id", "round", "base")


def process_shards_hot_query(spark, sf_dir):
    events = hot_events(spark, sf_dir).select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data")
    marks = process_shards(events, ByteMarks(1000), BYTE_MARKS, summary_columns=["data"], **HOT)
    return marks.select("shard_id", "base", "n_bytes")


def flush_batches_query(spark, sf_dir):
    """Closed batches to a file each, written by the tasks that hold them, and the files back."""
    target = f"{ensure_checkpoint_dir(spark)}/batches-{uuid.uuid4().hex}"
    batched = flush_by_interval(event_stream(spark, sf_dir), 6 * HOUR).select(
        "stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "batch_no", "fired"
    )
    flush_batches(batched, FileWriter(arrow_uri(target)))
    files = read_dir(spark, target)
    name = F.split(F.regexp_extract("partition_key", "([^/]+)$", 1), "_")
    return files.select(
        name[0].alias("shard_id"),
        name[1].cast("bigint").alias("batch_no"),
        F.explode(F.split(F.decode("data", "UTF-8"), ",")).alias("base"),
    )


class FileWriter:
    """Writes a batch's sequence numbers to a file named by shard and batch: a batch written again is overwritten."""

    def __init__(self, uri: str):
        self.uri = uri

    def __call__(self, shard: tuple, batch_no: int, batches) -> None:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(root, recursive=True)
        rows = [base for batch in batches for base in batch.column("base").to_pylist()]
        with fs.open_output_stream(f"{root}/{shard[1]}_{batch_no}") as out:
            out.write(",".join(rows).encode())


def count_checkpoints_query(spark, sf_dir):
    return count_checkpoints(event_stream(spark, sf_dir)).select("shard_id", "base", "checkpoint_no")


def latest_checkpoint_query(spark, sf_dir):
    return latest_checkpoint(line_stream(spark, sf_dir)).select(
        "stream_name", "shard_id", "base", "user_sub", "user_total", "n_records"
    )


def flush_by_count_query(spark, sf_dir):
    return flush_by_count(event_stream(spark, sf_dir), 64).select("shard_id", "base", "batch_no")


def interval_batches(spark, sf_dir):
    return flush_by_interval(
        event_stream(spark, sf_dir), 6 * HOUR, capacity=12, ignored=F.col("event_type") == "view"
    )


def byte_batches(events, **sizing):
    return flush_by_bytes(
        events, CAPACITY_BYTES, 12 * HOUR, ignored=F.col("event_type") == "view", **sizing
    ).select("shard_id", "base", "batch_no", "fired")


def flush_by_bytes_query(spark, sf_dir):
    return byte_batches(event_stream(spark, sf_dir))


def flush_by_bytes_hot_query(spark, sf_dir):
    return byte_batches(hot_events(spark, sf_dir), **HOT)


def flush_by_interval_query(spark, sf_dir):
    return interval_batches(spark, sf_dir).select("shard_id", "base", "batch_no", "fired")


def heartbeat_flush_query(spark, sf_dir):
    events = event_stream(spark, sf_dir)
    beats = events.filter(F.col("event_type") == "view").select(
        "stream_name", "shard_id", (F.col("arrival_ms") + 45 * 60_000).alias("arrival_ms")
    )
    records = events.filter(F.col("event_type") != "view")
    flushed = heartbeat_flush(records, beats, 4 * HOUR, capacity=20)
    return flushed.select("shard_id", "kind", "base", "arrival_ms", "batch_no", "fired")


def frontier_query(spark, sf_dir):
    return frontier(events_open(spark, sf_dir)).select("shard_id", "base")


def frontier_lines_query(subsequence: bool) -> Query:
    def query(spark, sf_dir):
        reached = frontier(lines_open(spark, sf_dir), subsequence=subsequence, computed=True)
        return reached.select("shard_id", "base", "user_sub", "user_total")

    return query


def done_in_rounds(spark, sf_dir):
    """Events that complete out of order: rounds follow arrival, give or take a few."""
    done_round = (F.floor(F.col("event_id") / 40) + F.col("event_id") * 13 % 7).cast("bigint")
    return event_stream(spark, sf_dir).withColumn("done_round", done_round)


def frontier_history_query(spark, sf_dir):
    return frontier_history(done_in_rounds(spark, sf_dir)).select("shard_id", "round", "base")


def checkpoint_schedule_query(spark, sf_dir):
    completions = done_in_rounds(spark, sf_dir)
    rounds = completions.groupBy("stream_name", "shard_id", F.col("done_round").alias("round")).agg(
        F.max("arrival_ms").alias("clock_ms")
    )
    sent = checkpoint_schedule(rounds, frontier_history(completions), 12 * HOUR)
    return sent.select("shard_id", "checkpoint_no", "round", "clock_ms", "base")


def final_checkpoints_query(spark, sf_dir):
    """Four of five shards end closed, the last one is lost."""
    lines = line_stream(spark, sf_dir)
    ends = lines.select("stream_name", "shard_id").distinct().withColumn(
        "reason", F.when(F.col("shard_id") == "shard-4", "ZOMBIE").otherwise("TERMINATE")
    )
    # A shard that ends without a record is checkpointed at the newest one seen, wherever that is.
    empty = spark.createDataFrame([("lineitem", "shard-9", "TERMINATE")], "stream_name string, shard_id string, reason string")
    ends = ends.unionByName(empty)
    closed = final_checkpoints(lines.withColumn("done", F.lit(True)), ends)
    return closed.select("shard_id", "reason", "kind", "base", "user_sub", "user_total")


def stalled_shards_query(spark, sf_dir):
    return stalled_shards(event_stream(spark, sf_dir), 2 * HOUR).select(
        "shard_id", "since_ms", "until_ms", "silent_ms"
    )


def shard_counters_query(spark, sf_dir):
    events = event_stream(spark, sf_dir)
    ignored = F.col("event_type") == "view"
    return shard_counters(events, count_checkpoints(events.filter(~ignored)), ignored).select(
        "shard_id", "n_records", "n_checkpoints"
    )


class ByteMarks(RecordProcessor):
    """Puts out the record with which a shard's bytes pass each multiple of ``every``."""

    splittable = True

    def __init__(self, every: int):
        self.every = every

    def initialize(self, shard):
        return 0

    @staticmethod
    def _sizes(records):
        import pyarrow.compute as pc

        return pc.binary_length(records.column("data")).to_numpy(zero_copy_only=False).astype(np.int64)

    def process(self, shard, state, records):
        sizes = self._sizes(records)
        total = state + np.cumsum(sizes)
        hit = np.flatnonzero(total // self.every > (total - sizes) // self.every)
        rows = records.take(pa.array(hit))
        columns = [rows.column(c) for c in ("stream_name", "shard_id", "base")]
        out = pa.RecordBatch.from_arrays(
            [*columns, pa.array(total[hit], pa.int64())], names=["stream_name", "shard_id", "base", "n_bytes"]
        )
        return int(total[-1]), out

    def summarize(self, batches):
        return int(sum(self._sizes(b).sum() for b in batches))

    def combine(self, first, second):
        return first + second

    def advance(self, state, summary):
        return state + summary


BYTE_MARKS = T.StructType(
    [
        T.StructField("stream_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
    ]
)


def process_shards_query(spark, sf_dir):
    events = event_stream(spark, sf_dir).select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data")
    marks = process_shards(events, ByteMarks(1000), BYTE_MARKS, summary_columns=["data"])
    return marks.select("shard_id", "base", "n_bytes")


def asked_checkpoints(spark, sf_dir):
    events = event_stream(spark, sf_dir).select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "user_total")
    return processor_checkpoints(events, CountingWorker())


def processor_checkpoints_query(spark, sf_dir):
    return asked_checkpoints(spark, sf_dir).select("shard_id", "base")


def checkpoint_log_query(spark, sf_dir):
    """Two appends to one log, and the log."""
    path = f"{ensure_checkpoint_dir(spark)}/checkpoints-{uuid.uuid4().hex}"
    asked = asked_checkpoints(spark, sf_dir)
    for early in (True, False):
        log_checkpoints(asked.filter((F.col("base").cast("bigint") < 300) == early), path)
    return read_checkpoint_log(spark, path).select("shard_id", "base", "line")


def stream_process_shards_query(spark, sf_dir):
    """Marks of a processor whose state goes through four micro-batches or more."""
    folder = work_folder(spark)
    land(spark, staged_events(spark, sf_dir, f"{folder}/stage"), f"{folder}/in")
    events = landed(spark, f"{folder}/in").select("stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "data")
    marks = process_shards_stream(events, ByteMarks(1000), BYTE_MARKS)
    writer = marks.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress")
    writer.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("shard_id", "base", "n_bytes")


def flush_tokens_query(spark, sf_dir):
    batched = flush_by_interval(event_stream(spark, sf_dir), 6 * HOUR)
    tokens = flush_tokens(batched)
    return tokens.select("shard_id", "base", "batch_no", F.col("done").cast("bigint").alias("done"), "done_round")


class LateFlusher(Flusher):
    """Completes what it holds at each flush, but some kinds of records only at the next occasion."""

    def __init__(self, late: str):
        self.late = late

    def initialize(self, shard):
        return [], []

    def add(self, shard, state, records):
        held, overdue = state
        rows = zip(records.column("counter").to_pylist(), records.column("event_type").to_pylist(), strict=True)
        return [*held, *rows], overdue

    def flush(self, shard, state, full):
        held, overdue = state
        kept = [] if full else [n for n, kind in held if kind == self.late]
        done = [n for n, kind in held if full or kind != self.late]
        # Later records first: order does not matter.
        return ([], kept), [*reversed(done), *overdue]

    def heartbeat(self, shard, state):
        held, overdue = state
        return (held, []), overdue


def flush_partial_tokens_query(spark, sf_dir):
    """Purchases are completed one flush after the rest of their batch."""
    events = arrival_counter(event_stream(spark, sf_dir).select(
        "stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "arrival_ms", "event_type"
    ))
    batched = flush_by_interval(events, 6 * HOUR, capacity=12)
    tokens = run_flusher(batched, LateFlusher("purchase"), columns=["event_type"])
    return partial_tokens(batched, tokens).select(
        "shard_id", "base", "batch_no", F.col("done").cast("bigint").alias("done"), "done_round"
    )


#: Events of a shard that one worker session sees, by their ids.
SESSION_EVENTS = 400


def session_lines(spark, sf_dir, folder):
    """Request lines of events, several sessions a shard, in files that cut sessions anywhere."""
    events = event_stream(spark, sf_dir).withColumn("block", F.floor(F.col("event_id") / SESSION_EVENTS))
    lines = to_request_lines_with(events, "block", "event_id").withColumn("at", F.lit(1))
    sessions = events.groupBy("stream_name", "shard_id", "block").agg(F.min("base").alias("first"))
    opening = F.to_json(F.struct(F.lit("initialize").alias("action"), F.col("shard_id").alias("shardId"), F.col("first").alias("sequenceNumber")))
    closing = F.when(F.col("block") % 2 == 0, F.lit('{"action":"shutdown","reason":"ZOMBIE"}')).otherwise(F.lit('{"action":"shutdownRequested"}'))
    marks = [
        sessions.select("stream_name", "shard_id", value.alias("value"), "block", F.lit(edge).cast("bigint").alias("event_id"), F.lit(at).alias("at"))
        for value, edge, at in ((opening, -1, 0), (closing, 1 << 62, 2))
    ]
    files = max(4, lines.count() // 1_000_000)
    every = lines.unionByName(marks[0]).unionByName(marks[1])
    (
        every.repartitionByRange(files, "block", "at", "event_id")
        .sortWithinPartitions("shard_id", "block", "at", "event_id")
        .select("shard_id", "value")
        .write.partitionBy("shard_id")
        .text(folder)
    )


def to_request_lines_with(records, *columns):
    """A request line per record, with columns of the record beside it."""
    named = [F.col(c).alias(f"_{c}") for c in columns]
    body = to_request_lines(records.select("*", *named).withColumn("shard_id", F.struct("shard_id", *named)))
    return body.select("stream_name", "shard_id.shard_id", "value", *[F.col(f"shard_id._{c}").alias(c) for c in columns])


def session_counters_query(spark, sf_dir):
    """Arrival counters and checkpoints by count that start anew with every worker session."""
    folder = f"{work_folder(spark)}/requests"
    session_lines(spark, sf_dir, folder)
    lines = worker_sessions(read_lines(spark, folder, "events", places=True))
    records = stream_records(parse_envelopes(lines.drop(*LINE_PLACE)))
    # Sessions are bounded: at most SESSION_EVENTS ids share one. Asking for the largest would parse every line once more.
    counted = arrival_counter(records, keys=SESSION_KEYS, fits=True)
    due = (F.col("counter") + 1) % 11 == 0
    return counted.select(
        "shard_id", "session", "base", "counter", F.when(due, F.floor(F.col("counter") / 11)).cast("bigint").alias("checkpoint_no")
    )


def flush_log_query(spark, sf_dir):
    return flush_log(interval_batches(spark, sf_dir)).select("shard_id", "batch_no", "fired", "flushed_ms")


# --- end to end ---------------------------------------------------------------------------


def aggregated_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of an aggregated stream to the last whole record handled per shard."""
    records = unpacked_orders(spark, sf_dir)
    quantity = F.substring_index(F.decode("data", "UTF-8"), "|", 1).cast("bigint")
    reached = frontier(records.withColumn("done", quantity < 50), computed=True)
    return reached.select("shard_id", "base", "user_sub", "user_total")


def all_queries() -> dict[str, Query]:
    return {
        "parse_envelopes": parse_envelopes_query,
        "route_bad_lines": route_bad_lines_query,
        "delivery_heartbeats": delivery_heartbeats_query,
        "read_dir": read_dir_query,
        "dump_latest_per_key": dump_latest_query,
        "union_streams": union_streams_query,
        "initial_position": initial_position_query,
        "resume_from_checkpoint": resume_query,
        "resume_from_markers": resume_markers_query,
        "fetch_batches": fetch_batches_query,
        "encode_checkpoints": encode_checkpoints_query,
        "b64_decode": b64_decode_query,
        "decode_seqno": decode_seqno_query,
        "stream_records": stream_records_query,
        "classify_format": classify_format_query,
        "verify_checksum": verify_checksum_query,
        "is_sub_record": is_sub_record_query,
        "varint_size": varint_size_query,
        "record_size": record_size_query,
        "ignored_records": ignored_records_query,
        "noise_filter": noise_filter_query,
        "deaggregate": deaggregate_query(False),
        "deaggregate_deflated": deaggregate_query(True),
        "pack_roundtrip": pack_roundtrip_query(False),
        "pack_deflated": pack_roundtrip_query(True),
        "pack_summary": pack_summary_query,
        "pack_hot": pack_hot_query,
        "key_dictionary": key_dictionary_query,
        "pack_header": pack_header_query,
        "oversize_records": oversize_query,
        "arrival_counter": arrival_counter_query,
        "arrival_counter_hot": arrival_counter_hot_query,
        "flush_by_interval_hot": flush_by_interval_hot_query,
        "frontier_history_hot": frontier_history_hot_query,
        "process_shards_hot": process_shards_hot_query,
        "flush_batches": flush_batches_query,
        "count_checkpoints": count_checkpoints_query,
        "latest_checkpoint": latest_checkpoint_query,
        "flush_by_count": flush_by_count_query,
        "flush_by_interval": flush_by_interval_query,
        "heartbeat_flush": heartbeat_flush_query,
        "frontier": frontier_query,
        "frontier_whole_records": frontier_lines_query(False),
        "frontier_subsequence": frontier_lines_query(True),
        "frontier_history": frontier_history_query,
        "checkpoint_schedule": checkpoint_schedule_query,
        "final_checkpoints": final_checkpoints_query,
        "stalled_shards": stalled_shards_query,
        "shard_counters": shard_counters_query,
        "process_shards": process_shards_query,
        "processor_checkpoints": processor_checkpoints_query,
        "checkpoint_log": checkpoint_log_query,
        "stream_process_shards": stream_process_shards_query,
        "stream_flush": stream_flush,
        "stream_end_to_end": stream_end_to_end,
        "flush_tokens": flush_tokens_query,
        "flush_log": flush_log_query,
        "aggregated_frontier": aggregated_frontier,
        "stream_deaggregate": stream_deaggregate,
        "stream_frontier": stream_frontier,
        "session_counters": session_counters_query,
        "flush_partial_tokens": flush_partial_tokens_query,
        "flush_by_bytes": flush_by_bytes_query,
        "flush_by_bytes_hot": flush_by_bytes_hot_query,
        "stream_flush_hot": stream_flush_hot,
        "stream_processor_checkpoints": stream_processor_checkpoints,
        "stream_final_checkpoints": stream_final_checkpoints,
        "stream_checkpoint_schedule": stream_checkpoint_schedule,
        "stream_shard_counters": stream_shard_counters,
    }
