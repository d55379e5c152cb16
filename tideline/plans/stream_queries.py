"""Queries that run as streams over the given tables and read back what they wrote."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import base_key
from tideline.operators.counters import arrival_counter
from tideline.operators.deaggregate import deaggregate
from tideline.operators.processor import RecordProcessor
from tideline.operators.sizing import ensure_checkpoint_dir, row_bytes
from tideline.plans.streams import event_stream, packed_orders, table
from tideline.sources.envelopes import parse_envelopes, read_lines, stream_records, to_request_lines
from tideline.streaming.counters import ShardCounters
from tideline.streaming.flush import flush_sink, flush_stream
from tideline.streaming.folds import StreamFold
from tideline.streaming.frontier import FrontierTracker
from tideline.streaming.processor import checkpoints_of, processor_sink

FILES_PER_TRIGGER = 1_000
HOUR = 3_600_000
#: Times that the streams below let new files land; each starts the stream anew, from its checkpoint.
LANDINGS = 6
#: About the bytes of events that land in one file, and the fewest files. A file is a micro-batch, which costs a task
#: for each partition of the state, however little it brings; a shard's share of it is in one worker's memory.
FILE_BYTES = 128 << 20
LEAST_FILES = 4


def work_folder(spark: SparkSession) -> str:
    """A fresh folder on the storage all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def stream_deaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request files of an aggregated stream, as they land, to user records."""
    folder = work_folder(spark)
    lines = to_request_lines(packed_orders(spark, sf_dir).drop("n_records"))
    lines.drop("stream_name").write.partitionBy("shard_id").text(f"{folder}/requests")
    landed = read_lines(
        spark, f"{folder}/requests", "lineitem", streaming=True, maxFilesPerTrigger=FILES_PER_TRIGGER
    )
    records = deaggregate(stream_records(parse_envelopes(landed)))
    query = (
        records.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/records")
    )
    query.awaitTermination()
    out = spark.read.schema(records.schema).parquet(f"{folder}/records")
    return out.select(
        "shard_id", "base", "sub", "user_sub", "user_total", "partition_key", F.decode("data", "UTF-8").alias("data")
    )


def staged_events(spark: SparkSession, sf_dir: str, folder: str, file_bytes: int | None = None) -> list[list[str]]:
    """Events as Parquet in the order of their ids: paths to land together, of about ``file_bytes`` of events.

    Events are sorted into ranges by as many tasks as there are files to land,
    ``LEAST_FILES`` at least; both grow with the events.
    """
    events = event_stream(spark, sf_dir)
    total = events.agg(F.sum(row_bytes(events))).first()[0] or 0
    files = max(LEAST_FILES, -(-total // (file_bytes or FILE_BYTES)))
    events.repartitionByRange(files, "event_id").write.parquet(folder)
    # Spark numbers the files as their ranges; a session may cut more ranges than asked for.
    paths = sorted(map(unquote, spark.read.parquet(folder).inputFiles()), key=_part)
    n = len(paths)
    groups = [paths[n * i // files : n * (i + 1) // files] for i in range(files)]
    return [g for g in groups if g]


def _part(path: str) -> tuple[int, str]:
    name = path.rsplit("/", 1)[-1]
    return int(name.split("-")[1]), name


def land(spark: SparkSession, groups: list[list[str]], folder: str) -> None:
    """Let staged events land, a file after the other, so that the files' times follow their order."""
    for paths in groups:
        # A bounded number of bytes, so that one task may write them as one file.
        spark.read.parquet(*paths).coalesce(1).write.mode("append").parquet(folder)


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The files as a stream, one per micro-batch, so that a micro-batch is as bounded as a file."""
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(writer, folder: str, **start) -> None:
    query = writer.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start(**start)
    query.awaitTermination()


def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and batches of events that land in four micro-batches or more."""
    folder = work_folder(spark)
    land(spark, staged_events(spark, sf_dir, f"{folder}/stage"), f"{folder}/in")
    flushed = flush_stream(landed(spark, f"{folder}/in"), None, capacity=64)
    _run(flushed.writeStream.format("parquet"), folder, path=f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").select("shard_id", "base", "counter", "batch_no")


def stream_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that land, are counted, batched and handed to the tracker; stopped half way and started again."""
    folder = work_folder(spark)
    tracker = FrontierTracker(f"{folder}/frontier")

    def handled(rows: DataFrame, batch_id: int) -> None:
        tracker(rows.filter(F.col("counter").isNotNull()).drop("kind", "batch_no", "fired", "clock_ms"), batch_id)

    files = staged_events(spark, sf_dir, f"{folder}/stage")
    half = (len(files) + 1) // 2
    for some in filter(None, (files[:half], files[half:])):
        land(spark, some, f"{folder}/in")
        records = landed(spark, f"{folder}/in").withColumn("skipped", F.col("event_type") == "view")
        flushed = flush_stream(records, None, capacity=64, ignored="skipped")
        _run(flushed.writeStream.foreachBatch(handled), folder)
    return tracker.current(spark).select("shard_id", "base")


def stream_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontier of ``events`` as one shard, from completions as they land."""
    folder = work_folder(spark)
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        # A glob matches a table in one file as well as a folder of files.
        .parquet(f"{sf_dir}/events.parque[t]")
    )
    none = F.lit(None).cast("bigint")
    base = F.col("event_id").cast("string")
    # Event ids are dense, so they are the arrival counter of the one shard.
    completions = events.filter(F.col("value") < 450).select(
        F.lit("events").alias("stream_name"),
        F.lit("all").alias("shard_id"),
        base.alias("base"),
        base_key(base).alias("base_key"),
        F.lit(0).cast("bigint").alias("sub"),
        none.alias("user_sub"),
        none.alias("user_total"),
        F.col("event_id").alias("counter"),
    )
    tracker = FrontierTracker(f"{folder}/frontier")
    query = (
        completions.writeStream.foreachBatch(tracker)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tracker.current(spark).select("shard_id", "base")


def in_landings(spark: SparkSession, rows: DataFrame, landing: str, folder: str, sink, landings: int = LANDINGS) -> None:
    """Write ``rows`` landing after landing, in as many files as there are tasks, and let the stream run after each.

    Every landing is one micro-batch, and every micro-batch follows a restart.
    """
    rows = rows.withColumn(landing, F.col(landing).cast("int"))
    # Worked out once, and read back landing by landing.
    rows.write.partitionBy(landing).parquet(f"{folder}/stage")
    staged = spark.read.schema(rows.schema).parquet(f"{folder}/stage").select(*rows.columns)
    for i in range(landings):
        staged.filter(F.col(landing) == i).drop(landing).write.mode("append").parquet(f"{folder}/in")
        schema = rows.drop(landing).schema
        files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1_000_000).parquet(f"{folder}/in")
        _run(files.writeStream.foreachBatch(sink), folder)


def numbered_landings(spark: SparkSession, rows: DataFrame, of: str) -> DataFrame:
    """``rows`` with ``landing``: equal ranges of the whole number ``of``, from 0."""
    top = rows.agg(F.max(of)).first()[0] or 0
    return rows.withColumn("landing", F.expr(f"CAST({of} AS BIGINT) * {LANDINGS} div {top + 1}"))


def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_stream(spark, sf_dir).select(
        "stream_name", "shard_id", "base", "base_key", "sub", "user_sub", "user_total", "arrival_ms", "event_id", "event_type", "data"
    )
    return numbered_landings(spark, events, "event_id")


class CountingWorker(RecordProcessor):
    """Asks for a checkpoint at every ``every``-th record."""

    splittable = True

    def __init__(self, every: int = 11):
        self.every = every

    def initialize(self, shard):
        return 0

    def process(self, shard, state, records):
        return state + records.num_rows, None

    def checkpoints(self, shard, state, records):
        return (np.arange(state, state + records.num_rows) + 1) % self.every == 0

    def summarize(self, batches):
        return sum(b.num_rows for b in batches)

    def combine(self, first, second):
        return first + second

    def advance(self, state, summary):
        return state + summary


#: Sizes that cut a single shard of the smallest tables into several chunks; production sizes are the defaults.
HOT = {"fits": False, "chunk_rows": 300}
NO_ROWS = T.StructType([T.StructField(c, T.StringType()) for c in ("stream_name", "shard_id")])


def worker_sink(spark: SparkSession, events: DataFrame, folder: str, **more) -> StreamFold:
    return processor_sink(f"{folder}/work", events, CountingWorker(), NO_ROWS, columns=["base"], **more)


def stream_processor_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints that a processor asks for while records land, one restart after another."""
    folder = work_folder(spark)
    events = landing_events(spark, sf_dir)
    sink = worker_sink(spark, events, folder)
    in_landings(spark, events, "landing", folder, sink)
    return sink.output(spark).filter("kind = 'checkpoint'").select("shard_id", "at.base")


def with_ends(events: DataFrame) -> DataFrame:
    """Shards 0 to 3 end with landings 1 to 4, one of them lost; what they get later is a new session."""
    ends = events.select("stream_name", "shard_id").distinct().withColumn(
        "landing", F.regexp_extract("shard_id", "(\\d+)$", 1).cast("bigint") + 1
    )
    ends = ends.filter(F.col("landing") <= 4).withColumn(
        "reason", F.when(F.col("shard_id") == "shard-3", "ZOMBIE").otherwise("TERMINATE")
    )
    return events.unionByName(ends, allowMissingColumns=True)


def stream_final_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of shards that end while the stream goes on; counters start again with their next record."""
    folder = work_folder(spark)
    events = with_ends(landing_events(spark, sf_dir))
    sink = worker_sink(spark, events, folder, ends="reason")
    in_landings(spark, events, "landing", folder, sink)
    return sink.output(spark).select("shard_id", "kind", "at.base")


def stream_flush_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of one hot shard that lands in parts, each cut into chunks for many tasks."""
    folder = work_folder(spark)
    events = landing_events(spark, sf_dir).withColumn("shard_id", F.lit("all"))
    sink = flush_sink(
        f"{folder}/flush", events, 6 * HOUR, capacity=12, ignored=F.col("event_type") == "view", **HOT
    )
    in_landings(spark, events, "landing", folder, sink)
    return sink.output(spark).select("shard_id", "base", "counter", "batch_no", "fired")


def stream_shard_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and checkpoints of shards, counted while the stream runs."""
    folder = work_folder(spark)
    events = landing_events(spark, sf_dir)
    ignored = F.col("event_type") == "view"
    counters = ShardCounters(f"{folder}/counters", ignored)
    sink = worker_sink(spark, events, folder)

    def work(batch: DataFrame, batch_id: int) -> None:
        sink(batch.filter(~ignored), batch_id)
        counters(batch, batch_id, checkpoints_of(sink.output_of(spark, batch_id)))

    in_landings(spark, events, "landing", folder, work)
    return counters.totals(spark).select("shard_id", "n_records", "n_checkpoints")


#: The clock of the schedule: so many milliseconds an event.
EVENT_MS = 60_000


def stream_checkpoint_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of a stream's frontier, at most one per interval; shard 0 only gives signs of life in the end.

    A landing is a round. Records complete out of order, one in seven a landing late.
    """
    folder = work_folder(spark)
    events = landing_events(spark, sf_dir)
    late = (F.col("event_id") % 7 == 3) & (F.col("landing") < LANDINGS - 1)
    counted = arrival_counter(events.drop("landing"), name="counter").join(events.select("base", "landing"), "base")
    completed = counted.withColumn("landing", F.col("landing") + F.when(late, 1).otherwise(0)).filter(
        (F.col("shard_id") != "shard-0") | (F.col("landing") < LANDINGS - 2)
    )
    clock = (F.max("event_id") * EVENT_MS).alias("clock_ms")
    signs = events.groupBy("stream_name", "shard_id", "landing").agg(clock)
    rows = completed.unionByName(signs, allowMissingColumns=True)
    tracker = FrontierTracker(f"{folder}/frontier", interval_ms=events.count() * EVENT_MS // 4)
    in_landings(spark, rows, "landing", folder, tracker)
    return tracker.sent(spark).select("shard_id", "checkpoint_no", "round", "clock_ms", "base")
