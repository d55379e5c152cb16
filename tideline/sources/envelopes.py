"""Envelope source: newline-delimited JSON requests to record rows.

Everything here is a projection, so it works on batch and streaming input, keeps
the input's partitioning and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.payload import Decoder, decode_data
from tideline.functions.sequence import base_key, decode_base, request_position
from tideline.schema import REQUEST, SHARD, STREAM

CORRUPT = "_corrupt_record"

#: Requests that a consumer gets. Fixed values.
ACTIONS = ("initialize", "processRecords", "shutdown", "shutdownRequested", "checkpoint")


#: Where a line stands: its file, the part of the file that a task read, and its place in that part.
LINE_PLACE = ("file", "block", "row")


def read_lines(
    spark: SparkSession, path: str, stream_name: str, *, streaming: bool = False, places: bool = False, **options
) -> DataFrame:
    """Request lines below ``path``, one row per line, tagged with the stream's name.

    Lay files out as ``<path>/shard_id=<id>/...``: the directory name becomes the
    ``shard_id`` column, and a filter on it prunes directories. ``options`` go to
    the text reader (``maxFilesPerTrigger`` bounds a streaming fetch). With
    ``places``, batch only, each line gets its place among the shard's lines,
    ``(file, block, row)``: files follow each other by their paths.
    """
    if places and streaming:
        raise ValueError("lines of a stream have no places; their order is that of the micro-batches")
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(SHARD, T.StringType())])
    lines = reader.schema(schema).options(**{k: str(v) for k, v in options.items()}).format("text").load(path)
    if not places:
        return lines.select(F.lit(stream_name).alias(STREAM), SHARD, "value")
    # A task reads a part of a file from its start on, so its row ids rise with the lines.
    place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    named = [c.alias(name) for c, name in zip(place, LINE_PLACE, strict=True)]
    return lines.select(F.lit(stream_name).alias(STREAM), SHARD, *named, "value")


def _requests(value: Column, mode: str = "FAILFAST") -> Column:
    """All JSON values of a line; a request line holds one."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(REQUEST), {"mode": mode})


def _fault(request: Column) -> Column:
    """What is wrong with a parsed request, or NULL."""
    action = F.coalesce(request["action"], F.lit(""))
    records = request["records"]
    delivery = action == "processRecords"
    return (
        F.when(~action.isin(*ACTIONS), F.concat(F.lit("unknown action: "), action))
        .when(delivery & records.isNull(), "delivery without records")
        .when(
            delivery & F.exists(records, lambda r: r.isNull() | r["data"].isNull()),
            "record without data",
        )
    )


def _checked(lines: DataFrame, value: str) -> DataFrame:
    """``lines`` with ``request``, NULL for blank lines; a line that is not one whole request fails."""
    blank = F.col(value).isin("", "\r")
    # A projection each, so that no line is parsed twice.
    parsed = lines.withColumn("_all", F.when(~blank, _requests(F.col(value))))
    several = F.raise_error(F.lit("Malformed request line: more than one value")).cast(REQUEST)
    one = F.when(F.size("_all") == 1, F.col("_all")[0]).when(~blank, several)
    single = parsed.withColumn("_one", one).drop("_all")
    fault = _fault(F.col("_one"))
    wrong = F.raise_error(F.concat(F.lit("Malformed request: "), fault)).cast(REQUEST)
    sound = F.when(~blank, F.when(fault.isNotNull(), wrong).otherwise(F.col("_one")))
    return single.withColumn("request", sound).drop("_one")


def parse_requests(lines: DataFrame, *, value: str = "value", on_error: str = "fail") -> DataFrame:
    """Add a ``request`` struct parsed from each line; blank lines are dropped.

    A line must hold one request and nothing else, with a known action; a
    delivery must have records, and each of them data. Any other line fails the
    query. With ``on_error="route"`` it is kept instead, with ``request`` NULL
    and the line in ``_corrupt_record``.
    """
    if on_error not in ("fail", "route"):
        raise ValueError("on_error is 'fail' or 'route'")
    # JSON allows a trailing carriage return, so only blank lines need care.
    lines = lines.filter(~F.col(value).isin("", "\r"))
    if on_error == "fail":
        return _checked(lines, value).drop(value)
    lines = lines.withColumn(value, F.regexp_replace(value, r"\r$", ""))
    schema = T.StructType([*REQUEST.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # A struct tells of wrong types, a list of what stands beside the first value: both are asked.
    lines = lines.withColumns({"_parsed": parsed, "_all": F.size(_requests(F.col(value), "PERMISSIVE"))})
    fields = [F.col(f"_parsed.{f.name}").alias(f.name) for f in REQUEST.fields]
    lines = lines.withColumn("_one", F.struct(*fields))
    bad = F.col(f"_parsed.{CORRUPT}").isNotNull() | F.coalesce(F.col("_all") != 1, F.lit(True)) | _fault(F.col("_one")).isNotNull()
    return (
        lines.withColumn(CORRUPT, F.when(bad, F.col(value)))
        .withColumn("request", F.when(~bad, F.col("_one")))
        .drop(value, "_parsed", "_all", "_one")
    )


def _is_v2(request: str, value: str) -> Column:
    """Whether a request names its delay, be it NULL."""
    named = F.array_contains(F.json_object_keys(F.col(value)), "millisBehindLatest")
    return F.when(F.col(f"{request}.millisBehindLatest").isNotNull(), True).otherwise(F.coalesce(named, F.lit(False)))


def deliveries(lines: DataFrame, *, value: str = "value", clock: str | None = None) -> DataFrame:
    """One row per delivery, empty ones included: its number of records, its delay and whether it names one.

    Every delivery is a sign of life. With ``clock``, a column of ``lines``, it
    is a heartbeat for the flush operators.
    """
    carried = [c for c in lines.columns if c not in (value, clock)]
    requests = _checked(lines, value).filter(F.col("request.action") == "processRecords")
    at = [] if clock is None else [F.col(clock)]
    return requests.select(
        *carried,
        *at,
        F.size("request.records").cast("bigint").alias("n_records"),
        F.col("request.millisBehindLatest").alias("delay_ms"),
        _is_v2("request", value).alias("is_v2"),
    )


def parse_envelopes(lines: DataFrame, *, value: str = "value") -> DataFrame:
    """One row per record of every ``processRecords`` line, in wire form.

    ``data`` is still base64 text. ``delay_ms`` is the request's distance from
    the stream's tip; ``is_v2`` tells whether the request named one at all.
    Malformed lines fail the query, see :func:`parse_requests`.
    """
    carried = [c for c in lines.columns if c != value]
    requests = _checked(lines, value)
    r = F.col("r")
    delivered = F.when(F.col("request.action") == "processRecords", F.col("request.records"))
    # No filter here may refer to ``request``: pushed below the projection, it would parse every line twice.
    return (
        requests.select(
            *carried,
            F.col("request.millisBehindLatest").alias("delay_ms"),
            _is_v2("request", value).alias("is_v2"),
            F.explode_outer(delivered).alias("r"),
        )
        .filter(r.isNotNull())
        .select(
            *carried,
            r["action"].alias("action"),
            r["partitionKey"].alias("partition_key"),
            r["sequenceNumber"].alias("sequence_number"),
            r["subSequenceNumber"].alias("sub"),
            r["approximateArrivalTimestamp"].alias("arrival_ms"),
            "delay_ms",
            "is_v2",
            r["data"].alias("data"),
        )
    )


def stream_records(envelopes: DataFrame, *, decoder: Decoder | None = None) -> DataFrame:
    """Envelopes as records with decoded data and position, not yet deaggregated.

    The arrival time is the record's own and only set on records that name
    themselves ``record``; the delay is its request's.
    """
    base = decode_base("sequence_number")
    own = F.col("action") == "record"
    missing: Column = F.lit(None).cast("bigint")
    fixed = {"action", "partition_key", "sequence_number", "sub", "arrival_ms", "delay_ms", "is_v2", "data"}
    carried = [c for c in envelopes.columns if c not in fixed]
    return (
        envelopes.withColumn("base", base)
        .select(
            *carried,
            "partition_key",
            "base",
            base_key("base").alias("base_key"),
            F.when(F.col("base").isNotNull(), F.col("sub")).alias("sub"),
            missing.alias("user_sub"),
            missing.alias("user_total"),
            F.when(own, F.col("arrival_ms")).alias("arrival_ms"),
            F.when(own, F.col("delay_ms")).alias("delay_ms"),
            decode_data("data", decoder).alias("data"),
        )
    )


def shard_starts(lines: DataFrame, *, value: str = "value") -> DataFrame:
    """Start position of every ``initialize`` line: the resume point or NULL."""
    requests = parse_requests(lines, value=value)
    carried = [c for c in lines.columns if c not in (value, SHARD)]
    return (
        requests.filter(F.col("request.action") == "initialize")
        .withColumn("_p", request_position("request.sequenceNumber", "request.subSequenceNumber"))
        .select(*carried, F.col("request.shardId").alias(SHARD), "_p.*")
    )


def shard_ends(lines: DataFrame, *, value: str = "value") -> DataFrame:
    """Wire reason of every shutdown line; a requested stop counts as ``ZOMBIE``."""
    requests = parse_requests(lines, value=value)
    carried = [c for c in lines.columns if c != value]
    action = F.col("request.action")
    return requests.filter(action.isin("shutdown", "shutdownRequested")).select(
        *carried,
        F.when(action == "shutdownRequested", "ZOMBIE").otherwise(F.col("request.reason")).alias("reason"),
    )


def to_request_lines(records: DataFrame, *, delay_ms: Column | None = None) -> DataFrame:
    """The reverse of :func:`parse_envelopes`: one version 2 request line per record."""
    record = F.struct(
        F.lit("record").alias("action"),
        F.base64("data").alias("data"),
        F.col("partition_key").alias("partitionKey"),
        F.col("base").alias("sequenceNumber"),
        F.col("sub").alias("subSequenceNumber"),
        F.col("arrival_ms").alias("approximateArrivalTimestamp"),
    )
    request = F.struct(
        F.lit("processRecords").alias("action"),
        (F.col("delay_ms") if delay_ms is None else delay_ms).alias("millisBehindLatest"),
        F.array(record).alias("records"),
    )
    return records.select(STREAM, SHARD, F.to_json(request).alias("value"))
