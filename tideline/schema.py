"""Schemas and column names shared by every operator.

A stream is a DataFrame (batch or streaming) with one row per record. A record
is placed inside its shard by ``(base_key, sub, user_sub)``; see
:func:`tideline.functions.sequence.order_columns`.
"""

from __future__ import annotations

from pyspark.sql import types as T

STREAM = "stream_name"
SHARD = "shard_id"

#: Default grouping key of all per-shard operators.
SHARD_KEYS = (STREAM, SHARD)

#: Columns that place a record inside its shard, most significant first.
ORDER = ("base_key", "sub", "user_sub")

ENVELOPE_RECORD = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("partitionKey", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("subSequenceNumber", T.LongType()),
        T.StructField("approximateArrivalTimestamp", T.LongType()),
    ]
)

#: One request line. Fields an action does not use stay NULL.
REQUEST = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("subSequenceNumber", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("millisBehindLatest", T.LongType()),
        T.StructField("records", T.ArrayType(ENVELOPE_RECORD)),
    ]
)

#: A decoded user record.
RECORD = T.StructType(
    [
        T.StructField("stream_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("base_key", T.StringType()),
        T.StructField("sub", T.LongType()),
        T.StructField("user_sub", T.LongType()),
        T.StructField("user_total", T.LongType()),
        T.StructField("arrival_ms", T.LongType()),
        T.StructField("delay_ms", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)

#: A position in a shard, as kept in checkpoint tables.
POSITION_FIELDS = ("base", "base_key", "sub", "user_sub", "user_total")

# Fixed values of the record format: first four bytes of an aggregated record,
# and the length of its checksum trailer.
MAGIC_PLAIN = bytes.fromhex("00899ac2")
MAGIC_DEFLATED = bytes.fromhex("01899ac2")
DIGEST_BYTES = 16
MAX_RECORD_BYTES = 1 << 20
NEAR_LIMIT_SLACK = 64
