"""Streams over the given tables: ``events`` as plain records, ``lineitem`` as
sub-records of its orders, ``documents`` as user records to pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.sequence import base_key
from tideline.operators.pack import pack

#: Orders per packing lane: bounds a lane's rows and grows the number of lanes with the data.
ORDERS_PER_LANE = 1024

LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(c: str) -> Column:
    """Milliseconds since the epoch of a zoneless timestamp, whatever the session's time zone."""
    ts = F.col(c)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    millis = F.floor(F.extract(F.lit("SECOND"), ts) * 1000)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000 + seconds.cast("bigint") * 1000 + millis.cast("bigint")
    )


def shard(c: str, n: int = 5) -> Column:
    return F.concat(F.lit("shard-"), (F.col(c) % n).cast("string"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as plain records of five shards; the table's columns ride along."""
    none = F.lit(None).cast("bigint")
    base = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("stream_name"),
        shard("user_id").alias("shard_id"),
        F.col("user_id").cast("string").alias("partition_key"),
        base.alias("base"),
        base_key(base).alias("base_key"),
        F.lit(0).cast("bigint").alias("sub"),
        none.alias("user_sub"),
        none.alias("user_total"),
        epoch_ms("ts").alias("arrival_ms"),
        F.lit(0).cast("bigint").alias("delay_ms"),
        F.encode("props", "UTF-8").alias("data"),
        "event_id",
        "event_type",
        "value",
    )


def line_data() -> Column:
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    return F.encode(F.concat_ws("|", quantity, "l_returnflag", "l_linestatus"), "UTF-8")


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as user records to pack: one lane per block of orders."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        shard("l_orderkey").alias("shard_id"),
        F.floor(F.col("l_orderkey") / F.lit(ORDERS_PER_LANE)).cast("bigint").alias("lane"),
        F.col("l_partkey").cast("string").alias("partition_key"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey").cast("string")).alias("explicit_hash_key"),
        line_data().alias("data"),
    )


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as sub-records: every order is one aggregate of its lines."""
    base = F.col("l_orderkey").cast("string")
    order = W.partitionBy("l_orderkey").orderBy(*LINE_ORDER[1:])
    whole = W.partitionBy("l_orderkey")
    # Numbered first, on the table's own narrow columns; what is derived from them need not be shuffled.
    numbered = table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        "l_returnflag",
        "l_linestatus",
        (F.row_number().over(order) - 1).cast("bigint").alias("user_sub"),
        F.count(F.lit(1)).over(whole).alias("user_total"),
    )
    return numbered.select(
        F.lit("lineitem").alias("stream_name"),
        shard("l_orderkey").alias("shard_id"),
        F.col("l_partkey").cast("string").alias("partition_key"),
        base.alias("base"),
        base_key(base).alias("base_key"),
        F.lit(0).cast("bigint").alias("sub"),
        "user_sub",
        "user_total",
        line_data().alias("data"),
        "l_quantity",
    )


def packed_orders(spark: SparkSession, sf_dir: str, deflate: bool = False) -> DataFrame:
    """``lineitem`` packed into one aggregated record per order, as stream records."""
    lines = line_records(spark, sf_dir)
    order = [F.col(c) for c in LINE_ORDER]
    packed = pack(lines, ["lane"], order, batch_key="l_orderkey", deflate=deflate, fits=True)
    none = F.lit(None).cast("bigint")
    base = F.col("l_orderkey").cast("string")
    return packed.select(
        F.lit("lineitem").alias("stream_name"),
        shard("l_orderkey").alias("shard_id"),
        "partition_key",
        base.alias("base"),
        base_key(base).alias("base_key"),
        F.lit(0).cast("bigint").alias("sub"),
        none.alias("user_sub"),
        none.alias("user_total"),
        none.alias("arrival_ms"),
        F.lit(0).cast("bigint").alias("delay_ms"),
        "data",
        "n_records",
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as user records; the language is the producer."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.col("source").alias("partition_key"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("explicit_hash_key"),
        F.encode("text", "UTF-8").alias("data"),
    )
