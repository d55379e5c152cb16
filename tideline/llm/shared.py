"""What several operators need: results kept on the shared folder, and running sums that no single task computes."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.operators.sizing import BROADCAST_BYTES, ensure_checkpoint_dir

#: ASCII white space splits words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"

#: Fewest leading hash bits that cut a group into buckets.
BUCKET_BITS = 10


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder: lineage is cut, and later reads are pruned."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Narrow rows computed once, as a reliable checkpoint, which Spark removes when nothing refers to it any more."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def measured_join(rows: DataFrame, side: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join to a narrow table with a row per key: broadcast if it has been counted and is small, else shuffled."""
    side = checkpointed(side)
    n = side.count()
    width = 8 * len(side.columns)
    return rows.join(F.broadcast(side) if n * width <= BROADCAST_BYTES else side, key, how)


def own_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with names that clash with nothing an operator adds, and the new name of each column."""
    names = {c: f"_own{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def md5_bits(text: Column) -> Column:
    """The leading 64 bits of a text's MD5, whose order as unsigned numbers is that of the hexadecimal digits."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")


def null_last(column: Column) -> Column:
    """A text that is equal for equal values and orders by code point, NULL last."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def bucket_bits(largest: int, per_bucket: int) -> int:
    """Bits that cut a group of ``largest`` units into buckets of about ``per_bucket``."""
    return max(BUCKET_BITS, math.ceil(math.log2(max(1, largest / per_bucket))))


def running(
    df: DataFrame,
    group: str,
    h: str,
    order: list[str],
    value: Column,
    bits: int,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of every group and sum ``value`` before each, in the order of the hash column ``h``.

    Adds ``pos`` (rows before) and ``start`` (sum before). A group of any size
    is spread: leading bits of the hash cut it into buckets, each bucket is
    numbered by itself, and the sums of the buckets before it, one small row
    per bucket, are added. The result does not depend on ``bits``. ``group``
    must not be NULL; ``df`` is evaluated twice.

    ``per_group``, a row for each group, adds its columns: it joins the sums of
    the buckets, so that the rows of a group are never dealt by the group alone.
    """
    df = df.withColumns({"_bucket": F.shiftrightunsigned(h, 64 - bits), "_value": value})
    whole = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    before = (
        df.groupBy(group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_sum"))
        .select(
            group,
            "_bucket",
            F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_sum").over(whole), F.lit(0)).alias("_sum_before"),
        )
    )
    if per_group is not None:
        before = before.join(per_group, group)
    inside = W.partitionBy(group, "_bucket").orderBy(h, *order)
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    return (
        df.join(before, [group, "_bucket"])
        .withColumns(
            {
                "pos": (F.col("_rows_before") + F.row_number().over(inside) - 1).cast("bigint"),
                "start": (F.col("_sum_before") + F.coalesce(F.sum("_value").over(earlier), F.lit(0))).cast("bigint"),
            }
        )
        .drop("_bucket", "_value", "_rows_before", "_sum_before")
    )
