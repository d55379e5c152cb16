"""Size checks that decide between physical forms of an operator."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows and bytes a join side may have to be broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

#: Most rows and bytes of one group that a single task may sort for a window.
GROUP_ROWS = 2_000_000
GROUP_BYTES = 512 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the lengths of its texts and blobs, and eight for any other column."""
    long = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("bigint") for c in long]
    return reduce(add, lengths, F.lit(8 * len(df.columns)).cast("bigint"))


def same_keys(pairs: Mapping[str, str]) -> Column:
    """Equality of key columns; NULL keys match each other."""
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs.items()))


def keyed_join(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be NULL, with the key columns of ``rows``."""
    renamed = {k: f"_side_{k}" for k in keys}
    return rows.join(side.withColumnsRenamed(renamed), same_keys(renamed), how).drop(*renamed.values())


def lookup(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``rows`` to an aggregate with one row per shard, key or chunk; NULL keys match each other.

    See :func:`ordered_lookup`.
    """
    return ordered_lookup(rows, side, keys, how, max_rows)[0]


def ordered_lookup(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, bool]:
    """:func:`lookup`, and whether the order of ``rows`` in their partitions is kept.

    ``side`` is computed once, to a reliable checkpoint, and counted there. (A
    cached table would do too, but Spark matches those by path and would go on
    using it after the files behind it have changed.) Up to ``max_rows`` and
    ``BROADCAST_BYTES`` it is broadcast and order is kept. Beyond, the join shuffles both sides and
    adaptive execution splits hot keys.
    """
    side = materialize(side)
    size = side.agg(F.count(F.lit(1)), F.sum(row_bytes(side))).first()
    small = size[0] <= max_rows and (size[1] or 0) <= BROADCAST_BYTES
    return keyed_join(rows, F.broadcast(side) if small else side, keys, how), small


def materialize(df: DataFrame) -> DataFrame:
    """``df`` computed once, to the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; reads the key columns only."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    return int(row[0] or 0)


def _largest(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows and bytes of the largest groups."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("size"))
    row = groups.agg(F.max("n"), F.max("size")).first()
    return int(row[0] or 0), int(row[1] or 0)


#: A plan's own estimate of its bytes, from files that may be compressed, is taken to be off by this much.
ESTIMATE_FACTOR = 16


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer thinks that ``df`` takes: the bytes of the files below, or far too many where it does not know."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_one_task(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> bool:
    """Whether a task can sort each group; by rows and by the bytes of all columns that go along.

    Where all of ``df`` is small by far, columns besides the keys are not read to find that out.
    """
    if estimated_bytes(df) * ESTIMATE_FACTOR <= GROUP_BYTES:
        return largest_group(df, keys) <= (GROUP_ROWS if max_rows is None else max_rows)
    rows, size = _largest(df, keys)
    return rows <= (GROUP_ROWS if max_rows is None else max_rows) and size <= GROUP_BYTES


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without one gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tideline-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
