"""Packing: user records into size-bounded aggregated records."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.sizing import record_size
from tideline.operators.codec import OpenAggregate, text_array
from tideline.operators.filling import chains, ends, record_bytes
from tideline.operators.fold import OrderedFold, ordered_fold
from tideline.operators.ordering import dense_counter
from tideline.schema import MAX_RECORD_BYTES, NEAR_LIMIT_SLACK

# Finished aggregates are handed on once they reach this many bytes together.
_OUT_BYTES = 8 << 20


def _bytes(column: pa.Array) -> list[bytes | None]:
    # By way of an object array, which is many times faster than scalar by scalar.
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


class _Pack(OrderedFold):
    """State: (open aggregate, its batch key, number of the next aggregate in the lane).

    A run of rows is summed up by what follows from each row that can be the
    first to begin an aggregate. These lie within one aggregate's size of the
    run's start; from each, aggregates are followed to the last that the run begins.
    That one stays open, so the rows it may hold go along, data included: less than ``max_bytes``.
    """

    splittable = True

    def __init__(self, out: pa.Schema, n_keys: int, batch_key: str | None, max_bytes: int, deflate: bool):
        self.out = out
        self.n_keys = n_keys
        self.batch_key = batch_key
        self.max_bytes = max_bytes
        self.deflate = deflate

    def start(self, key):
        return OpenAggregate(), None, 0

    def _close(self, key, state, rows):
        aggregate, batch, number = state
        if aggregate.count == 0:
            return OpenAggregate(), batch, number
        own = [batch] if self.batch_key is not None else []
        rows.append(
            (
                *key,
                *own,
                number,
                aggregate.partition_key,
                aggregate.finish(self.deflate),
                aggregate.hash_key,
                aggregate.count,
                aggregate.estimate,
            )
        )
        return OpenAggregate(), batch, number + 1

    def _batch(self, rows):
        columns = [
            text_array(c) if f.name in ("partition_key", "explicit_hash_key") else pa.array(c, f.type)
            for c, f in zip(zip(*rows), self.out)
        ]
        return pa.RecordBatch.from_arrays(columns, schema=self.out)

    def step(self, key, state, rows):
        keys = _bytes(rows.column("partition_key"))
        payloads = _bytes(rows.column("data"))
        hashes = _bytes(rows.column("explicit_hash_key"))
        batches = rows.column(self.batch_key).to_pylist() if self.batch_key else [None] * len(keys)
        limit = self.max_bytes - NEAR_LIMIT_SLACK
        out, done, size_out = [], [], 0
        aggregate, current, number = state
        for pk, data, ehk, batch in zip(keys, payloads, hashes, batches):
            if batch != current:
                aggregate, _, number = self._close(key, (aggregate, current, number), done)
                current = batch
            head, size = aggregate.head(pk, len(data), ehk)
            if aggregate.count and aggregate.estimate + size > limit:
                size_out += aggregate.estimate
                aggregate, _, number = self._close(key, (aggregate, current, number), done)
                if size_out >= _OUT_BYTES:
                    out.append(self._batch(done))
                    done, size_out = [], 0
                head, size = aggregate.head(pk, len(data), ehk)
            if size > self.max_bytes:
                raise ValueError(f"a record of {size} bytes does not fit an aggregated record")
            aggregate.add(pk, data, ehk, head, size)
        if done:
            out.append(self._batch(done))
        return (aggregate, current, number), out

    def freeze(self, state):
        aggregate, *others = state
        return [getattr(aggregate, name) for name in OpenAggregate.__slots__], *others

    def thaw(self, frozen):
        values, *others = frozen
        aggregate = OpenAggregate()
        for name, value in zip(OpenAggregate.__slots__, values):
            setattr(aggregate, name, value)
        return aggregate, *others

    def summary(self, slices):
        keys, hashes, lengths, batches = [], [], [], []
        held: deque = deque()
        for rows in slices:
            data = rows.column("data")
            sizes = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False)
            keys += _bytes(rows.column("partition_key"))
            hashes += _bytes(rows.column("explicit_hash_key"))
            lengths += sizes.tolist()
            batches += rows.column(self.batch_key).to_pylist() if self.batch_key else [None] * rows.num_rows
            held.append((data, int(sizes.sum())))
            # An aggregate that is open at the end cannot begin before these.
            while sum(n for _, n in islice(held, 1, None)) >= self.max_bytes:
                held.popleft()
        n = len(keys)
        limit = self.max_bytes - NEAR_LIMIT_SLACK
        least = np.cumsum([record_bytes(1, int(h is not None), s) for h, s in zip(hashes, lengths)])
        # Whatever is open, a row up to here begins an aggregate.
        first = min(int(np.searchsorted(least, limit, "right")), next((i for i in range(n) if batches[i] != batches[0]), n))
        last, hops = chains(ends(keys, hashes, lengths, batches, limit))
        last, hops = last[: first + 1], hops[: first + 1]
        begin = int(last.min()) if first < n else 0
        data = [value for piece, _ in held for value in _bytes(piece)]
        return {
            "head": [column[: first + 1] for column in (keys, hashes, lengths, batches)],
            "last": last,
            "hops": hops,
            "begin": begin,
            "tail": (keys[begin:], hashes[begin:], data[len(data) - (n - begin) :]),
            "batch": batches[-1],
        }

    def advance(self, state, summary):
        aggregate, current, number = state
        limit = self.max_bytes - NEAR_LIMIT_SLACK
        begin = 0
        if aggregate.count:
            probe = aggregate.sizes()
            for begin, (pk, ehk, n, batch) in enumerate(zip(*summary["head"])):
                head, size = probe.head(pk, n, ehk)
                if batch != current or probe.estimate + size > limit:
                    number += 1
                    aggregate = OpenAggregate()
                    break
                probe.add(pk, b"", ehk, head, size)
        start = 0
        if aggregate.count == 0:
            number += int(summary["hops"][begin])
            start = int(summary["last"][begin]) - summary["begin"]
        for pk, ehk, data in islice(zip(*summary["tail"]), start, None):
            aggregate.add(pk, data, ehk, *aggregate.head(pk, len(data), ehk))
        return aggregate, summary["batch"], number

    def finish(self, key, state):
        done: list = []
        self._close(key, state, done)
        return self._batch(done) if done else None


def with_lanes(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rows_per_lane: int = 100_000,
    name: str = "lane",
    **sizing,
) -> DataFrame:
    """Cut each producer's records, in order, into lanes of ``rows_per_lane``.

    Lanes can be packed on their own, by ``pack(..., fits=True)``, without the
    pass over chunks that a large producer takes otherwise. They keep the order and
    cost at most one under-filled aggregate each.
    """
    counted = dense_counter(records, "_n", keys=keys, order=order, **sizing)
    return counted.withColumn(name, F.floor(F.col("_n") / F.lit(rows_per_lane)).cast("bigint")).drop("_n")


def pack(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    batch_key: str | None = None,
    max_bytes: int = MAX_RECORD_BYTES,
    deflate: bool = False,
    clustered: bool = False,
    **sizing,
) -> DataFrame:
    """Fill aggregated records in order, one at a time per producer or lane (``keys``).

    ``records`` has ``partition_key``, binary ``data`` and ``explicit_hash_key``
    (NULL for none). A record that does not fit closes the open aggregate; so
    does a change of ``batch_key``, a column that ``order`` must keep together.
    The limit counts uncompressed bytes. An aggregate carries its first record's
    partition key and its first defined hash key.

    A producer of any size is packed by many tasks, with the same aggregates: see :func:`ordered_fold`, which
    ``sizing`` goes to. ``fits=True`` says that no producer or lane is too large for a task, which saves a check.
    A task holds one open aggregate and, of a producer that is cut, keys and sizes of a chunk. Result: ``keys``,
    ``batch_key``, ``batch_no``, ``partition_key``, ``data``,
    ``explicit_hash_key``, ``n_records``, ``est_bytes``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = list(keys)
    wanted = [*keys, "partition_key", "data", "explicit_hash_key"]
    if batch_key is not None:
        wanted.append(batch_key)
    own = [records.schema[batch_key]] if batch_key is not None else []
    out = T.StructType(
        [
            *[records.schema[k] for k in keys],
            *own,
            T.StructField("batch_no", T.LongType()),
            T.StructField("partition_key", T.StringType()),
            T.StructField("data", T.BinaryType()),
            T.StructField("explicit_hash_key", T.StringType()),
            T.StructField("n_records", T.LongType()),
            T.StructField("est_bytes", T.LongType()),
        ]
    )
    # Sort keys go as far as the sort, under names of their own.
    by = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    source = records.select(*wanted, *by)
    fold = _Pack(to_arrow_schema(out), len(keys), batch_key, max_bytes, deflate)
    return ordered_fold(
        source,
        fold,
        out,
        keys=keys,
        order=[F.col(f"_o{i}") for i in range(len(by))],
        columns=[c for c in wanted if c not in keys],
        summary_columns=[c for c in wanted if c not in keys],
        clustered=clustered,
        **sizing,
    )


def lone_size() -> Column:
    """Bytes a record takes as the first of an aggregate."""
    return record_size(
        F.octet_length("partition_key"),
        F.lit(True),
        F.lit(0),
        F.octet_length("data"),
        F.octet_length("explicit_hash_key"),
        F.lit(True),
        F.lit(0),
    )


def oversize_records(records: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """Records no aggregate can take; :func:`pack` fails on them, so set them aside first."""
    return records.withColumn("lone_bytes", lone_size()).filter(F.col("lone_bytes") > max_bytes)


def key_dictionary(
    records: DataFrame, batch: Sequence[str], pos: Column, key: str = "partition_key"
) -> DataFrame:
    """Distinct keys of each batch with their index, in order of first appearance.

    Rows are first reduced to one per (batch, key). NULL keys have no index.
    """
    batch = list(batch)
    first = records.filter(F.col(key).isNotNull()).groupBy(*batch, key).agg(F.min(pos).alias("_first"))
    index = F.row_number().over(W.partitionBy(*batch).orderBy("_first")) - 1
    return first.select(*batch, key, index.cast("bigint").alias("key_index"))


def pack_header(records: DataFrame, batch: Sequence[str], pos: Column) -> DataFrame:
    """Partition key and explicit hash key an aggregate of each batch would carry."""
    ehk = F.col("explicit_hash_key")
    return records.groupBy(*batch).agg(
        F.min_by("partition_key", pos).alias("partition_key"),
        F.min_by(ehk, F.when(ehk.isNotNull(), pos)).alias("explicit_hash_key"),
        F.count(F.lit(1)).alias("n_records"),
    )
