"""Deaggregation: one row per user record."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.payload import is_aggregated
from tideline.operators import codec

#: About the bytes and at most the rows of an output batch. Deflated aggregates grow without any fixed ratio.
OUT_BYTES = 8 << 20
OUT_ROWS = 20_000


class _Pending:
    """User records on their way out, with the input row that each came from."""

    def __init__(self, batch: pa.RecordBatch, columns: list[str]):
        self.batch, self.columns = batch, columns
        self.clear()

    def clear(self) -> None:
        self.rows, self.keys, self.data, self.subs, self.totals = [], [], [], [], []
        self.bytes = 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        new = {
            "partition_key": codec.text_array(self.keys),
            "data": pa.array(self.data, pa.binary()),
            "user_sub": pa.array(self.subs, pa.int64()),
            "user_total": pa.array(self.totals, pa.int64()),
        }
        at = pa.array(self.rows, pa.int64())
        arrays = [new[c] if c in new else self.batch.column(c).take(at) for c in self.columns]
        yield pa.RecordBatch.from_arrays(arrays, names=self.columns)
        self.clear()


def _unpack(columns: list[str], check: bool, out_bytes: int, out_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack_one = codec.unpacker(check)
        for batch in batches:
            flags = batch.column("_aggregated").to_numpy(zero_copy_only=False).astype(bool)
            if not flags.any():
                yield batch.select(columns)
                continue
            # One at a time: a batch of aggregates is large, and need not be held twice.
            blobs = (blob.as_py() for blob in batch.column("data"))
            plain = {
                c: (batch.column(c).cast(pa.binary()) if c == "partition_key" else batch.column(c)).to_pylist()
                for c in ("partition_key", "user_sub", "user_total")
            } if not flags.all() else {}
            out = _Pending(batch, columns)
            for i, blob in enumerate(blobs):
                if flags[i]:
                    keys, data = unpack_one(blob)
                    total, first = len(data), 0
                    while first < total:
                        # A single aggregate may inflate beyond a batch.
                        last, size = first, 0
                        while last < total and size < out_bytes and last - first < out_rows:
                            size += len(data[last])
                            last += 1
                        n = last - first
                        out.rows.extend([i] * n)
                        out.keys.extend(keys[first:last])
                        out.data.extend(data[first:last])
                        out.subs.extend(range(first, last))
                        out.totals.extend([total] * n)
                        out.bytes += size
                        first = last
                        if out.bytes >= out_bytes or len(out.rows) >= out_rows:
                            yield from out.flush()
                    continue
                out.rows.append(i)
                out.keys.append(plain["partition_key"][i])
                out.data.append(blob)
                out.subs.append(plain["user_sub"][i])
                out.totals.append(plain["user_total"][i])
                out.bytes += len(blob or b"")
                if out.bytes >= out_bytes or len(out.rows) >= out_rows:
                    yield from out.flush()
            yield from out.flush()

    return run


def deaggregate(
    records: DataFrame, check: bool = True, out_bytes: int = OUT_BYTES, out_rows: int = OUT_ROWS
) -> DataFrame:
    """Replace every aggregated record by its user records, in order.

    User records take key and data from the aggregate's body, ``base`` and
    ``sub`` from the aggregate, and are numbered ``user_sub`` = 0.. of
    ``user_total``. Other records pass unchanged, an aggregate of no records
    yields none. A damaged aggregate fails the query; ``check`` = False skips
    the checksum.

    No shuffle, works on streams; set a watermark behind it. Spark bounds what
    goes in by bytes, ``out_bytes`` and ``out_rows`` bound what comes out,
    however far the aggregates inflate.
    """
    marked = records.withColumn("_aggregated", F.coalesce(is_aggregated("data"), F.lit(False)))
    types = {"partition_key": T.StringType(), "data": T.BinaryType(), "user_sub": T.LongType(), "user_total": T.LongType()}
    out = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in records.schema.fields])
    return marked.mapInArrow(_unpack(records.columns, check, out_bytes, out_rows), out)
