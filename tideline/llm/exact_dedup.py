"""Exact deduplication by Grace hashing, comparing complete contents.

1. Every input partition folds its rows in an open-addressing table, so a text
   leaves it once per ``table_bytes`` of other texts, however often it occurs.
2. A shuffle deals what is left by hash into buckets, as many as the measured
   bytes need; its files are the spill files. A task folds its bucket in a
   table of the same kind.
3. Texts that no longer fit a full table are handed on. Each bucket that has
   overflowed is split by further hash bits, ``FAN_OUT`` ways, and its parts
   are folded one after the other, until none overflows: k levels take
   ``FAN_OUT``^k tables a bucket, so levels grow with the logarithm of the
   bytes. All copies of a text share its bucket and its fate, so a class is
   complete at the level that holds it.

Texts are equal when their UTF-8 bytes are; NULL counts as empty, so NULL and
empty texts form one class. Of a class the row with the largest doc_id stays
(NULL ids only if there is no other); of several rows with that id, one. An
empty table gives an empty result. Other columns pass through ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import own_names, stored

#: Bytes of text that a table holds, and about the bytes of one output batch.
TABLE_BYTES = 64 << 20
BATCH_BYTES = 16 << 20
#: Most buckets of the first level, and hash bits by which each level splits an overflowing bucket.
MAX_BUCKETS = 20_000
FAN_BITS = 6
FAN_OUT = 1 << FAN_BITS

PARTIAL = "h bigint, text string, max_id bigint, ties bigint, n bigint"
LEVEL = f"sha string, overflow boolean, {PARTIAL}"


class ContentTable:
    """Open addressing with linear probing: a slot holds the number of an entry, entries are compared byte by byte."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.ids: list[int | None] = []
        self.ties: list[int] = []
        self.counts: list[int] = []
        self.bytes = 0

    def find(self, h: int, text: bytes) -> tuple[int, int]:
        """The entry of a text, or -1, and the slot where the search ended."""
        mask = len(self.slots) - 1
        i = h & mask
        while (e := self.slots[i]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return e, i
            i = (i + 1) & mask
        return -1, i

    def add(self, slot: int, h: int, text: bytes, max_id: int | None, ties: int, n: int) -> None:
        self.slots[slot] = len(self.hashes)
        self.hashes.append(h)
        self.texts.append(text)
        self.ids.append(max_id)
        self.ties.append(ties)
        self.counts.append(n)
        self.bytes += len(text) + 200
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()

    def merge(self, e: int, max_id: int | None, ties: int, n: int) -> None:
        own = self.ids[e]
        if own == max_id:
            self.ties[e] += ties
        elif own is None or (max_id is not None and max_id > own):
            self.ids[e], self.ties[e] = max_id, ties
        self.counts[e] += n

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            i = h & mask
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = e

    def batches(self, resolved: bool) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for row in zip(self.hashes, self.texts, self.ids, self.ties, self.counts, strict=True):
            rows.append(row)
            size += 200 if resolved else 200 + len(row[1])
            if size >= BATCH_BYTES:
                yield _batch(rows, resolved)
                rows, size = [], 0
        if rows:
            yield _batch(rows, resolved)


def _batch(rows: list[tuple], resolved: bool) -> pa.RecordBatch:
    """Classes that are complete, without their text, or partial ones with it."""
    h, text, ids, ties, n = zip(*rows, strict=True)
    columns = {
        "sha": pa.array([hashlib.sha256(t).hexdigest() for t in text] if resolved else [None] * len(rows), pa.string()),
        "overflow": pa.array([not resolved] * len(rows)),
        "h": pa.array(h, pa.int64()),
        "text": pa.array([None] * len(rows) if resolved else text, pa.binary()).cast(pa.string()),
        "max_id": pa.array(ids, pa.int64()),
        "ties": pa.array(ties, pa.int64()),
        "n": pa.array(n, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    rest = (batch.column(c).to_pylist() for c in ("max_id", "ties", "n"))
    return zip(batch.column("h").to_pylist(), texts, *rest, strict=True)


def fold_partition(table_bytes: int):
    """Map side: rows of equal text become one; a full table is emptied downstream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for h, text, max_id, ties, n in _rows(batch):
                e, slot = table.find(h, text)
                if e >= 0:
                    table.merge(e, max_id, ties, n)
                    continue
                if table.bytes >= table_bytes:
                    yield from table.batches(resolved=False)
                    table = ContentTable()
                    _, slot = table.find(h, text)
                table.add(slot, h, text, max_id, ties, n)
        yield from table.batches(resolved=False)

    return run


def fold_bucket(table_bytes: int):
    """Buckets, one after the other: classes that fit the table are complete; other texts overflow to the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bucket = ContentTable(), None
        over: list[tuple] = []
        size = 0
        for batch in batches:
            for b, row in zip(batch.column("bucket").to_pylist(), _rows(batch), strict=True):
                if b != bucket:
                    yield from table.batches(resolved=True)
                    table, bucket = ContentTable(), b
                e, slot = table.find(row[0], row[1])
                if e >= 0:
                    table.merge(e, *row[2:])
                elif table.bytes < table_bytes:
                    table.add(slot, *row)
                else:
                    over.append(row)
                    size += len(row[1]) + 200
                    if size >= BATCH_BYTES:
                        yield _batch(over, resolved=False)
                        over, size = [], 0
        if over:
            yield _batch(over, resolved=False)
        yield from table.batches(resolved=True)

    return run


def _deal(pending: DataFrame, buckets: int, level: int, tasks: int) -> DataFrame:
    """Rows by bucket; a task has the rows of a bucket together. On the first level a task's rows are one bucket."""
    first = F.pmod(F.xxhash64("h"), F.lit(buckets))
    if level == 0:
        return pending.withColumn("bucket", F.lit(0).cast("bigint")).repartition(buckets, first)
    # The further bits are those of another hash; of 64 some are left at any level.
    further = F.shiftrightunsigned(F.xxhash64("h", F.lit(1)), max(0, 64 - FAN_BITS * level))
    return (
        pending.withColumn("bucket", F.xxhash64(first, further))
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
    )


def content_classes(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    table_bytes: int = TABLE_BYTES,
    buckets: int | None = None,
    watch: Callable[[int, int], None] | None = None,
) -> DataFrame:
    """One row per distinct text: ``sha``, ``keep_id``, ``ties`` (rows with that id), ``group_size``.

    ``buckets``: of the first level, by default as many as the bytes need.
    ``watch(level, bytes)`` is told what a level hands on.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    one = F.lit(1).cast("bigint")
    rows = df.select(
        F.xxhash64(content).alias("h"),
        content.alias("text"),
        F.col(f"`{key}`").cast("bigint").alias("max_id"),
        one.alias("ties"),
        one.alias("n"),
    )
    held = (F.octet_length("text") + 200).cast("bigint")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def needed(frame: DataFrame) -> tuple[int, int]:
        """Bytes in tables, and the tables that hold them, half as many again for unevenness, of several rows each."""
        size, count = frame.agg(F.sum(held), F.count(F.lit(1))).first()
        return size or 0, max(least, min(-(-3 * (size or 0) // (2 * table_bytes)), count // 16))

    n = buckets or min(MAX_BUCKETS, needed(rows)[1])
    pending = rows.mapInArrow(fold_partition(table_bytes), LEVEL)
    done, level, tasks = None, 0, n
    while True:
        dealt = _deal(pending, n, level, tasks)
        folded = stored(dealt.mapInArrow(fold_bucket(table_bytes), LEVEL), f"dedup-level{level}")
        complete = folded.filter(~F.col("overflow"))
        done = complete if done is None else done.unionByName(complete)
        pending = folded.filter("overflow")
        left, tasks = needed(pending)
        if watch is not None:
            watch(level, left)
        if not left:
            break
        tasks = min(MAX_BUCKETS, tasks)
        level += 1
    return done.select("sha", F.col("max_id").alias("keep_id"), "ties", F.col("n").alias("group_size"))


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)


def dedup_report(df: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``df``: the class it belongs to and whether it stays.

    Rows find their class by digest. The join is on a key that may be hot, and
    narrow; adaptive execution splits it. Repeated rows of the id that stays
    come from their class, one of them kept.
    """
    classes = content_classes(df, table_bytes=table_bytes)
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest("text").alias("sha"))
    again = (F.col("ties") > 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = [
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        "kept",
        F.col("sha").alias("text_sha256"),
    ]
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    single = rows.join(classes, "sha").filter(~again).withColumn("kept", first)
    copies = (
        classes.filter("ties > 1")
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("ties"))))
        .withColumns({"doc_id": F.col("keep_id"), "kept": F.col("_i") == 1})
    )
    return single.select(*columns).unionByName(copies.select(*columns))


def dedup(df: DataFrame, text: str = "text", key: str = "doc_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``df`` with one row of each class of equal texts."""
    classes = content_classes(df, text, key, table_bytes).select(
        F.col("sha").alias("_class"), F.col("keep_id").alias("_keep"), F.col("ties").alias("_ties")
    )
    own, names = own_names(df)
    marked = own.withColumn("_sha", _digest(names[text]))
    same = (F.col("_sha") == F.col("_class")) & F.col(names[key]).cast("bigint").eqNullSafe(F.col("_keep"))
    kept = marked.join(classes, same)
    # Repeated rows of one id and text: the first of them, found by a partial aggregate per task.
    repeated = kept.filter("_ties > 1").dropDuplicates(["_class"])
    return kept.filter("_ties = 1").unionByName(repeated).select(*names.values()).toDF(*df.columns)
