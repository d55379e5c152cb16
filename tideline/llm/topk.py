"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are range-partitioned by length, longest first, and cut to buckets
of similar length. Queries, in blocks, meet the longest vectors, a bucket or
several small ones; the k-th score there is a lower bound of what a query must reach. In every other bucket that
bound becomes a local cosine threshold, bound / (|q| * longest vector):

* above 1, the bucket is skipped (and, if that holds for a whole block of
  queries, never sent to it);
* high thresholds prune by coordinate: on the query's largest coordinates a
  unit vector must lie in an interval around the query's;
* low ones prune by length: only the vectors that are long enough.

What is left is verified by its product. Components are integers, held in
the smallest type that fits; products below 2^53 are exact in double, larger
ones are computed with Python integers, and a score beyond 64 bits fails.

Ties go to the smaller id, NULL ids last. Vectors that are NULL or hold NULL or
non-finite components take no part; vectors of different length count as
padded with zeros. A query never meets rows with its own id; a repeated query
row is a query of its own, NULL ids are no queries. Fewer than k candidates
give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.shared import stored

BUCKET_ROWS = 4096
QUERY_ROWS = 512
#: Most buckets that serve for the first bounds.
FIRST_BUCKETS = 64
#: Local cosine thresholds from here on prune by coordinate, on so many of the query's coordinates.
COORDINATE_FROM = 0.4
FOCUS = 3
#: Bounds are lowered by this, relative and absolute, so that rounding prunes nothing.
SLACK = 1e-9
EXACT = float(1 << 53)

BLOB = "no bigint, longest double, shortest double, n int, ids array<bigint>, width int, type string, data binary"
HITS = "block bigint, place int, query_id bigint, vec_id bigint, score bigint"


def quantized(vector: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vector)


def _types(m: np.ndarray) -> str:
    """The smallest type that holds every component as it is."""
    most = np.abs(m).max(initial=0.0)
    return next((t for t in ("int8", "int16", "int32") if most <= np.iinfo(t).max), "float64")


def _blob(no: int, ids: list, vectors: list[np.ndarray], norms: np.ndarray) -> pa.RecordBatch:
    width = max(map(len, vectors), default=0)
    m = np.zeros((len(vectors), width))
    for row, v in zip(m, vectors, strict=True):
        row[: len(v)] = v
    order = np.argsort(-norms, kind="stable")
    m, norms = m[order], norms[order]
    kind = _types(m)
    columns = {
        "no": pa.array([no], pa.int64()),
        "longest": pa.array([float(norms[0])]),
        "shortest": pa.array([float(norms[-1])]),
        "n": pa.array([len(m)], pa.int32()),
        "ids": pa.array([[ids[i] for i in order.tolist()]], pa.list_(pa.int64())),
        "width": pa.array([width], pa.int32()),
        "type": pa.array([kind]),
        "data": pa.array([m.astype(kind).tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def pack_rows(rows: int, scale: float):
    """Vectors to blobs of ``rows``, in the order they come; each blob is sorted by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 32
        ids: list = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            vectors += [quantized(np.asarray(v, np.float64), scale) for v in batch.column("vector").to_pylist()]
            while len(ids) >= rows:
                yield _blob(no, ids[:rows], vectors[:rows], _norms(vectors[:rows]))
                ids, vectors, no = ids[rows:], vectors[rows:], no + 1
        if ids:
            yield _blob(no, ids, vectors, _norms(vectors))

    return run


def _norms(vectors: list[np.ndarray]) -> np.ndarray:
    return np.array([np.sqrt(np.dot(v, v)) for v in vectors])


def _matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], row["type"]).reshape(row["n"], row["width"]).astype(np.float64)


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inner products of one query with rows, exact, as float64 below 2^53 and as Python integers beyond."""
    if np.abs(q).max(initial=0.0) * np.abs(p).max(initial=0.0) * max(1, len(q)) < EXACT:
        return p @ q
    whole = [int(x) for x in q]
    return np.array([sum(a * int(b) for a, b in zip(whole, r, strict=True)) for r in p.tolist()], dtype=object)


class Bucket:
    def __init__(self, row: dict) -> None:
        self.m = _matrix(row)
        known = [i is not None for i in row["ids"]]
        self.known = np.array(known, bool)
        self.ids = np.array([i if k else 0 for i, k in zip(row["ids"], known, strict=True)], np.int64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.m, self.m))
        self.longest = row["longest"]
        self.order = np.lexsort((self.ids, ~self.known))
        self.unit: dict[int, np.ndarray] = {}

    def coordinate(self, f: int) -> np.ndarray:
        if f not in self.unit:
            self.unit[f] = self.m[:, f] / np.where(self.norms > 0, self.norms, 1.0)
        return self.unit[f]

    def search(self, q: np.ndarray, query_id: int, k: int, worst: tuple | None) -> list[tuple[int | None, int]]:
        """The k best of the bucket's candidates that come before ``worst``, the k-th so far: (-score, no id, id)."""
        bound = -np.inf if worst is None else -float(worst[0])
        width = min(len(q), self.m.shape[1])
        q = np.concatenate([q, np.zeros(max(0, self.m.shape[1] - len(q)))])[: self.m.shape[1]]
        norm = float(np.sqrt(np.dot(q, q)))
        bound = bound - SLACK * (1 + abs(bound))
        reach = norm * self.longest
        cosine = bound / reach if reach > 0 else (-1.0 if bound <= 0 else 2.0)
        if cosine > 1 + SLACK:
            return []
        if cosine >= COORDINATE_FROM and width:
            cosine = min(cosine, 1.0)
            mask = self.norms * norm >= bound
            for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS].tolist():
                # Within an angle of the query, the angle to an axis changes by that angle at most.
                axis, angle = np.arccos(np.clip(q[f] / norm, -1, 1)), np.arccos(cosine)
                low = np.cos(min(np.pi, axis + angle)) - 1e-7
                high = np.cos(max(0.0, axis - angle)) + 1e-7
                unit = self.coordinate(f)
                mask &= (unit >= low) & (unit <= high)
            found = np.flatnonzero(mask)
        elif bound > 0:
            found = np.arange(np.searchsorted(-self.norms, -bound / norm, side="right"))
        else:
            found = np.arange(len(self.norms))
        found = found[~(self.known[found] & (self.ids[found] == query_id))]
        if not len(found):
            return []
        scores = _products(q, self.m[found])
        if len(found) > k:
            last = np.partition(scores, len(scores) - k)[len(scores) - k]
            best = scores >= last
            found, scores = found[best], scores[best]
        rows = [
            (-int(s), not self.known[i], int(self.ids[i])) for s, i in zip(scores.tolist(), found.tolist(), strict=True)
        ]
        rows = sorted(rows)[:k]
        return [(None if r[1] else r[2], -r[0]) for r in rows if worst is None or r < worst]


def compare_blobs(k: int):
    """A block of queries with a bucket: at most k rows per query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, no = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if bucket is None or no != row["bucket"]["no"]:
                    bucket, no = Bucket(row["bucket"]), row["bucket"]["no"]
                queries = _matrix(row["query"])
                out: list[tuple] = []
                bounds = row["bounds"] or [None] * len(queries)
                for place, (q, query_id, bound) in enumerate(zip(queries, row["query"]["ids"], bounds, strict=True)):
                    worst = None if bound is None else (bound["less"], bound["unknown"], bound["id"])
                    hits = bucket.search(q, query_id, k, worst)
                    out += [(row["query"]["no"], place, query_id, vec_id, score) for vec_id, score in hits]
                if out:
                    arrays = [
                        pa.array(c, t)
                        for c, t in zip(
                            zip(*out, strict=True),
                            (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                            strict=True,
                        )
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "place", "query_id", "vec_id", "score"])

    return run


def usable(vector: Column) -> Column:
    """Vectors that take part: not NULL, every component a finite number."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64.0,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` for each of its rows that ``is_query`` holds for."""
    v = F.col(f"`{vector}`")
    rows = df.filter(usable(v)).select(
        F.col(f"`{key}`").cast("bigint").alias("id"), v.cast("array<double>").alias("vector"), is_query.alias("_query")
    )
    length = F.aggregate(
        F.transform("vector", lambda x: F.floor(x * scale).cast("double")), F.lit(0.0), lambda a, x: a + x * x
    )
    # Equal lengths, a hot vector's too, are spread by the hash of the id.
    parts = _partitions(rows.count(), bucket_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    longest_first = rows.withColumn("_far", -length).repartitionByRange(parts, "_far", F.xxhash64("id"))
    buckets = stored(
        longest_first.sortWithinPartitions("_far").select("id", "vector").mapInArrow(pack_rows(bucket_rows, scale), BLOB),
        "topk-buckets",
    )
    asked = rows.filter(F.col("_query") & F.col("id").isNotNull()).repartition(F.xxhash64("id")).select("id", "vector")
    blocks = stored(asked.mapInArrow(pack_rows(query_rows, scale), BLOB), "topk-queries")

    # The longest vectors, as many as make up a bucket; small buckets are taken together.
    first, held = [], 0
    for row in buckets.select("no", "longest", "n").orderBy(F.desc("longest"), "no").limit(FIRST_BUCKETS).collect():
        if held < bucket_rows:
            first.append(row.no)
            held += row.n
    if not first:
        return _ranked(df.sparkSession.createDataFrame([], HITS), k)
    query = F.struct("no", "n", "ids", "width", "type", "data").alias("query")
    bucket = F.struct("no", "longest", "n", "ids", "width", "type", "data").alias("bucket")
    targets = buckets.select("no", bucket)
    none = F.lit(None).cast("array<struct<less:bigint,unknown:boolean,id:bigint>>").alias("bounds")
    beginning = blocks.select(query, F.explode(F.lit(first).cast("array<bigint>")).alias("no")).join(targets, "no")
    initial = stored(beginning.select("query", "bucket", none).mapInArrow(compare_blobs(k), HITS), "topk-first")

    # The k-th hit so far, per query; a query without k hits has no bound.
    hit = F.struct(
        (-F.col("score")).alias("less"),
        F.col("vec_id").isNull().alias("unknown"),
        F.coalesce("vec_id", F.lit(0)).alias("id"),
    )
    best = F.array_sort(F.collect_list(hit))
    kth = initial.groupBy("block", "place").agg(F.get(best, F.lit(k - 1)).alias("bound")).filter("bound is not null")
    by_block = kth.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("place", "bound"))).alias("found"))
    bounded = (
        blocks.select("no", "longest", query)
        .join(by_block.withColumnRenamed("block", "no"), "no", "left")
        .withColumn(
            "bounds",
            F.transform(
                F.sequence(F.lit(0), F.col("query.n") - 1),
                lambda p: F.try_element_at("found", p),
            ),
        )
        .withColumn(
            "least",
            F.array_min(
                F.transform("bounds", lambda b: F.coalesce(-b["less"].cast("double"), F.lit(float("-inf"))))
            ),
        )
    )
    bounded = stored(
        bounded.select(F.col("no").alias("block"), "longest", "least", "query", "bounds"), "topk-bounded"
    )
    # Which block goes to which bucket is settled on a few bytes of each, before any vector moves.
    groups = buckets.count()
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
    reaches = buckets.filter(~F.col("no").isin(first)).select(
        "no", F.col("longest").alias("reach"), F.pmod(F.xxhash64("no"), F.lit(groups)).cast("int").alias("g")
    )
    # No query of the block can reach its bound in a bucket whose vectors are shorter.
    near = (F.col("reach") * F.col("longest")) * (1 + 1e-6) + 1e-6 >= F.col("least")
    pairs = bounded.select("block", "longest", "least", every_group).join(reaches, "g").filter(near).select("block", "no")
    rest = pairs.join(bounded.select("block", "query", "bounds"), "block").join(targets, "no")
    hits = rest.select("query", "bucket", "bounds").mapInArrow(compare_blobs(k), HITS)
    return _ranked(initial.unionByName(hits), k)


def _partitions(rows: int, bucket_rows: int, usual: int) -> int:
    """Partitions of the vectors by length: each fills a bucket at least, and 64 at most."""
    return max(1, min(usual, rows // bucket_rows), math.ceil(rows / (64 * bucket_rows)))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def topk_report(df: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    return top_k(df, F.coalesce(F.col("vec_id") % every == 0, F.lit(False)), k)
