"""Near-duplicate texts: SimHash finds candidates, shared shingles decide.

Texts are alike if the sets of their five-word shingles have a Jaccard
similarity of 0.8 or more. SimHash fingerprints of 128 bits over the distinct
shingles within a radius that such pairs seldom exceed (at 0.8 their expected
distance is 19 bits, four deviations more are allowed; texts of about ten
shingles vary more, see the README) tie texts to families, by the tiled
comparison of ``simhash``. Of a million texts every one has a stranger within
the radius, which would make them one family, so a pair within the radius is
a link only if its proofs leave room for the similarity: the numbers of
shingles, and the parities of how many fall into each of 512 buckets. A shingle
of one set only changes one parity, so no pair with the similarity is refused.

Only texts with a family go on: each family is cut to tiles by its shingles,
and a pair of tiles is compared exactly, by counting shared shingles for all
its pairs at once. Again a spanning forest goes on, and connected components
of it are the classes. Families of one tile are shuffled once.

Of a class the row with the smallest key stays (NULL keys last). Texts of
fewer words than a shingle are one shingle; texts without words are alike.
Repeated rows are one. Other columns pass through. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.shared import checkpointed, measured_join, own_names, running
from tideline.llm.simhash import EDGES, SEED, TILE, Forest, edge_batch, links, majority, shingle_hashes, shingle_spans

WORDS = 5
SIMILARITY = 0.8
RADIUS = 36
#: Buckets of a proof's parities.
PARITIES = 512
#: Shingles in a tile of a family, and what a text counts at least, so that a tile has 500 texts at most.
TILE_SHINGLES = 200_000
LEAST_SHINGLES = 400
#: Shingles counted in one product of matrices.
STRIP = 4096


def proof(hashes: np.ndarray) -> np.ndarray:
    """The number of distinct shingle hashes, and the parity of how many fall into each bucket, packed to 64-bit numbers."""
    odd = np.bincount((hashes % PARITIES).astype(np.int64), minlength=PARITIES) & 1
    bits = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")
    return np.concatenate([np.array([len(hashes)], "<i8"), bits])


def may_be_alike(similarity: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which pairs of proofs, a row each, leave room for the similarity: all whose sets have it, and few others."""

    def could(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # Shingles of one set only: of two sets with the similarity they are this share of both sizes at most.
        most = (1 - similarity) * (a[:, 0] + b[:, 0]) + 1e-3
        least = np.maximum(np.bitwise_count((a[:, 1:] ^ b[:, 1:]).view(np.uint64)).sum(axis=1), np.abs(a[:, 0] - b[:, 0]))
        return (1 + similarity) * least <= most

    return could


def wide_fingerprint(text: Column, words: int) -> Column:
    """128 bits as two signed 64-bit numbers, and behind them the proof."""

    @F.arrow_udf("array<bigint>")
    def simhash(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.cast(pa.binary()).to_pylist():
            found = shingle_hashes(t or b"", words, wide=True)
            bits = np.packbits(majority(found, wide=True), bitorder="little").view("<i8")
            # The first halves tell shingles apart.
            firsts = found[0][::2].astype(np.uint64) if found else np.zeros(0, np.uint64)
            rows.append(np.concatenate([bits, proof(firsts)]))
        return pa.array(rows, pa.list_(pa.int64()))

    return simhash(text)


def shingle_set(text: Column, words: int) -> Column:
    """Hashes of the distinct shingles of a text, in order."""

    @F.arrow_udf("array<bigint>")
    def shingles(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.cast(pa.binary()).to_pylist():
            joined, starts, ends = shingle_spans(t or b"", words)
            spans = zip(starts.tolist(), ends.tolist(), strict=True)
            hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans]
            rows.append(np.unique(np.array(hashes, np.uint64)).view(np.int64))
        return pa.array(rows, pa.list_(pa.int64()))

    return shingles(text)


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets have the similarity: a boolean matrix."""
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles of one set only are in no intersection.
    number = np.cumsum(uses > 1) - 1
    common = uses[column] > 1
    row, column = row[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, last, STRIP):
        i, j = np.searchsorted(column, [first, first + STRIP])
        m = np.zeros((len(sets), STRIP), np.float32)
        m[row[i:j], column[i:j] - first] = 1.0
        shared += m @ m.T
    union = sizes[:, None] + sizes[None, :] - shared
    return shared >= similarity * union - 1e-6


def compare_families(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                members = list(row.column("a")[0])
                if not row.column("same")[0].as_py():
                    members += list(row.column("b")[0])
                nodes = np.array([m["node"].as_py() for m in members], np.int64)
                sets = [m["shingles"].values.to_numpy(zero_copy_only=False) for m in members]
                forest = Forest(len(nodes))
                x, y = np.nonzero(np.triu(alike(sets, similarity), 1))
                forest.add(x, y)
                if forest.edges:
                    yield edge_batch(forest.edges, nodes)

    return run


def text_classes(
    texts: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    tile: int = TILE,
    tile_shingles: int = TILE_SHINGLES,
) -> DataFrame:
    """(node, label) of the texts (node, text) that are like another; nodes must be distinct."""
    prints = texts.select("node", wide_fingerprint(F.col("text"), words).alias("print"))
    prints = checkpointed(
        prints.select("node", F.slice("print", 1, 2).alias("fp"), F.slice("print", 3, 1 + PARITIES // 64).alias("proof"))
    )
    # Equal fingerprints and proofs meet once; their texts are compared like those of neighbours.
    first = prints.groupBy("fp", "proof").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n"))
    first = checkpointed(first)
    fps = first.select(F.col("rep").alias("node"), "fp", "proof")
    family = components(links(fps, radius, tile, may_be_alike(similarity), similarity))
    of_print = first.join(family.withColumnRenamed("node", "rep"), "rep", "left").filter("label is not null or n > 1")
    members = checkpointed(
        prints.join(of_print.select("fp", "proof", F.coalesce("label", "rep").alias("family")), ["fp", "proof"]).select(
            "node", "family", F.col("proof")[0].alias("size")
        )
    )
    # Tiles are numbered on narrow rows; shingles are worked out for texts with a family, and shuffled to their tiles.
    weight = F.greatest("size", F.lit(LEAST_SHINGLES))
    placed = running(members.withColumn("_h", F.xxhash64("node")), "family", "_h", ["node"], weight, 10)
    placed = placed.select("node", "family", F.floor(F.col("start") / tile_shingles).alias("tile"))
    placed = checkpointed(placed)
    last = placed.groupBy("family").agg(F.max("tile").alias("last")).filter("last > 0").select("family")

    def tiles_of(some: DataFrame) -> DataFrame:
        sets = measured_join(texts, some, "node").select(
            "node", "family", "tile", shingle_set(F.col("text"), words).alias("shingles")
        )
        return sets.groupBy("family", "tile").agg(F.collect_list(F.struct("node", "shingles")).alias("members"))

    alone = tiles_of(placed.join(last, "family", "left_anti")).select(
        F.col("members").alias("a"), F.lit(None).alias("b"), F.lit(True).alias("same")
    )
    found = alone.mapInArrow(compare_families(similarity), EDGES)
    wide = placed.join(last, "family")
    if not wide.isEmpty():
        tiles = checkpointed(tiles_of(wide))
        names = tiles.select("family", "tile")
        pairs = names.withColumnRenamed("tile", "a_tile").join(names.withColumnRenamed("tile", "b_tile"), "family")
        pairs = pairs.filter("a_tile <= b_tile")
        left = tiles.withColumnsRenamed({"tile": "a_tile", "members": "a"})
        right = tiles.withColumnsRenamed({"tile": "b_tile", "members": "b"})
        full = pairs.join(left, ["family", "a_tile"]).join(right, ["family", "b_tile"])
        same = F.col("a_tile") == F.col("b_tile")
        edges = full.select("a", F.when(~same, F.col("b")).alias("b"), same.alias("same"))
        found = found.unionByName(edges.mapInArrow(compare_families(similarity), EDGES))
    return components(found)


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``df`` with one row of each class of alike texts."""
    own, names = own_names(df)
    own = own.withColumn("_node", F.xxhash64(names[key], F.coalesce(names[text], F.lit(""))))
    texts = own.select("_node", F.col(names[key]).alias("key"), F.coalesce(names[text], F.lit("")).alias("text"))
    counts = texts.groupBy("_node").agg(F.count(F.lit(1)).alias("n"), F.first("key").alias("key"))
    counts = checkpointed(counts)
    repeated = counts.filter("n > 1").select("_node")
    if repeated.isEmpty():
        once, rest = own, None
    else:
        once = own.join(repeated, "_node", "left_anti")
        rest = own.join(repeated, "_node").dropDuplicates(["_node"]).select(*own.columns)
        own = once.unionByName(rest)
    classes = checkpointed(
        text_classes(own.select(F.col("_node").alias("node"), F.coalesce(names[text], F.lit("")).alias("text")), **options)
    )
    keyed = classes.join(counts.select(F.col("_node").alias("node"), "key"), "node")
    order = F.struct(F.col("key").isNull(), F.col("key"), F.col("node"))
    stays = keyed.groupBy("label").agg(F.min_by("node", order).alias("kept"))
    dropped = keyed.join(stays, "label").filter("node <> kept").select(F.col("node").alias("_node"))
    return measured_join(own, dropped, "_node", "left_anti").select(*names.values()).toDF(*df.columns)
