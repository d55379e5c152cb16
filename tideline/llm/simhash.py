"""SimHash near-duplicates: every pair of fingerprints within a radius, by tiles.

A fingerprint has a bit set if over half the hashes of the text's word
shingles have it. Distinct fingerprints are sorted by their number of set bits,
then by the numbers of set bits in their four quarters, and cut to tiles.
Two fingerprints that differ in r bits differ by at most r in their counts,
summed over the parts; so a pair of tiles whose ranges of counts are further
apart is skipped unread. Other pairs are compared in full: exclusive-or and
bit counts in numpy. A pair of tiles hands on a spanning forest of its links,
never the pairs of a group, and connected components are found from those.

Tiles are numbered by distributed running counts. Neighbouring tiles make a
group, found by joins on their bit counts, and a task gets two groups and
compares their tiles: a tile is sent once for every group, not once for every
tile. The work is quadratic in the number of distinct fingerprints, less what
is skipped; equal texts meet once.

NULL and empty texts, or white space only, have fingerprint zero and link like
any other. Repeated rows share a fingerprint. A component's id is its smallest
doc_id, NULL if it has none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.shared import checkpointed, running

SEED = 42
TILE = 8192
#: Rows of a tile that are compared with the other at once: the distances stay in the processor's cache.
STRIP = 16
#: Groups that tiles are cut to, and most rows of one, which a task holds two of.
GROUPS = 8
GROUP_ROWS = 1 << 18
#: Shingles hashed at once.
CHUNK = 1 << 16
EDGES = "a bigint, b bigint"


def shingle_spans(text: bytes, words: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a lower-cased text joined by blanks, and where its shingles start and end in that."""
    w = text.lower().split()
    if not w:
        none = np.zeros(0, np.int64)
        return b"", none, none
    k = min(words, len(w))
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(w), (ends - lengths)[: len(w) - k + 1], ends[k - 1 :]


def shingle_hashes(text: bytes, words: int, wide: bool = False) -> list[np.ndarray]:
    """Hashes of a text's shingles in parts: XXH64 with repeats, or each distinct XXH3 as two halves, sorted, in one part."""
    joined, starts, ends = shingle_spans(text, words)
    found = []
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist(), strict=True)
        if wide:
            found.append(distinct(np.frombuffer(b"".join(xxhash.xxh3_128_digest(joined[s:e], SEED) for s, e in spans), ">u8")))
        else:
            found.append(np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], dtype="<u8"))
    if wide and len(found) > 1:
        found = [distinct(np.concatenate(found))]
    return found


def majority(found: list[np.ndarray], wide: bool = False) -> np.ndarray:
    """The fingerprint's bits, lowest first, of a text's shingle hashes: 64, or 128.

    Wide ones count each distinct shingle once, so that their distance follows the
    similarity of the sets, however often a line repeats, and break ties by the text's least shingle hash. Cleared bits instead
    would make the fingerprints of short texts sparse, and so close to each other.
    """
    size = 16 if wide else 8
    counts = np.zeros(8 * size, np.int64)
    total = 0
    for part in found:
        hashes = part.view(np.uint8).reshape(-1, size)
        total += len(hashes)
        for i in range(0, len(hashes), CHUNK):
            counts += np.unpackbits(hashes[i : i + CHUNK], axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    over = 2 * counts > total
    if wide and total:
        # Sorted, so the least is the first.
        tie = 2 * counts == total
        over[tie] = np.unpackbits(found[0][:2].view(np.uint8), bitorder="little")[tie].astype(bool)
    return over


def distinct(halves: np.ndarray) -> np.ndarray:
    """Hashes of two 64-bit halves each, sorted, without repeats; equal first halves are the same shingle."""
    pairs = halves.reshape(-1, 2)
    _, at = np.unique(pairs[:, 0], return_index=True)
    return pairs[at].reshape(-1)


def fingerprint(text: bytes, words: int) -> int:
    return int.from_bytes(np.packbits(majority(shingle_hashes(text, words)), bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, words: int) -> Column:
    """The fingerprint of a text as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t or b"", words) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return simhash(text)


class Forest:
    """A spanning forest of links between numbered nodes, built from blocks of links."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        x, y = self.label[x], self.label[y]
        apart = x != y
        if not apart.any():
            return
        pairs = np.unique(x[apart] * self.n + y[apart])
        root: dict[int, int] = {}

        def find(n: int) -> int:
            while (up := root.get(n, n)) != n:
                root[n] = root.get(up, up)
                n = root[n]
            return n

        for p, q in zip((pairs // self.n).tolist(), (pairs % self.n).tolist(), strict=True):
            p, q = find(p), find(q)
            if p != q:
                root[max(p, q)] = min(p, q)
                self.edges.append((p, q))
        moved = np.arange(self.n)
        for n in list(root):
            moved[n] = find(n)
        self.label = moved[self.label]


def tile_links(
    a: np.ndarray,
    b: np.ndarray | None,
    radius: int,
    may: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    reach: tuple[np.ndarray, np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, or within one if ``b`` is None, by position.

    Rows are fingerprints of one or more 64-bit words. Positions in the second tile follow those in the first.
    ``may`` tells of pairs of positions within the radius which of them are links; all are without it. ``reach`` holds
    for each row of ``a`` the first and the end of the rows of the other tile that it is compared with, in rising order.
    """
    # Unsigned, as bits are counted in the absolute value.
    a = np.ascontiguousarray(a.reshape(len(a), -1).T).view(np.uint64)
    other = a if b is None else np.ascontiguousarray(b.reshape(len(b), -1).T).view(np.uint64)
    n, m = a.shape[1], other.shape[1]
    shift = 0 if b is None else n
    forest = Forest(n if b is None else n + m)
    # Written over strip by strip: new arrays would cost more than the counts.
    differ, bits = np.empty(STRIP * m, np.uint64), np.empty(STRIP * m, np.uint8)
    apart, near = np.empty_like(bits), np.empty(STRIP * m, bool)
    for i in range(0, n, STRIP):
        last = min(i + STRIP, n) - 1
        first, end = (0, m) if reach is None else (int(reach[0][i]), int(reach[1][last]))
        if b is None:
            first = max(first, i)
        if first >= end:
            continue
        shape = last + 1 - i, end - first
        size = shape[0] * shape[1]
        d, c, t, within = (x[:size].reshape(shape) for x in (differ, bits, apart, near))
        for word in range(len(a)):
            np.bitwise_xor(a[word, i : i + STRIP, None], other[word, None, first:end], out=d)
            np.bitwise_count(d, out=c if word else t)
            if word:
                t += c
        np.less_equal(t, radius, out=within)
        if within.any():
            x, y = np.nonzero(within)
            x, y = x + i, y + first + shift
            if b is None:
                x, y = x[x < y], y[x < y]
            if may is not None:
                # Pairs that are connected already need no proof.
                new = forest.label[x] != forest.label[y]
                x, y = x[new], y[new]
                good = may(x, y)
                x, y = x[good], y[good]
            forest.add(x, y)
    return forest.edges


def edge_batch(edges: list[tuple[int, int]], nodes: np.ndarray) -> pa.RecordBatch:
    at = np.array(edges)
    return pa.RecordBatch.from_pydict({"a": pa.array(nodes[at[:, 0]]), "b": pa.array(nodes[at[:, 1]])})


def compare_groups(radius: int, could: Callable[[np.ndarray, np.ndarray], np.ndarray] | None, ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deals: dict[int, dict[int, list[dict]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                found = {"p": row["p"].as_py()} | {c: row[c].values.to_numpy() for c in ("lo", "hi", "nodes")}
                for c in {"fps", "proofs"} & row.keys():
                    found[c] = row[c].values.to_numpy().reshape(len(found["nodes"]), -1)
                if could is not None:
                    order = np.argsort(found["proofs"][:, 0], kind="stable")
                    found |= {c: found[c][order] for c in ("nodes", "fps", "proofs")}
                deals.setdefault(row["deal"].as_py(), {}).setdefault(row["g"].as_py(), []).append(found)
        while deals:
            _, groups = deals.popitem()
            sides = list(groups.values())
            for a, b in combinations_with_replacement(sides[0], 2) if len(sides) == 1 else product(*sides):
                if abs(a["p"] - b["p"]) > radius:
                    continue
                if np.maximum(np.maximum(a["lo"] - b["hi"], b["lo"] - a["hi"]), 0).sum() > radius:
                    continue
                both = [a] if a is b else [a, b]
                nodes = np.concatenate([t["nodes"] for t in both])
                may = reach = None
                if could is not None:
                    proofs = np.concatenate([t["proofs"] for t in both])
                    may = lambda x, y, proofs=proofs: could(proofs[x], proofs[y])
                    # Rows lie by size; one more or less makes up for rounding.
                    mine, other = a["proofs"][:, 0], b["proofs"][:, 0]
                    reach = np.searchsorted(other, mine * ratio - 1), np.searchsorted(other, mine / ratio + 1, "right")
                edges = tile_links(a["fps"], None if a is b else b["fps"], radius, may, reach)
                if edges:
                    yield edge_batch(edges, nodes)

    return run


def tiles_of(fps: DataFrame, tile: int) -> DataFrame:
    """Tiles of fingerprints (node, fp array<bigint>): (p, tile, nodes, fps, lo, hi).

    All fingerprints of a tile have p set bits; lo and hi are the least and most set bits of each part. A column
    proof array<bigint> goes along, as proofs.
    """
    more = [c for c in ("proof",) if c in fps.columns]
    some = fps.select("fp").first()
    words = len(some[0]) if some else 1
    width = 16 * words
    # A part is a quarter of the bits.
    part = [
        F.bit_count(
            F.shiftrightunsigned(F.col("fp")[i * width // 64], i * width % 64).bitwiseAND(F.lit((1 << width) - 1))
        ).cast("bigint")
        for i in range(4)
    ]
    bits = width.bit_length()
    key = F.lit(0).cast("bigint")
    for i, c in enumerate(part):
        key = key.bitwiseOR(F.shiftleft(c, 64 - bits * (i + 1)))
    total = sum(part[1:], part[0]).cast("int")
    keyed = fps.select("node", "fp", *more, total.alias("p"), key.alias("key"), F.array(*part).alias("parts"))
    # The first parts, leading bits of the key, cut a count's fingerprints into the buckets of the running count.
    placed = running(keyed, "p", "key", ["node"], F.lit(0), 10)
    low = F.array(*(F.min(F.col("parts")[i]) for i in range(4)))
    high = F.array(*(F.max(F.col("parts")[i]) for i in range(4)))
    both = F.collect_list(F.struct("node", "fp", *more))
    tiles = placed.groupBy("p", F.floor(F.col("pos") / tile).alias("tile")).agg(
        both.alias("both"), low.alias("lo"), high.alias("hi")
    )
    flat = [F.flatten(f"both.{c}").alias(f"{c}s") for c in ("fp", *more)]
    return tiles.select("p", "tile", F.col("both.node").alias("nodes"), *flat, "lo", "hi")


def links(
    fps: DataFrame,
    radius: int,
    tile: int = TILE,
    could: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    ratio: float = 1e-9,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Edges (a, b) between nodes that connect all whose fingerprints (node, fp array<bigint>) are within ``radius`` bits.

    With ``could``, ``fps`` has a column proof array<bigint>, and those are connected that are within the radius and that
    ``could`` lets pass: it gets the proofs of pairs, a row each, and tells which pairs are links. The first
    number of a proof is a size, and sizes further apart than ``ratio`` are not compared.
    """
    spark = fps.sparkSession
    tiles = checkpointed(tiles_of(fps, tile))
    bounds = tiles.select("p", "tile", "lo", "hi", F.size("nodes").alias("n"))
    rows = bounds.agg(F.sum("n")).first()[0] or 0
    # One small row per tile goes through this window.
    before = F.coalesce(F.sum("n").over(W.orderBy("p", "tile").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    g = F.floor(before / min(max(rows // GROUPS, tile), group_rows)).cast("int")
    bounds = checkpointed(bounds.withColumn("g", g).drop("n"))
    other = bounds.select(*(F.col(c).alias(f"b_{c}") for c in bounds.columns))
    mine = bounds.withColumnsRenamed({c: f"a_{c}" for c in bounds.columns}).withColumn(
        "b_p", F.explode(F.sequence(F.col("a_p"), F.col("a_p") + radius))
    )
    gaps = [
        F.greatest(F.lit(0), F.col("a_lo")[i] - F.col("b_hi")[i], F.col("b_lo")[i] - F.col("a_hi")[i])
        for i in range(4)
    ]
    pairs = (
        mine.join(other, "b_p")
        .filter((F.col("a_p") < F.col("b_p")) | (F.col("a_tile") <= F.col("b_tile")))
        .filter(sum(gaps[1:], gaps[0]) <= radius)
        .select(F.least("a_g", "b_g").alias("a"), F.greatest("a_g", "b_g").alias("b"))
        .distinct()
    )
    deals = [(g, i) for i, r in enumerate(sorted(map(tuple, pairs.collect()))) for g in sorted(set(r))]
    dealt = spark.createDataFrame(deals, "g int, deal int")
    full = tiles.join(F.broadcast(bounds.select("p", "tile", "g")), ["p", "tile"]).join(F.broadcast(dealt), "g")
    full = full.repartitionById(1 + max((i for _, i in deals), default=0), "deal").drop("tile")
    return full.mapInArrow(compare_groups(radius, could, ratio), EDGES)


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, radius: int = 4, tile: int = TILE
) -> DataFrame:
    """(key, fp, component_id) for every row of ``df``."""
    rows = checkpointed(
        df.select(F.col(f"`{key}`").alias(key), fingerprint_column(F.col(f"`{text}`"), words).alias("fp"))
    )
    nodes = checkpointed(rows.groupBy("fp").agg(F.min(key).alias("_first")))
    label = components(links(nodes.select(F.col("fp").alias("node"), F.array("fp").alias("fp")), radius, tile))
    labelled = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")
    )
    least = labelled.groupBy("label").agg(F.min("_first").alias("component_id"))
    classes = labelled.join(least, "label").select("fp", "component_id")
    return rows.join(classes, "fp").select(key, "fp", "component_id")


def simhash_report(df: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    found = near_duplicates(df, words=words, radius=radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
