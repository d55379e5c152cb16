"""Byte-level BPE encoding and decoding by the ranks of a tiktoken vocabulary.

A text is split by the vocabulary's pattern; each match is encoded by itself.
A match that is a token as a whole is that token. Otherwise its bytes are
leaves of a segment tree, each with the rank of the pair it starts, and a node
holds the leftmost smallest rank below it. A merge takes the root, joins two
live neighbours, and updates the three leaves it changes: O(log n) each, so a
match of n bytes takes O(n log n), however long it is.

Matches repeat, so a worker keeps the ids of the last ones it has seen, up to
a fixed number. The new short matches of several texts are merged together:
their trees are the rows of one array, and a round makes one merge in each.
Nothing is shuffled; a row is one text, read whole.

NULL counts as empty: no ids, no bytes. Repeated rows encode alike; other
columns pass through. An empty table gives an empty result. Ids that the
vocabulary lacks make decoding fail.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short matches whose ids a worker remembers.
CACHE_ENTRIES = 300_000
#: Longest piece whose tree is a row of an array, and rows at once.
FOREST_BYTES = 64
FOREST_ROWS = 4096
#: Characters of the texts that are encoded together.
PORTION_CHARS = 1 << 20
#: No rank: above all others.
NONE = 1 << 62

#: White space as the vocabulary's own library reads it: the Unicode property, without U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class MergeTree:
    """The pair ranks of a sequence of bytes; key = rank * leaves + position, so the least key is the leftmost."""

    def __init__(self, ranks: dict[bytes, int], piece: bytes) -> None:
        n = len(piece)
        size = 1 << max(0, (n - 1).bit_length())
        self.ranks, self.piece, self.size = ranks, piece, size
        self.after = list(range(1, n + 1))  # where the part that starts here ends
        self.before = list(range(-1, n - 1))  # where the part before starts
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank * size + i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        self.tree = tree

    def _set(self, i: int, key: int) -> None:
        tree = self.tree
        i += self.size
        tree[i] = key
        while i > 1:
            i >>= 1
            key = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == key:
                return
            tree[i] = key

    def _pair(self, i: int) -> int:
        """Key of the part that starts at i and the one behind it."""
        middle = self.after[i]
        if middle >= len(self.piece):
            return NONE
        rank = self.ranks.get(self.piece[i : self.after[middle]])
        return NONE if rank is None else rank * self.size + i

    def parts(self) -> list[bytes]:
        n = len(self.piece)
        after, before = self.after, self.before
        while self.tree[1] != NONE:
            i = self.tree[1] & (self.size - 1)
            gone = after[i]
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            self._set(gone, NONE)
            self._set(i, self._pair(i))
            if before[i] >= 0:
                self._set(before[i], self._pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(self.piece[i : after[i]])
            i = after[i]
        return out


class MergeForest:
    """The same trees for many short pieces: row k of each array is a piece, a round merges once in every row."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        # Every way to put a token together from two others.
        find = ranks.get
        pairs = [
            (a << 32 | b, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (a := find(token[:cut])) is not None and (b := find(token[cut:])) is not None
        ]
        pair, rank = np.array(pairs, np.int64).reshape(-1, 2).T
        order = np.argsort(pair)
        self.pairs, self.rank = pair[order], rank[order]

    def _keys(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        pair = (a << 32) | b
        i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[i] == pair, self.rank[i] * size + at, NONE)

    def encode(self, pieces: list[bytes], size: int) -> list[tuple[int, ...]]:
        """Ids of pieces of at most ``size`` bytes, a power of two."""
        k = len(pieces)
        n = np.fromiter(map(len, pieces), np.int64, k)
        data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(k, size)
        ids = self.byte_ids[data]
        place = np.arange(size)
        after = np.tile(place + 1, (k, 1))
        before = np.tile(place - 1, (k, 1))
        alive = place < n[:, None]
        tree = np.full((k, 2 * size), NONE)
        row, at = np.nonzero(place < n[:, None] - 1)
        tree[row, size + at] = self._keys(ids[row, at], ids[row, at + 1], at, size)
        width = size
        while width > 1:
            tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
            width //= 2

        def put(rows: np.ndarray, at: np.ndarray, keys: np.ndarray | int) -> None:
            at = at + size
            tree[rows, at] = keys
            while at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        def pair(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            middle = after[rows, at]
            inside = middle < n[rows]
            other = ids[rows, np.minimum(middle, size - 1)]
            return np.where(inside, self._keys(ids[rows, at], other, at, size), NONE)

        while len(rows := np.flatnonzero(tree[:, 1] != NONE)):
            key = tree[rows, 1]
            at = key & (size - 1)
            gone = after[rows, at]
            ids[rows, at] = key // size  # a merged token's id is its rank
            end = after[rows, gone]
            after[rows, at] = end
            alive[rows, gone] = False
            inner = end < n[rows]
            before[rows[inner], end[inner]] = at[inner]
            put(rows, gone, NONE)
            put(rows, at, pair(rows, at))
            prev = before[rows, at]
            has = prev >= 0
            if has.any():
                put(rows[has], prev[has], pair(rows[has], prev[has]))
        flat = ids[alive].tolist()
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        return [tuple(flat[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.decimal = {i: str(i) for i in ranks.values()}
        self.forest = MergeForest(ranks)
        for form, spelt in ((r"[^\s", f"[^{SPACE}"), (r"\s", f"[{SPACE}]"), (r"\S", f"[^{SPACE}]")):
            pattern = pattern.replace(form, spelt)
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def _learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pieces that are not remembered; short ones are remembered."""
        found: dict[str, tuple[int, ...]] = {}
        sizes: dict[int, list[tuple[str, bytes]]] = {}
        for text in pieces:
            data = text.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                found[text] = (whole,)
            elif len(data) > FOREST_BYTES:
                found[text] = tuple(self.ranks[p] for p in MergeTree(self.ranks, data).parts())
            else:
                sizes.setdefault(1 << (len(data) - 1).bit_length(), []).append((text, data))
        for size, members in sizes.items():
            for i in range(0, len(members), FOREST_ROWS):
                texts, data = zip(*members[i : i + FOREST_ROWS], strict=True)
                found.update(zip(texts, self.forest.encode(list(data), max(2, size)), strict=True))
        if len(self.cache) + len(found) > CACHE_ENTRIES:
            self.cache.clear()
        if len(found) <= CACHE_ENTRIES:
            self.cache.update((t, ids) for t, ids in found.items() if len(t) <= FOREST_BYTES)
        return found

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        split = [self.find(t) for t in texts]
        known = self.cache
        pieces = set(chain.from_iterable(split))
        missing = pieces - known.keys()
        if missing:
            # Learning may empty the cache, so what these texts need of it is held first.
            needed = {m: known[m] for m in pieces - missing}
            known = needed | self._learn(missing)
        return [list(chain.from_iterable(map(known.__getitem__, ms))) for ms in split]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def portions(texts: pa.Array):
    """Lists of texts of about ``PORTION_CHARS`` characters together, NULL as empty."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= PORTION_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return Tokenizer(ranks, pattern)


def once_per_task(path: str, pattern: str) -> Callable[[], Tokenizer]:
    """Loads the tokenizer at the first call; functions go to executors by value, so each task has its own."""
    held: list[Tokenizer] = []

    def get() -> Tokenizer:
        if not held:
            held.append(tokenizer(path, pattern))
        return held[0]

    return get


def encode_column(text: Column, path: str, pattern: str) -> Column:
    """array<int> of a text's ids."""
    load = once_per_task(path, pattern)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        t = load()
        ids = chain.from_iterable(t.encode_all(some) for some in portions(texts))
        return pa.array(list(ids), pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of an array of ids."""
    load = once_per_task(path, pattern)

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        t = load()
        return pa.array([t.decode(x or ()) for x in rows.to_pylist()], pa.binary())

    return decode(ids)


DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def digest_column(text: Column, path: str, pattern: str) -> Column:
    """Round trip of a text in one pass: number of ids, digest of the ids, digest of the bytes they decode to."""
    load = once_per_task(path, pattern)

    @F.arrow_udf(DIGESTS)
    def digest(texts: pa.Array) -> pa.Array:
        t = load()
        n, ids_sha, bytes_sha = [], [], []
        for some in portions(texts):
            for ids in t.encode_all(some):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(t.decimal.__getitem__, ids)).encode()).hexdigest())
                bytes_sha.append(hashlib.sha256(t.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digest(text)


def bpe_report(df: DataFrame, path: str, pattern: str) -> DataFrame:
    digest = digest_column(F.col("text"), path, pattern)
    return df.select("doc_id", digest.alias("_d")).select("doc_id", "_d.n_tokens", "_d.ids_sha256", "_d.decoded_sha256")
