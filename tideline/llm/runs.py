"""Runs: maximal stretches of consecutive words that repeat with a period, at least twice over.

Two places i < j = i + p whose suffixes share exactly l words and whose words
to the left differ are a maximal pair. If p <= l, the stretch from i of p + l
words has period p and no neighbour extends it: the pair is a run, or a run
seen at a multiple of its period, and every run is such a pair. So nothing is
ever extended: pairs whose distance and length satisfy the constraints are the runs.

Pairs come from the LCP-interval tree of the words' suffixes, bottom up. An
interval holds the places below it, sorted, and the same by the word to the
left (its class lists). When a child joins, each place of the smaller side
looks up those of the other side within l words; a stretch of its own class
is passed over by a binary search on both lists, so the work is the pairs
found plus O(log n) for each place that moves, and places move O(log n) times. Intervals of
fewer words than half the least run length cannot give a run and are never
built: most texts end at a hash of their short windows.

The texts of a portion are one sequence; a word's number depends on its text,
so nothing is shared across texts. Rows do not move between tasks.

NULL, empty and blank texts have no words, no runs, and collapse to an empty
text. Words are split at ASCII white space and compared byte by byte; texts of
any length are read whole. Repeated rows give the same runs; other columns pass
through, whatever their names (``runs`` and ``collapsed`` are replaced). An
empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import own_names

#: Fewest words of a run.
LEAST_WORDS = 12
#: Words of the texts that are searched together; a longer text is searched by itself.
PORTION_WORDS = 1 << 19
#: An odd number that spreads the hash of a window over 64 bits.
SPREAD = 0x9E3779B97F4A7C15
RESULT = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>"


def repeated(symbols: np.ndarray, words: int) -> np.ndarray:
    """Places whose window of ``words`` symbols seems to occur again (equal hashes)."""
    n = len(symbols) - words + 1
    if n < 2:
        return np.zeros(0, np.int64)
    spread = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(SPREAD)
    spread ^= spread >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for k in range(words):
        hashes = hashes * np.uint64(SPREAD) + spread[k : k + n]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    return np.unique(np.concatenate([order[1:][same], order[:-1][same]]))


def suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places in the order of their suffixes, and ranks of all stretches of 1, 2, 4, ... symbols."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1]
    levels, width = [rank], 1
    while rank.max() + 1 < n:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        levels.append(rank)
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def shared_lengths(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Symbols that each suffix shares with the next in order, and zero for the last."""
    n = len(order)
    i, j = order[:-1].copy(), order[1:].copy()
    length = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(i, j) + (1 << k) <= n
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
        step = same.astype(np.int64) << k
        length, i, j = length + step, i + step, j + step
    return np.append(length, 0)


class Places:
    """The places below an interval, sorted, and the same by the symbol to their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int) -> None:
        self.all = [place]
        self.by_left = {left: [place]}

    def partners(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places within ``reach`` of another interval's place that have another symbol to their left."""
        every, own = self.all, self.by_left.get(left, [])
        i, k = bisect_left(every, place), bisect_left(own, place)
        while i < len(every) and every[i] <= place + reach:
            if k < len(own) and own[k] == every[i]:
                # As long as no other class comes between, both lists go on alike.
                step = bisect_left(range(1, min(len(every) - i, len(own) - k)), True, key=lambda t: every[i + t] != own[k + t]) + 1
                i, k = i + step, k + step
            else:
                yield every[i]
                i += 1
        i, k = bisect_left(every, place) - 1, bisect_left(own, place) - 1
        while i >= 0 and every[i] >= place - reach:
            if k >= 0 and own[k] == every[i]:
                step = bisect_left(range(1, min(i, k) + 1), True, key=lambda t: every[i - t] != own[k - t]) + 1
                i, k = i - step, k - step
            else:
                yield every[i]
                i -= 1

    def take(self, other: Places) -> None:
        _merge(self.all, other.all)
        for left, some in other.by_left.items():
            mine = self.by_left.get(left)
            if mine is None:
                self.by_left[left] = some
            else:
                _merge(mine, some)


def _merge(big: list[int], small: list[int]) -> None:
    if 4 * len(small) > len(big):
        big.extend(small)
        big.sort()
    else:
        for x in small:
            insort(big, x)


def maximal_pairs(order: list[int], lengths: list[int], lefts: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, l) of every maximal pair with i < j, l >= shortest and j - i <= l."""
    open_: list[tuple[int, Places]] = []

    def join(a: Places, b: Places, length: int) -> Places:
        if len(a.all) < len(b.all):
            a, b = b, a
        for left, some in b.by_left.items():
            for x in some:
                for y in a.partners(x, left, length):
                    found.append((min(x, y), max(x, y), length))
        a.take(b)
        return a

    found: list[tuple[int, int, int]] = []
    for place, length in zip(order, lengths, strict=True):
        if length < shortest and not open_:
            continue
        last = Places(place, lefts[place])
        while open_ and open_[-1][0] > length:
            depth, so_far = open_.pop()
            last = join(so_far, last, depth)
        if length >= shortest:
            if open_ and open_[-1][0] == length:
                open_[-1] = (length, join(open_[-1][1], last, length))
            else:
                open_.append((length, last))
        if found:
            yield from found
            found.clear()


def runs_of(text_of: np.ndarray, words: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of numbered words behind each other.

    ``text_of`` numbers the text of each word, ascending; places count through all texts.
    """
    none = np.zeros((0, 3), np.int64)
    shortest = -(-least // 2)
    if len(words) < least:
        return none
    symbols = text_of.astype(np.int64) * (int(words.max()) + 1) + words
    again = repeated(symbols, shortest)
    held = np.isin(text_of, text_of[again])
    places = np.flatnonzero(held)
    if not len(places):
        return none
    symbols = np.unique(symbols[places], return_inverse=True)[1]
    texts = text_of[places]
    first = np.append(True, texts[1:] != texts[:-1])
    lefts = np.where(first, -1, np.append(-1, symbols[:-1]))
    order, levels = suffixes(symbols)
    lengths = shared_lengths(order, levels)
    # Only neighbours that share enough words make intervals.
    near = lengths >= shortest
    near[1:] |= near[:-1].copy()
    order, lengths = order[near], lengths[near]
    pairs = [
        (i, j - i + length, j - i)
        for i, j, length in maximal_pairs(order.tolist(), lengths.tolist(), lefts.tolist(), shortest)
        if j - i + length >= least
    ]
    if not pairs:
        return none
    found = np.array(pairs, np.int64)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    # A stretch seen at several distances: its period is the smallest.
    fresh = np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))
    found = found[fresh]
    found[:, 0] = places[found[:, 0]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def text_runs(texts: list[bytes], least: int = LEAST_WORDS) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs of each text, and the text without what repeats in them."""
    split = [t.split() for t in texts]
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    size = np.array([len(some) for some in split], np.int64)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, size.sum())
    found = runs_of(np.repeat(np.arange(len(split)), size), words, least)
    starts = np.cumsum(size) - size
    cuts = np.searchsorted(found[:, 0], np.append(starts, size.sum())) if len(found) else np.zeros(len(split) + 1, np.int64)
    for k, some in enumerate(split):
        runs = found[cuts[k] : cuts[k + 1]] - [starts[k], 0, 0]
        if len(runs):
            change = np.zeros(len(some) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            some = [some[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        yield runs, b" ".join(some)


def run_column(text: Column, least: int = LEAST_WORDS) -> Column:
    """Runs and collapsed form of a text, given as bytes."""

    @F.arrow_udf(RESULT)
    def search(texts: pa.Array) -> pa.Array:
        runs, collapsed, some, size = [], [], [], 0
        for i, t in enumerate(texts):
            some.append(t.as_py() or b"")
            size += len(some[-1]) // 6
            if size >= PORTION_WORDS or i == len(texts) - 1:
                for found, kept in text_runs(some, least):
                    runs.append(found)
                    collapsed.append(kept)
                some, size = [], 0
        ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        flat = np.concatenate([np.zeros((0, 3), np.int64), *runs]).T.copy()
        items = pa.StructArray.from_arrays(list(map(pa.array, flat)), ["start", "length", "period"])
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends), items), pa.array(collapsed, pa.binary())], ["runs", "collapsed"]
        )

    return search(text)


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``df`` with ``runs``, array<struct<start, length, period>> in words, and ``collapsed``, the text without repeats.

    Of each run, ``collapsed`` keeps the first period. Kept words are joined by one blank.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    kept = [c for c in df.columns if c not in ("runs", "collapsed")]
    df, own = own_names(df)
    names = [own[c] for c in kept]
    found = df.withColumn("_r", run_column(F.col(own[text]).cast("string").cast("binary"), least))
    return found.select(*names, "_r.runs", F.col("_r.collapsed").cast("string")).toDF(*kept, "runs", "collapsed")


def planted(doc_id: Column, text: Column) -> Column:
    """The texts that the report searches: one document in ten, by its id's checksum, repeats from some word on."""

    @F.arrow_udf("binary")
    def repeat(checksums: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, t in zip(checksums.to_pylist(), texts, strict=True):
            data = t.as_py() or b""
            if h is not None and h % 10 == 0 and (words := data.split()):
                g = h // 10
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                data = b" ".join(words[:a] + [words[a + i % p] for i in range(len(words) - a)])
            out.append(data)
        return pa.array(out, pa.binary())

    return repeat(F.crc32(doc_id.cast("string").cast("binary")), text.cast("string").cast("binary"))


def run_report(df: DataFrame) -> DataFrame:
    """One row per document: its runs, the longest of them, and digests; a NULL doc_id is never altered."""
    # Two functions in one pass of the worker.
    text = planted(F.col("doc_id"), F.col("text"))
    found = df.select("doc_id", run_column(text).alias("_r")).select("doc_id", "_r.runs", "_r.collapsed")
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("_b"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("_b.start")).alias("start"),
        F.col("_b.length").alias("length"),
        (-F.col("_b.period")).alias("period"),
        F.floor(1000 * F.col("_b.length") / -F.col("_b.period")).cast("bigint").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
