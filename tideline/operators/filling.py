"""Where the aggregate that a record begins is full, for every record of a run.

A packer that does not know which record begins an aggregate needs this for all
of them. One window slides over the records: its right end is where the
aggregate of its left end is full. What a record takes depends on the others,
as a key's index is its rank by first appearance and longer from the 129th key
on; the window keeps these lengths exact while it moves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np

from tideline.operators.codec import OpenAggregate

# Keys whose index takes one byte; two bytes hold the square of it, and so on.
_ONE_BYTE = 1 << 7

# Two indexes of five bytes each: more keys than rows.
_MOST_INDEX_BYTES = 10


def varint_bytes(n: int) -> int:
    return max(1, (n.bit_length() + 6) // 7)


def table_bytes(key: bytes) -> int:
    return 1 + varint_bytes(len(key)) + len(key)


def _inner_bytes(key_index: int, hash_index: int, n: int) -> int:
    return 1 + key_index + (1 + hash_index if hash_index else 0) + 1 + varint_bytes(n) + n


def record_bytes(key_index: int, hash_index: int, n: int) -> int:
    """Bytes of a record of ``n`` bytes of data, given the lengths of its indexes; no hash key has length 0."""
    inner = _inner_bytes(key_index, hash_index, n)
    return 1 + varint_bytes(inner) + inner


class _Indexes:
    """Lengths of the indexes of one kind of key, counted from a first row that moves on."""

    def __init__(self, keys: list[bytes | None]):
        self.keys = keys
        n = len(keys)
        self.later, following = [n] * n, {}
        for row in range(n - 1, -1, -1):
            if keys[row] is not None:
                self.later[row] = following.get(keys[row], n)
                following[keys[row]] = row
        self.length = dict.fromkeys(following, 1)
        self.length[None] = 0
        # For each length: the keys whose indexes are no longer, and the first row with another key.
        self.cuts: list[tuple[set, int]] = []
        room = _ONE_BYTE
        while len(following) > room:
            short: set = set()
            row = 0
            while len(short) < room or keys[row] is None or keys[row] in short:
                if keys[row] is not None:
                    short.add(keys[row])
                row += 1
            for key in following:
                self.length[key] += key not in short
            self.cuts.append((short, row))
            room *= _ONE_BYTE

    def leave(self, row: int) -> Iterator[tuple[bytes, int]]:
        """Take the first row away; after every change, a key and how much longer its index has become."""
        keys, n = self.keys, len(self.keys)
        key, again = keys[row], self.later[row]
        if key is None:
            return
        for i, (short, beyond) in enumerate(self.cuts):
            if again < beyond:
                continue
            short.discard(key)
            if beyond == n:
                continue
            short.add(keys[beyond])
            self.length[keys[beyond]] -= 1
            yield keys[beyond], -1
            if again < n:
                self.length[key] += 1
                yield key, 1
            while beyond < n and (keys[beyond] is None or keys[beyond] in short):
                beyond += 1
            self.cuts[i] = (short, beyond)


class _Window:
    """Bytes of the records between two rows as one aggregate, without what every aggregate has."""

    def __init__(self, keys: list[bytes], hash_keys: list[bytes | None], lengths: list[int]):
        self.lengths = lengths
        self.kinds = [_Indexes(keys), _Indexes(hash_keys)]
        self.held: list[dict] = [{}, {}]
        self.total = 0
        # A longer index makes a record longer by as much; by more only if the record's own length takes a byte more.
        self.edges: list[dict] = [{}, {}]
        for row, (key, hash_key, n) in enumerate(zip(keys, hash_keys, lengths)):
            least = _inner_bytes(1, int(hash_key is not None), n)
            if varint_bytes(least) != varint_bytes(least + _MOST_INDEX_BYTES):
                self.edges[0].setdefault(key, []).append(row)
                self.edges[1].setdefault(hash_key, []).append(row)

    def _inner(self, row: int) -> int:
        a, b = self.kinds
        return _inner_bytes(a.length[a.keys[row]], b.length[b.keys[row]], self.lengths[row])

    def _record(self, row: int) -> int:
        inner = self._inner(row)
        return 1 + varint_bytes(inner) + inner

    def add(self, row: int) -> None:
        for kind, held in zip(self.kinds, self.held):
            key = kind.keys[row]
            if key is not None:
                count = held.get(key, 0)
                held[key] = count + 1
                if not count:
                    self.total += table_bytes(key)
        self.total += self._record(row)

    def remove(self, row: int) -> None:
        for kind, held in zip(self.kinds, self.held):
            key = kind.keys[row]
            if key is not None:
                held[key] -= 1
                if not held[key]:
                    del held[key]
                    self.total -= table_bytes(key)
        self.total -= self._record(row)

    def leave(self, row: int, end: int) -> None:
        """Take the first row away, of rows up to ``end``."""
        self.remove(row)
        for kind, held, edges in zip(self.kinds, self.held, self.edges):
            for key, longer in kind.leave(row):
                self.total += longer * held.get(key, 0)
                at = edges.get(key, ())
                for other in at[bisect_right(at, row) : bisect_left(at, end)]:
                    inner = self._inner(other)
                    self.total += varint_bytes(inner) - varint_bytes(inner - longer)


def ends(
    keys: list[bytes], hash_keys: list[bytes | None], lengths: list[int], batches: list, limit: int
) -> np.ndarray:
    """For each record, the row before which an aggregate that begins with it is closed; the number of rows if none."""
    n = len(keys)
    found = np.full(n, n, np.int64)
    window, end = _Window(keys, hash_keys, lengths), 0
    fixed = OpenAggregate().estimate
    for row in range(n):
        room = limit - fixed - len(keys[row])
        if end == row:
            window.add(row)
            end += 1
        # A longer first key than before may leave less room.
        while end > row + 1 and window.total > room:
            end -= 1
            window.remove(end)
        while end < n:
            window.add(end)
            if window.total > room:
                window.remove(end)
                break
            end += 1
        found[row] = end
        window.leave(row, end)
    change = n
    for row in range(n - 1, -1, -1):
        if row + 1 < n and batches[row] != batches[row + 1]:
            change = row + 1
        found[row] = min(found[row], change)
    return found


def chains(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each record that begins an aggregate: the record that begins the run's last one, and how many close before it."""
    n = len(found)
    jump = np.where(found < n, found, np.arange(n))
    hops = (jump != np.arange(n)).astype(np.int64)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump, hops
        hops, jump = hops + hops[jump], further
