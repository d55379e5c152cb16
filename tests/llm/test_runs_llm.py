"""Runs: against every stretch and period tried in turn, on texts that repeat in many ways."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from tideline.llm.runs import find_runs, run_report, runs_of, text_runs


def brute(words, least=12):
    """Every period's maximal stretches, kept if no smaller period covers the same stretch."""
    found = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            start, length = i, j + p - i
            if length >= max(least, 2 * p):
                found.setdefault((start, length), p)
            i = j + 1
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(3)
    yield []
    yield ["a"]
    yield ["a"] * 11
    yield ["a"] * 12
    yield ["a"] * 500
    yield ["a", "b"] * 300 + ["c"] + ["a", "b"] * 300
    x, y = ["a"], ["a", "b"]
    for _ in range(12):  # Fibonacci words: as many runs as there can be
        x, y = y, y + x
    yield y
    yield sum([["a"] * rng.randrange(1, 30) + [rng.choice("bcd")] for _ in range(60)], [])
    for _ in range(250):
        block = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12))]
        out = []
        for _ in range(rng.randrange(1, 8)):
            out += block[: rng.randrange(len(block) + 1)] + block * rng.randrange(0, 6)
            out += [rng.choice("abxyz") for _ in range(rng.randrange(4))]
        yield out
    for _ in range(100):
        yield [rng.choice("ab") for _ in range(rng.randrange(60))]


def test_all_runs_of_many_sequences():
    some = list(sequences())
    got = list(text_runs([" ".join(s).encode() for s in some]))
    for words, (runs, kept) in zip(some, got, strict=True):
        want = brute(words)
        assert list(map(tuple, runs.tolist())) == want
        assert kept.decode() == collapse(words, want)


@pytest.mark.parametrize("least", [2, 3, 7])
def test_other_least_lengths(least):
    for words in list(sequences())[-150:]:
        runs = next(text_runs([" ".join(words).encode()], least))[0]
        assert list(map(tuple, runs.tolist())) == brute(words, least)


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_report_equals_plain_python(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([" ", "\n", "\t \x0b"]).join(s)) for i, s in enumerate(sequences())]
    rows += [(1000 + i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 90)))) for i in range(300)]
    rows += [(None, "é " * 20), (7, None), (7, "é é é é " * 9), (7, "é é é é " * 9), (-5, "x " * 40)]
    want = []
    for doc_id, text in rows:
        words = altered(doc_id, [w.decode() for w in (text or "").encode().split()])
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(words, runs))]
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(str, map(tuple, run_report(df).collect()))) == sorted(map(str, want))
    assert sum(w[1] for w in want[-300:]) > 20


def test_columns_pass_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b " * 9, "x"), (1, None, None)], "id int, body string, runs string")
    got = find_runs(df, "body")
    assert got.columns == ["id", "body", "runs", "collapsed"]
    rows = {r.body: r for r in got.collect()}
    assert [tuple(r) for r in rows["a b " * 9].runs] == [(0, 18, 2)] and rows["a b " * 9].collapsed == "a b"
    assert (rows[None].runs, rows[None].collapsed) == ([], "")
    assert find_runs(df.limit(0), "body").collect() == []
    assert run_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        find_runs(df, "body", least=1)


def test_long_texts_take_little_more_than_linear_time():
    rng = np.random.default_rng(1)
    line = rng.integers(0, 900, 12)
    cases = {
        "one word": np.zeros(200_000, np.int64),
        "blocks": np.concatenate([np.append(np.zeros(400, np.int64), 1 + k % 7) for k in range(500)]),
        "lines": np.concatenate([np.append(line, 1000 + k % 50) for k in range(15_000)]),
    }
    for name, words in cases.items():
        began = time.time()
        assert len(runs_of(np.zeros(len(words), np.int64), words)), name
        assert time.time() - began < 60, name
