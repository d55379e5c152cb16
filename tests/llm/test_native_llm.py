"""Secret scans and sharding: plain restatements in Python, edge cases, and no Python in the plans."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.llm.secret_scan import ALLOW, CLASSES, scan_secrets, secret_report
from tideline.llm.sharding import assign_shards, shard_report

PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)
LEAST = {"access": 20, "hex": 24}


def entropy(window):
    n = len(window)
    return -sum(c / n * math.log2(c / n) for c in Counter(window).values())


def scan(text):
    text = text or ""
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if (len(m[2]) >= 6) if kind == "assign" else len(m[0]) >= LEAST[kind]:
                spans.append((m.start(), rank, m.end(), kind))
    base = sorted(spans)
    for rank, c in enumerate(CLASSES, 3):
        new = []
        for m in re.finditer(c.pattern, text):
            if any(s < m.end() and m.start() < e for s, _, e, _ in spans):
                continue
            if any(re.search(p, m[0]) for p in ALLOW) or not all(re.search(p, m[0]) for p in c.must):
                continue
            v = m[0].lower() if c.fold else m[0]
            high = [i for i in range(len(v) - 19) if entropy(v[i : i + 20]) >= c.threshold]
            if high:
                new.append((m.start() + high[0], rank, m.start() + high[-1] + 20, c.kind))
        spans += new
    line = lambda some: ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(some))
    n = Counter(k for *_, k in base)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(line(base).encode()).hexdigest(), line(spans)


def texts():
    rng = random.Random(8)
    out = [
        None,
        "",
        "token: secret=token: abcdef123",
        'API_KEY="aaaaaa" apikey = bbbbb Passwd:\x20\x20\'x.y=z-1\'',
        "😀 AKIA" + "Z9" * 8 + " AKIAAKIA" + "Q" * 12 + " AKIASHORT",
        "0123456789abcdef01234567 0123456789abcdef0123456 ABCDEF0123456789ABCDEF",
        "aB3dE5gH7jK9mN1pQ3sT5vX/+_ and /usr/local/lib/python3/site0 and SAMPLEaB3dE5gH7jK9mN1p",
        "12345678901234567890123 " + "ab" * 40,
        "x" * 5000 + " " + "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789+/") for _ in range(3000)),
    ]
    pieces = ["secret", "token", "=", ":", " ", "é", '"', "AKIA", "ABCDEF1234", "deadbeef0", "password", "api_key", "0f", "Zz9", "_", "/", "q7W"]
    return out + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(300)]


def test_secrets_equal_plain_python(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts())] + [(None, "token=abcdef", "c", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _all string, _hex string")
    got = [tuple(r) for r in secret_report(df).collect()]
    assert sorted(got, key=str) == sorted(((i, *scan(t)) for i, t, *_ in rows), key=str)
    wide = scan_secrets(df)
    assert wide.columns == ["doc_id", "text", "_all", "_hex", "secrets"]
    for r in wide.collect():
        assert all((r.text or "")[s.start : s.end].endswith(s.value) for s in r.secrets)


ALPHABETS = {
    "hex": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def test_random_strings_are_found(spark):
    """Nine of ten random strings of each alphabet and length, from 20 characters on; and no words, paths or identifiers."""
    rng = random.Random(12)
    rows = [
        (f"{name} {n}", "some text (" + "".join(rng.choice(a) for _ in range(n)) + ") and more")
        for name, a in ALPHABETS.items() for n in (20, 24, 32, 40) for _ in range(300)
    ]
    df = scan_secrets(spark.createDataFrame(rows, "kind string, text string"))
    found = df.groupBy("kind").agg((F.avg((F.size("secrets") > 0).cast("int"))).alias("share"))
    shares = {r.kind: r.share for r in found.collect()}
    assert len(shares) == 24 and min(shares.values()) >= 0.9, shares
    plain = [
        "an-ordinary-hyphenated-phrase-of-some-length", "/usr/local/share/applications/defaults.list", "THE_GREATEST_CONSTANT_OF_THEM_ALL",
        "how-to-install-python-3-on-ubuntu-22-04-lts", "123e4567-e89b-12d3-a456-426614174000", "2024-01-01-12-30-45-000000-999999",
        "internationalization", "zzzzzzzzzzzzzzzzzzzzzzzz1", "some_module_name_42_of_a_package", "====================--------------------",
    ]
    quiet = scan_secrets(spark.createDataFrame([(t,) for t in plain], "text string")).filter(F.size("secrets") > 0)
    assert [r.text for r in quiet.collect()] == []


@pytest.mark.parametrize("kind", ["hex", "base64"])
def test_a_megabyte_of_matches_takes_seconds(spark, kind):
    rng = random.Random(13)
    alphabet = "0123456789abcdef" if kind == "hex" else ALPHABETS["base64"]
    text = " ".join("".join(rng.choice(alphabet) for _ in range(32)) for _ in range(1 << 15))
    began = time.time()
    row = secret_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.time() - began < 60
    assert row.n_hex == (1 << 15 if kind == "hex" else 0)
    if kind == "hex":
        assert row.spans.count(",") == (1 << 15) - 1
    else:
        assert row.spans.count("entropy_base64") > 30_000
        assert tuple(row)[1:] == scan(text)


def test_sharding_equals_plain_python(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", "é", "text", "hot " * 99])) for i in range(2000)] + [(5, "x"), (5, "x"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).repartition(7)

    def draws(key, n):
        return [-math.log((int(hashlib.md5(f"{'' if key is None else key}/{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) for i in range(n)]

    got = [tuple(r) for r in shard_report(df).collect()]
    slots = {}
    for doc_id, size, crc, law, shard, slot, grown in got:
        score = draws(doc_id, 41)
        assert law == "key" and shard == min(range(40), key=score.__getitem__)
        assert grown == min(range(41), key=score.__getitem__)
        slots.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted((r[:3] for r in got), key=str) == sorted(want, key=str)
    again = [tuple(r) for r in shard_report(df.repartition(2), rows_per_bucket=1).collect()]
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_shares_follow_weights(spark):
    df = assign_shards(spark.range(20_000), "id", (1.0, 2.0, 5.0), added=2.0)
    shares = {r["shard"]: r["count"] / 20_000 for r in df.groupBy("shard").count().collect()}
    assert all(shares[i] == pytest.approx(w / 8, abs=0.02) for i, w in enumerate((1, 2, 5)))
    moved = df.filter("shard <> grown_shard")
    assert moved.filter("grown_shard <> 3").count() == 0
    assert moved.count() / 20_000 == pytest.approx(0.2, abs=0.02)
    with pytest.raises(ValueError):
        assign_shards(spark.range(1), "id", ())


def test_no_rows_and_no_python(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    for report in (secret_report(df), shard_report(df)):
        assert report.collect() == []
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
