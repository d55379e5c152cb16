"""Threshold-scaled sketches: plain Python, estimates against true shares, unions, and no Python in the plan."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm.fingerprints import containment, fingerprint_report, limit, merged, sketch, with_sketch

TOP = 1 << 61


def shingles(text):
    w = [x.decode() for x in (text or "").encode().split()]
    return [" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


def small(text):
    h = sorted({hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles(text)})
    return [x for x in h if int(x, 16) < TOP] or h[:1]


def share(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def brute(rows):
    docs = sorted([(i, t or "") for i, t in rows], key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5(d[1].encode()).hexdigest()))
    out = []
    for (i, t), (j, u) in zip(docs, docs[1:] + docs[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        s, e, n = small(t), small(edited), small(u)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), ",".join(s), ",".join(e), share(s, e), share(s, n), j))
    return out


def test_report_equals_plain_python(spark):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "δέλτα", "\U0001f600", "e", "\n", "\t\t"]
    rows = [(i * 3 - 50, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))) for i in range(120)]
    rows += [(7, None), (8, ""), (8, ""), (None, "a null id"), (None, None), (9, "x y z"), (9, "x y z"), (9, "x y"), (10, "word " * 9000), (11, " \n ")]
    want = sorted(map(str, brute(rows)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).repartition(5)
    for size in (1 << 25, 400):
        got = fingerprint_report(df, bucket_bytes=size).collect()
        assert sorted(str(tuple(r)[:8]) for r in got) == want


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert {(r.next_id, r.near_next) for r in fingerprint_report(df).collect()} == {(1, 1.0)}
    assert fingerprint_report(df.limit(0)).collect() == []


def test_estimates_of_very_unequal_documents(spark):
    rng = random.Random(9)
    part = [str(rng.random()) for _ in range(1500)]
    rows = []
    for k in (0, 25, 50, 100):
        taken = part[: 15 * k]
        rows.append((k, " ".join(part), " ".join([str(rng.random()) for _ in range(60_000)] + taken)))
    df = spark.createDataFrame(rows, "k int, a string, b string").select("k", sketch(F.col("a")).alias("a"), sketch(F.col("b")).alias("b"))
    for r in df.select("k", containment(F.col("a"), F.col("b")).alias("share")).collect():
        assert r.share == pytest.approx(r.k / 100, abs=0.1)


def test_union_of_sketches_is_the_sketch_of_both(spark):
    rng = random.Random(10)
    texts = ["", "one", "two words"] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 90))) for _ in range(40)]
    rows = [(rng.choice(texts), rng.choice(texts)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", merged(sketch(F.col("a")), sketch(F.col("b"))).alias("m")).collect():
        every = sorted({hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles(r.a) + shingles(r.b)})
        assert r.m == ([x for x in every if int(x, 16) < TOP] or every[:1])


def test_columns_pass_and_no_python(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "a b", "y")], "id int, body string, sketch string")
    got = with_sketch(df, "body")
    assert got.columns == ["id", "body", "sketch"]
    assert {r.body: len(r.sketch) for r in got.collect()} == {None: 0, "a b": 1}
    report = fingerprint_report(df.select(F.col("id").cast("long").alias("doc_id"), F.col("body").alias("text")))
    for plan in (got, report):
        assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())
    for bad in (0, 1):
        with pytest.raises(ValueError):
            limit(bad)
