"""Texts of a megabyte and more, beside short ones."""

import re
import time
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tideline.llm.langid import language_report
from tideline.llm.quality import quality_report
from tideline.llm.simhash import simhash_report

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def long_rows(spark):
    """For each language, all its documents with clean labels in one text, repeated up to a megabyte."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 and toxic = 0").select("doc_id")
    texts = {}
    for row in docs.join(clean, "doc_id").filter("lang is not null").orderBy("doc_id").select("lang", "text").collect():
        texts.setdefault(row.lang, []).append(row.text)
    rows = []
    for i, (lang, parts) in enumerate(sorted(texts.items())):
        whole = "\n".join(parts)
        rows.append((10_000_000 + i, (whole + "\n") * (1 + (1 << 20) // len(whole)), lang))
    assert all(len(t) > 1 << 20 for _, t, _ in rows)
    return rows


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    counts, total = Counter(shingles), len(shingles)
    bits = [0] * 64
    for shingle, n in counts.items():
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for b in range(64):
            bits[b] += n * (h >> b & 1)
    return f"{sum(1 << b for b in range(64) if 2 * bits[b] > total):016x}"


def test_fingerprints_of_long_texts(spark, long_rows):
    rows = [*long_rows, (1, long_rows[0][1] + " one word more", "x"), (2, "a short text of other words", "x"), (3, None, None)]
    got = {r.doc_id: r for r in simhash_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for doc_id, text, _ in rows[:2]:
        assert got[doc_id].fingerprint == plain_fingerprint(text)
    assert got[1].component_id == got[long_rows[0][0]].component_id == 1
    assert got[2].component_id == 2 and got[3].component_id == 3


def test_languages_and_quality_of_long_texts(spark, long_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame(long_rows, "doc_id long, text string, lang string")
    df = docs.unionByName(more, allowMissingColumns=True)
    began = time.time()
    langs = {r.doc_id: r.lang_pred for r in language_report(df).filter(F.col("doc_id") >= 10_000_000).collect()}
    assert langs == {doc_id: lang for doc_id, _, lang in long_rows}
    kept = {r.doc_id: r.kept for r in quality_report(df).filter(F.col("doc_id") >= 10_000_000).collect()}
    assert kept == {doc_id: True for doc_id, *_ in long_rows}
    assert time.time() - began < 300
