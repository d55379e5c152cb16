"""BPE against tiktoken; classifiers on held-out rows; edge cases."""

import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tideline.llm import bpe, quality
from tideline.llm.features import gram_counts, sparse
from tideline.llm.langid import Hierarchy, language_report
from tideline.llm.quality import CLEAN, JUNK, NONE, LabelModel, keep_clean, quality_report, with_votes

SF = "/root/testdata/sf0.01"
PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    signs = "abcdeths  \n\t\r'.,!éß中文😀\x1c\x1f\x85  　 0123٣<|endoftext|>"
    out = ["", " ", "a" * 3000, "ab" * 500 + "é" * 300, "<|endoftext|>", "   \n  x", "I'll it's 'S"]
    return out + ["".join(rng.choice(signs) for _ in range(rng.randrange(120))) for _ in range(300)]


def test_bpe_equals_the_library(spark, reference, monkeypatch):
    texts = [*odd_texts(), None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _d string")
    got = {r.doc_id: r for r in bpe.bpe_report(df, PATH, tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    ids = bpe.encode_column(F.col("text"), PATH, tokenizers.PATTERN)
    back = df.withColumn("ids", ids).withColumn("back", bpe.decode_column(F.col("ids"), PATH, tokenizers.PATTERN))
    assert all(bytes(r.back).decode() == (r.text or "") for r in back.collect())
    assert bpe.bpe_report(df.limit(0), PATH, tokenizers.PATTERN).collect() == []


def test_forest_equals_tree_and_small_caches_change_nothing(reference, monkeypatch):
    t = bpe.tokenizer(PATH, tokenizers.PATTERN)
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abthe ein\xc3\xa9") for _ in range(rng.randrange(2, 33))) for _ in range(500)]
    rows = t.forest.encode(pieces, 32)
    assert rows == [tuple(t.ranks[p] for p in bpe.MergeTree(t.ranks, piece).parts()) for piece in pieces]
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    small = bpe.Tokenizer(t.ranks, tokenizers.PATTERN)
    texts = odd_texts()
    assert small.encode_all(texts) == [reference.encode_ordinary(x) for x in texts]


def test_gram_counts_equal_a_plain_count():
    text = "aé b".encode() * 3
    counts = gram_counts(text)
    assert counts.sum() == sum(len(text) - n + 1 for n in (1, 2, 3))
    from tideline.llm import features

    chunked = features.CHUNK
    try:
        features.CHUNK = 4
        assert (gram_counts(text) == counts).all()
    finally:
        features.CHUNK = chunked


def test_label_model_finds_the_better_labellers():
    rng = np.random.default_rng(3)
    truth = rng.random(5000) < 0.85
    votes = []
    for hit, wrong, seen in ((0.9, 0.01, 1.0), (0.5, 0.02, 0.9), (0.6, 0.05, 0.8), (0.3, 0.3, 1.0)):
        junk = np.where(truth, rng.random(5000) < wrong, rng.random(5000) < hit)
        votes.append(np.where(rng.random(5000) < seen, np.where(junk, JUNK, CLEAN), NONE))
    patterns, inverse, counts = np.unique(np.stack(votes, 1), axis=0, return_inverse=True, return_counts=True)
    model = LabelModel(patterns, counts.astype(float))
    right = (model.posterior(patterns)[inverse.ravel()] > 0.5) == truth
    assert right.mean() > 0.95
    assert model.accuracy[0] == max(model.accuracy)


def test_quality_on_labelled_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality_report(docs, sample=1000).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    clean, junk = scored[scored.quality == 1], scored[scored.quality == 0]
    assert clean.kept.mean() > 0.98
    assert junk.kept.mean() < 0.1
    again = quality_report(docs.repartition(3), sample=1000).toPandas().set_index("doc_id").score
    assert np.allclose(again[scored.doc_id], scored.score, atol=1e-3)


def test_quality_edge_cases(spark):
    rows = [(i, f"This is a plain sentence, number {i}. It ends here.", "c") for i in range(60)]
    rows += [(100, None, "c"), (101, "", "c"), (102, "###@@@ $$$$ %%%%% ^^^^ " * 30, None), (3, rows[3][1], "c"), (None, rows[4][1], "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _score string")
    got = [(r.doc_id, r.kept) for r in quality_report(df).collect()]
    assert len(got) == len(rows)
    assert dict(got)[100] is False and dict(got)[101] is False and dict(got)[102] is False
    assert sum(kept for _, kept in got) == 62
    kept = keep_clean(df)
    assert kept.columns == df.columns and kept.count() == 62
    empty = df.limit(0)
    assert quality_report(empty).collect() == [] and keep_clean(empty).collect() == []
    assert not any(r.kept for r in quality_report(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect())
    assert all(len(r.pattern) == len(with_votes(df).first().pattern) for r in with_votes(df).collect())


def test_packed_features_keep_numbers_and_order():
    texts = [*(t for t in odd_texts() if t), "the same", "the same"]
    votes = [[i % 3, i % 2] for i in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"text": texts, "pattern": pa.array(votes, pa.list_(pa.int32()))})
    packed = [tuple(b.column(c)[0].as_py() for c in ("pattern", "at", "x")) for b in quality._features(iter([batch]))]
    plain = [(v, *(a.tolist() for a in sparse(quality.text_features(t.encode())))) for t, v in zip(texts, votes, strict=True)]
    unpacked = [tuple(np.frombuffer(v, k).tolist() for v, k in zip(r, ("u1", ">i4", ">f4"), strict=True)) for r in sorted(packed)]
    assert unpacked == sorted(plain)


def test_sample_reaches_the_driver_as_bytes(spark):
    rng = random.Random(6)
    texts = ["".join(chr(rng.randrange(32, 127)) for _ in range(6000)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    tracemalloc.start()
    weights = quality.fit_scorer(df)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert weights is not None
    # About 3,500 features a text, of 8 bytes packed and 70 as objects; the matrix takes 10 MB.
    assert peak < 45_000_000


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_report(docs, sample=100).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and len(got) == docs.count()
    import zlib

    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(got.doc_id, got.held_out))


def test_languages_edge_cases(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der Hund und die Katze ") * 3, "en" if i % 2 else "de", "c") for i in range(60)]
    rows += [(100, None, "en", "c"), (101, " 12 !", "de", "c"), (102, "the dog", None, "c"), (None, "die Katze", "en", "c"), (3, rows[3][1], "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _p string")
    got = language_report(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[100].lang_pred, by[100].score, by[101].lang_pred) == ("und", 0.0, "und")
    assert by[102].lang_pred == "en" and by[None].lang_pred == "de" and by[None].held_out
    nothing = language_report(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language_report(df.limit(0)).collect() == []
    one = language_report(df.filter("lang = 'en' or lang is null")).filter("doc_id < 60").collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_one_versus_one_within_a_family():
    def row(lang, at):
        return lang, [at, 900], [0.8, 0.6]

    rows = [row(lang, at) for at, lang in enumerate(("de", "en", "nl", "fr", "es")) for _ in range(5)]
    model = Hierarchy(rows, {"germanic": ("de", "en", "nl"), "romance": ("fr", "es")})
    assert model.names == ["germanic", "romance"]
    assert [len(model.pairs[n]) for n in model.names] == [3, 1]


def test_every_language_is_learned(spark):
    rng = random.Random(5)
    names = [f"l{i:02}" for i in range(70)]
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for n in names}
    rows = []
    for k, n in enumerate(names):
        # The last languages are the least frequent ones, and half of their rows cannot be read.
        for i in range(14 if k < 64 else 10):
            rows.append((100 * k + i, " ".join(rng.choice(words[n]) for _ in range(30)), n))
        rows += [(100 * k + 50 + i, "12 !", n) for i in range(40 if k >= 68 else 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.lang_pred for r in language_report(df, sample=5).collect()}
    readable = [r for r in rows if r[1] != "12 !"]
    assert {got[i] for i, _, _ in readable} == set(names)
    assert sum(got[i] == n for i, _, n in readable) > 0.97 * len(readable)


def test_family_machines_see_the_whole_sample(monkeypatch):
    from tideline.llm import langid

    seen, fit = [], langid.fit_svm
    monkeypatch.setattr(langid, "fit_svm", lambda m, *rest: seen.append(m.shape[0]) or fit(m, *rest))
    rows = [(f"l{k:02}", [k, 900], [0.8, 0.6]) for k in range(12) for _ in range(60)]
    Hierarchy(rows, {})
    assert seen == [len(rows)] * 12
