import hashlib
import re

import corpus_pipeline
from tideline.llm.shared import stored

SF = "/root/testdata/sf0.001"


def shingles(text, k=5):
    w = text.lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), "test")
        seen.append((name, before.toPandas(), docs.toPandas()))
        assert docs.columns == columns or name == "byte-level BPE"
    (_, before, clean), (_, _, unique), (_, _, apart), (_, _, mixed), (_, _, tokens) = seen
    assert 0.5 * len(before) < len(clean) < len(before)
    best = clean.groupby("text").doc_id.max()
    assert sorted(unique.doc_id) == sorted(best)
    # The near duplicates by comparing all pairs.
    rows = sorted(zip(unique.doc_id, unique.text))
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert sorted(apart.doc_id) == [rows[i][0] for i in sorted(set(label))]
    size = {i: len(t.split()) for i, t in zip(apart.doc_id, apart.text)}
    copies = mixed.groupby("doc_id").size()
    assert copies.max() <= 3 and set(copies.index) <= set(apart.doc_id)
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in mixed.text)
    assert abs(taken - sum(size.values())) < 0.02 * sum(size.values())
    # Documents come whole, with all their columns.
    whole = {i: t for i, t in zip(apart.doc_id, apart.text)}
    assert all(whole[i] == t for i, t in zip(mixed.doc_id, mixed.text))
    assert (mixed.n_chars == mixed.text.str.len()).all()
    want = sorted(hashlib.sha256(t.encode()).hexdigest() for t in mixed.text)
    assert sorted(tokens.decoded_sha256) == want


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() > 0
