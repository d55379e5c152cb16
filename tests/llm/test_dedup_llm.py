import hashlib
import random

import numpy as np
import pytest
import xxhash

from tideline.llm import components as components_module
from tideline.llm.components import components
from tideline.llm.exact_dedup import content_classes, dedup, dedup_report
from tideline.llm.simhash import fingerprint, near_duplicates, simhash_report, tile_links

DOCS = "doc_id long, text string, lang string, source string"


def brute_dedup(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(text or "", []).append((doc_id is not None, doc_id or 0, -i, doc_id))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        members = groups[text or ""]
        best = max(members)
        out.append((doc_id, best[3], len(members), best[2] == -i, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table_bytes", [1, 3000, 64 << 20])
def test_exact_dedup_equals_brute_force(spark, table_bytes):
    rng = random.Random(5)
    texts = [f"text {i} " + "x" * (i % 50) for i in range(60)] + ["", None, "é", "y" * 200_000]
    rows = [(i, "hot" if rng.random() < 0.35 else rng.choice(texts)) for i in range(600)]
    rows += [(7, "hot")] * 3 + [(None, "hot"), (None, "alone"), (None, "alone"), (900, "twice"), (900, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((tuple(r) for r in dedup_report(df, table_bytes).collect()), key=str)
    assert got == brute_dedup(rows)


def test_levels_grow_with_the_logarithm_of_the_bytes(spark):
    """One bucket that overflows is split ever finer: 64 times the texts take a level more or two."""
    levels = {}
    for n in (40, 160, 640, 2560):
        seen = []
        df = spark.range(n).selectExpr("id AS doc_id", f"repeat(concat('text ', id % {n * 9 // 10}), 20) AS text").repartition(3)
        got = content_classes(df, table_bytes=1000, buckets=1, watch=lambda level, left: seen.append(left))
        rows = got.collect()
        assert len(rows) == n * 9 // 10 and sum(r.group_size for r in rows) == n
        assert seen[-1] == 0 and seen == sorted(seen, reverse=True)
        levels[n] = len(seen)
    assert levels[160] <= levels[40] + 1 and levels[2560] <= levels[40] + 2, levels


def test_exact_dedup_keeps_columns_and_one_row_per_class(spark):
    rows = [(1, "a", "en", "s"), (5, "a", "de", "t"), (5, "a", "de", "t"), (2, None, None, None), (None, "b", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sha string, _keep string")
    assert sorted(map(tuple, dedup(df).collect()), key=str) == sorted(
        [(5, "a", "de", "t"), (2, None, None, None), (None, "b", "x", "y")], key=str
    )


def test_empty_tables(spark):
    df = spark.createDataFrame([], DOCS)
    assert dedup_report(df).collect() == []
    assert dedup(df).collect() == []
    assert simhash_report(df).collect() == []


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(500)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(200)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, find(x)) for x in linked)


def test_components_stop_at_stars(spark, monkeypatch):
    rounds = []
    step = components_module._large_star
    monkeypatch.setattr(components_module, "_large_star", lambda e: rounds.append(1) or step(e))
    stars = [(1, i) for i in range(2, 40)] + [(100, 101), (-7, -6), (-6, -7)]
    got = components(spark.createDataFrame(stars, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted(
        [(i, 1) for i in range(1, 40)] + [(100, 100), (101, 100), (-7, -7), (-6, -7)]
    )
    assert not rounds
    path = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert sorted(map(tuple, components(path).collect())) == [(1, 1), (2, 1), (3, 1)]
    assert len(rounds) == 1
    with pytest.raises(RuntimeError):
        components(path, max_rounds=0)


def plain_fingerprint(text, words):
    w = text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    rng = random.Random(3)
    vocabulary = ["A", "bÉ", "c d", "\x1c", "e"]
    for n in [0, 1, 3, 4, 5, 200]:
        text = rng.choice(["", " "]) + "\t\n".join(rng.choice(vocabulary) for _ in range(n)) + " "
        assert fingerprint(text.encode(), 4) == plain_fingerprint(text, 4)
    df = spark.createDataFrame([(1, "One two THREE four five"), (2, None), (3, " ")], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in simhash_report(df).collect()}
    assert got == {1: f"{plain_fingerprint('one two three four five', 4):016x}", 2: "0" * 16, 3: "0" * 16}
    spark_hash = spark.sql("select xxhash64('one two') as h").first().h
    assert spark_hash % (1 << 64) == xxhash.xxh64_intdigest(b"one two", 42)


def clusters(fps, radius):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return label


@pytest.mark.parametrize("size", [3, 70, 300])
def test_tile_links_connect_what_is_near(size):
    rng = random.Random(size)
    seeds = [rng.getrandbits(64) for _ in range(5)]
    fps = list({rng.choice(seeds) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for _ in range(size)})
    whole = np.array(fps, np.uint64).view(np.int64)
    half = len(fps) // 2
    second = [(a + half, b + half) for a, b in tile_links(whole[half:], None, 4)]
    forest = tile_links(whole[:half], whole[half:], 4) + tile_links(whole[:half], None, 4) + second
    label = list(range(len(fps)))
    for a, b in forest:
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    assert label == clusters(fps, 4)
    assert len(forest) <= 3 * len(fps)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            if w:
                for _ in range(rng.randrange(3)):
                    w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.choice([0, 2, 30, 300]))]
        rows.append((i, " ".join(w)))
    rows += [(200, None), (None, "alone in the world"), (3, rows[3][1]), (None, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    fps = [plain_fingerprint(t or "", 4) for _, t in rows]
    label = clusters(fps, 4)
    least = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            least[x] = min(doc_id, least.get(x, doc_id))
    want = [(d, f - (1 << 64) if f >> 63 else f, least.get(x)) for (d, _), f, x in zip(rows, fps, label)]
    for tile in (4, 8192):
        got = [tuple(r) for r in near_duplicates(df, tile=tile).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
