import random

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import near_texts
from tideline.llm.components import components
from tideline.llm.near_texts import alike, drop_near_duplicates
from tideline.llm.simhash import Forest, compare_groups


def shingles(text, k=5):
    w = (text or "").lower().split()
    return frozenset(" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def similar(a, b):
    return not (a or b) or len(a & b) >= 0.8 * len(a | b) - 1e-9


def kept(rows):
    """Rows that stay, by comparing all pairs."""
    unique = list(dict.fromkeys(rows))
    sets = [shingles(r[1]) for r in unique]
    label = list(range(len(unique)))
    for i in range(len(unique)):
        for j in range(i):
            if label[i] != label[j] and similar(sets[i], sets[j]):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    groups = {}
    for r, x in zip(unique, label):
        groups.setdefault(x, []).append(r)
    return {min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()}


def test_alike_equals_sets():
    rng = random.Random(1)
    sets = [np.unique([rng.randrange(40) for _ in range(rng.choice([0, 5, 30]))]).astype(np.int64) for _ in range(40)]
    got = alike(sets, 0.6)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            a_, b_ = set(a.tolist()), set(b.tolist())
            assert got[i, j] == (len(a_ & b_) >= 0.6 * len(a_ | b_))


@pytest.mark.parametrize("tile_shingles", [800, 200_000])
def test_near_texts_equal_brute_force(spark, tile_shingles):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(150):
        if rows and rng.random() < 0.7:
            w = (rng.choice(rows)[1] or "x").split() or ["x"]
            for _ in range(rng.choice([0, 1, 1, 2, 5, 12])):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.choice([1, 4, 60, 300, 500]))]
        rows.append((i, " ".join(w), "clash", "clash"))
    rows += [(500, None, "c", "c"), (501, " ", "c", "c"), rows[5], rows[5], (None, "quite alone here", "c", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string, label string").repartition(4)
    got = drop_near_duplicates(df, tile=16, tile_shingles=tile_shingles)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) == kept(rows)


@pytest.mark.parametrize("times", [1, 5, 20, 100])
def test_repeated_lines_equal_brute_force(spark, times):
    rng = random.Random(times)
    words = [f"w{i}" for i in range(50_000)]
    rows = []
    for i in range(60):
        body, line = ([rng.choice(words) for _ in range(n)] for n in (200, 10))
        rows += [(2 * i, " ".join(body + line)), (2 * i + 1, " ".join(body + line * times))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in drop_near_duplicates(df).collect()} == kept(rows)


def test_proofs_refuse_no_pair_with_the_similarity():
    rng = np.random.default_rng(3)
    could = near_texts.may_be_alike(0.8)
    for n in (0, 1, 4, 8, 40, 300, 3000):
        for _ in range(200):
            hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            # As few of all shingles shared as the similarity allows, the others dealt at random.
            shared = -(-4 * n // 5)
            cut = int(rng.integers(shared, n + 1))
            a, b = hashes[:cut], np.concatenate([hashes[:shared], hashes[cut:]])
            assert could(near_texts.proof(a)[None], near_texts.proof(b)[None]).all()
    strangers = np.stack([near_texts.proof(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(200)])
    assert not could(strangers[:100], strangers[100:]).any()


def test_strangers_within_the_radius_are_no_family(spark, monkeypatch):
    """Only texts with a near copy have their shingles compared, however many strangers are within the radius."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(200))) for i in range(120)]
    rows += [(1000 + i, rows[i][1] + " one more") for i in range(10)]
    compared = []
    numbered = near_texts.running
    monkeypatch.setattr(near_texts, "running", lambda df, *more: compared.append(df.count()) or numbered(df, *more))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # Any two texts are within this radius.
    got = {r.doc_id for r in drop_near_duplicates(df, radius=128).collect()}
    assert got == set(range(120)) == kept(rows)
    assert compared == [20]


@pytest.mark.parametrize("group_rows", [1, 40, 1 << 18])
def test_groups_of_tiles_equal_brute_force(spark, group_rows):
    rng = random.Random(group_rows)
    fps = [rng.getrandbits(128) for _ in range(60)]
    while len(fps) < 160:
        x = rng.choice(fps)
        for _ in range(rng.randrange(12)):
            x ^= 1 << rng.randrange(128)
        fps.append(x)
    fps = list(dict.fromkeys(fps))
    color = [rng.randrange(2) for _ in fps]
    words = [[int(np.uint64(x >> 64 * k & (1 << 64) - 1).view(np.int64)) for k in (0, 1)] for x in fps]
    rows = [(i, w, [c]) for i, (w, c) in enumerate(zip(words, color))]
    df = spark.createDataFrame(rows, "node long, fp array<long>, proof array<long>")

    def same_color(a, b):
        return a[:, 0] == b[:, 0]

    for could, fits in ((None, lambda i, j: True), (same_color, lambda i, j: color[i] == color[j])):
        label = list(range(len(fps)))
        for i in range(len(fps)):
            for j in range(i):
                if label[i] != label[j] and fits(i, j) and (fps[i] ^ fps[j]).bit_count() <= 8:
                    label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
        source = df if could else df.drop("proof")
        got = components(near_texts.links(source, 8, tile=3, could=could, group_rows=group_rows)).collect()
        sizes = {x: label.count(x) for x in label}
        assert sorted(map(tuple, got)) == [(i, x) for i, x in enumerate(label) if sizes[x] > 1]


def test_sizes_that_fit_are_all_compared():
    rng = random.Random(4)
    for _ in range(5):
        tiles = []
        for n in (1, 37, 150):
            sizes = sorted(rng.choice([0, 1, 4, 5, 8, 10, 100, 125, rng.randrange(300)]) for _ in range(n))
            tile = {"p": 5, "lo": np.zeros(4, int), "hi": np.full(4, 9), "nodes": np.arange(n) + 1000 * len(tiles)}
            tiles.append((tile, np.array(sizes)[:, None]))
        batch = [
            {"deal": 0, "g": k, **t, "fps": np.zeros(2 * len(z), int), "proofs": z[::-1].reshape(-1)}
            for k, (t, z) in enumerate(tiles[1:])
        ]
        run = compare_groups(0, lambda a, b: np.minimum(a, b)[:, 0] >= 0.8 * np.maximum(a, b)[:, 0], 0.8)
        got = [e for b in run(iter([pa.RecordBatch.from_pylist(batch)])) for e in zip(*b.to_pydict().values())]
        size = {int(x): int(z) for t, zs in tiles[1:] for x, z in zip(t["nodes"], zs[::-1, 0])}
        left, right = (t["nodes"].tolist() for t, _ in tiles[1:])
        want = Forest(5000)
        want.add(*np.array([(x, y) for x in left for y in right if min(size[x], size[y]) >= 0.8 * max(size[x], size[y])]).T)
        found = Forest(5000)
        found.add(*np.array(got).T)
        assert (want.label == found.label).all()


def test_nothing(spark):
    assert drop_near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
