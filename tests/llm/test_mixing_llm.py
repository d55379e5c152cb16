import random
import re

import pytest

from tideline.llm.mixing import mix, mix_report, schedule, source_targets

SCHEMA = "doc_id long, source string, text string, size string, group string"


def water(sizes, weights=(1.0, 2.0, 3.0), repeats=3):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = float(sum(sizes.values())), [s for s in names]
    while left > 1e-9 and open_:
        whole = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / whole
        left = sum(max(0.0, target[s] - repeats * sizes[s]) for s in names)
        target = {s: min(t, repeats * sizes[s]) for s, t in target.items()}
        open_ = [s for s in open_ if target[s] < repeats * sizes[s]]
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(400):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "Z", "tiny", None])
        n = rng.choice([0, 1, 5, 40, 300]) if source != "tiny" else 2
        text = rng.choice(["", " \n"]) + "\t ".join(f"w{rng.randrange(99)} x" for _ in range(n))
        out.append((i, source, text, "clash", "clash"))
    return out + [(3, "a", "same words here", "c", "c")] * 4 + [(None, "b", None, None, None), (None, None, "x y", None, None)]


@pytest.mark.parametrize("slots", [50, 2000, 1 << 18])
def test_mix_comes_near_its_targets(spark, rows, slots):
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = water(sizes)
    got = [r.asDict() for r in mix_report(df, slots=slots).collect()]
    assert len(got) == len(rows)
    again = [r.asDict() for r in mix_report(df.repartition(2), slots=slots, rows_per_bucket=1).collect()]
    assert sorted(map(str, got)) == sorted(map(str, again))
    by_size = {sizes[s]: s for s in sizes}
    assert len(by_size) == len(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, words(r[2])) for r in rows)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 or (target[s] > 0 and taken[s] == 1)


def whole_documents(report, emitted, rows, sizes):
    """Emitted rows are whole; a source is off what the report takes by half a document at most, or by its only one."""
    texts = {(r[0], r[1]): r[2] for r in rows}
    source = {r[0]: r[1] for r in rows}
    copies, words_of, taken = {}, dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in emitted:
        assert r.text == texts[r.doc_id, r.source] and words(r.text) > 0
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        words_of[r.source] += words(r.text)
    off = 0
    for r in report:
        taken[source[r.doc_id]] += r.taken
        if r.taken % max(1, r.size):  # the document at which its source's quota ends
            off += 1
        else:
            assert copies.get(r.doc_id, 0) == r.taken // max(1, r.size)
    assert off <= len(sizes)
    for s in sizes:
        longest = max(words(r[2]) for r in rows if r[1] == s)
        assert abs(words_of[s] - taken[s]) <= longest / 2 or words_of[s] <= longest
        assert (words_of[s] > 0) == (taken[s] > 0)


def test_emitted_rows_are_whole_documents(spark, rows):
    rows = [r for r in rows if r[0] not in (3, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix(df, slots=500, bucket_bytes=1000)
    assert out.columns == df.columns
    whole_documents(mix_report(df, slots=500).collect(), out.collect(), rows, {r[1]: 0 for r in rows})


def test_schedule_ranks_every_slot(spark, rows):
    sizes = spark.createDataFrame([("0a", 100), ("0b", 5000), ("0c", 3), ("1", 0)], "group string, source_size long")
    got = schedule(source_targets(sizes), 5000).collect()
    assert sorted(r.slot for r in got) == list(range(5000))
    ranks = {}
    for r in sorted(got, key=lambda r: r.slot):
        assert r["rank"] == ranks.get(r.group, 0)
        ranks[r.group] = r["rank"] + 1
    assert "1" not in ranks


def test_no_rows_and_no_words(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix_report(df).collect() == [] and mix(df).collect() == []
    df = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mix_report(df).collect()] == [(0, 0.0, 0)] * 2
    assert mix(df).collect() == []


def test_tiny_sources_beside_a_huge_one(spark):
    rng = random.Random(7)
    rows = [(i, "huge", "word " * 4000) for i in range(50)]
    sizes = {"huge": 200_000}
    for k in range(60):
        lengths = [rng.choice([1, 2, 7, 40, 300]) for _ in range(rng.choice([1, 1, 2, 5]))]
        sizes[f"s{k:02}"] = sum(lengths)
        rows += [(1000 + 10 * k + j, f"s{k:02}", "x\t" * n) for j, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    target = water(sizes)
    source = {r[0]: r[1] for r in rows}
    # Blocks of about 10,000 words, as in a corpus of billions of words.
    report = mix_report(df, slots=20).collect()
    taken = dict.fromkeys(sizes, 0)
    for r in report:
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and (r.first_slot is not None) == (r.taken > 0)
    whole_documents(report, mix(df, slots=20).collect(), rows, sizes)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 or taken[s] == 1


def test_emitted_rows_come_in_the_order_of_the_schedule(spark, monkeypatch):
    from tideline.llm import mixing

    monkeypatch.setattr(mixing, "RUN_BYTES", 100_000, raising=False)
    rows = [(i, "abc"[i % 3], f"w{i} " * 50) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mix(df, slots=2000)
    assert mixed.rdd.getNumPartitions() > 2
    got = mixed.collect()
    assert [r.doc_id for r in mix(df.repartition(7), slots=2000).collect()] == [r.doc_id for r in got]
    # Weights 1, 2 and 3: any run of rows holds the sources in proportion.
    for first in range(0, len(got) - 60, 20):
        some = [r.source for r in got[first : first + 60]]
        assert all(abs(some.count(s) - due) <= 4 for s, due in (("a", 10), ("b", 20), ("c", 30)))
