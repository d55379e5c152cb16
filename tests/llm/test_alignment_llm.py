"""Cross-tokenizer alignment: byte by byte in plain Python, fragments in any bracketing, long texts over several tasks."""

import hashlib
import json
import random
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers as tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tideline.llm.alignment import Aligner, Fragment, align, alignment_report, spans

A, B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


@cache
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


@cache
def a_names():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = dict(zip(map(chr, visible), visible)) | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in visible)}
    vocab = json.load(open(A))["model"]["vocab"]
    return {i: bytes(shown[c] for c in t) for t, i in vocab.items()}


def brute(text):
    """(a, b, groups, links) of one text, from byte positions alone."""
    a, b = models()
    if not text:
        return None
    data = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelt = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        spelt.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    named = [a_names()[i] for i in ids_a]
    if b"".join(named) != data or b"".join(spelt) != data:
        return None
    at_a = [k for k, n in enumerate(named) for _ in n]
    at_b = [k for k, n in enumerate(spelt) for _ in n]
    links = list(dict.fromkeys(zip(at_a, at_b)))
    ends = [p for p in range(len(data)) if all(p + 1 == len(data) or at[p] != at[p + 1] for at in (at_a, at_b))]
    groups, last = [], -1
    for p in ends:
        left, right = (
            ",".join(str(ids[k]) for k in dict.fromkeys(at[last + 1 : p + 1])) for ids, at in ((ids_a, at_a), (ids_b, at_b))
        )
        groups.append(f"{left}|{right}")
        last = p
    return ids_a, ids_b, groups, [(ids_a[x], ids_b[y]) for x, y in links]


def report(texts):
    found = [brute(t) for t in texts]
    docs = Counter(pair for f in found if f for pair in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for f in found:
        if not f:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(docs[x] == most[x[0]] for x in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(docs[x] for x in links), sha))
    return out


def texts():
    rng = random.Random(5)
    words = ["the", "of", "naïve", "日本語", "\U0001f600", "  ", "\n", "\t ", "don't", "1234567", " ", "_x_", "<|endoftext|>", "<s>", "　", "\x1c", "Schiffahrt", "é"]
    some = [None, "", " ", "  ", "a ", " a", "▁", "a ▁b", "a▁ b", "\x00", "<0x41>", "x" * 300, "a  b\n\n c   d", "ends　 here", "  x"]
    some += ["".join(rng.choice([" ", "", " "]) + rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    return some + ["same words here"] * 5 + [" ".join(rng.choice(words) for _ in range(4000))]


def test_report_equals_plain_python(spark):
    some = texts()
    want = report(some)
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(5)
    for range_bytes in (1 << 16, 64):
        got = {r[0]: tuple(r[1:]) for r in alignment_report(df, A, B, range_bytes=range_bytes).collect()}
        assert [got[i] for i in range(len(some))] == want


def test_spans_join_to_the_text():
    for t in texts():
        if t:
            assert " ".join(spans(t)) == t


def test_fragments_compose_in_any_order():
    held = Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    rng = random.Random(2)
    text = " ".join(rng.choice(["Überraschung", "tokenizers", "a", "zzzzqqqq", "日本語テキスト"]) for _ in range(60))
    want = brute(text)
    for size in (3, 7, 50, 10_000):
        parts = [f for *_, f in held.fragments(text, 0, size)]
        assert size > 100 or any(f.head[0] or f.tail[0] for f in parts)
        for _ in range(3):
            some = list(parts)
            while len(some) > 1:
                i = rng.randrange(len(some) - 1)
                some[i : i + 2] = [some[i] + some[i + 1]]
            whole = some[0].closed()
            assert whole.groups == want[2] or ";".join(whole.groups) == ";".join(want[2])
            assert whole.pairs == Counter(a << 32 | b for a, b in want[3])
            assert (whole.n_a, whole.n_b, whole.n_groups) == (len(want[0]), len(want[1]), len(want[2]))
    assert Fragment() + parts[0] == parts[0]


def test_columns_pass_and_empty_tables(spark):
    rows = [(None, "a text", "clash", 1), (3, None, None, 2), (3, "long " * 40, "x", 3), (3, "long " * 40, "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string, part int")
    got = align(df, A, B, range_bytes=50)
    assert got.columns == ["doc_id", "text", "part", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"]
    found = sorted((r.part, r.n_a, r.n_groups) for r in got.collect())
    assert [f[0] for f in found] == [1, 2, 3, 3] and found[1][1] == 0 and found[2] == found[3] and found[2][1] >= 40
    assert alignment_report(df.limit(0), A, B).collect() == []


def test_texts_that_are_not_utf8_have_no_tokens(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    row = alignment_report(df, A, B).first()
    assert (row.n_a, row.groups_sha256) == (0, "")


@pytest.mark.parametrize("size", [1, 5])
def test_one_long_span(spark, size):
    df = spark.createDataFrame([(1, "ab\n" * 3000 * size)], "doc_id long, text string")
    row = alignment_report(df, A, B, range_bytes=1000).first()
    assert tuple(row[1:]) == report(["ab\n" * 3000 * size])[0]
