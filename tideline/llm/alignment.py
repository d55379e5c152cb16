"""Alignment of two tokenizers' tokens of the same text, and which tokens go together corpus-wide.

Tokenizer A is a byte-level BPE of the ``tokenizers`` library, read from its
JSON; B is a ``sentencepiece`` model. Both read a text with a blank before it.
Where a token of A and one of B end at the same byte, a group ends. Tokens
whose byte ranges overlap are linked.

Fragments. A stretch of a text gives a fragment: an open prefix (tokens up to
the first common end), closed groups, and an open suffix (tokens behind the last common end).
Fragments of neighbours compose: the suffix of the left one and the prefix of
the right one close a group. Composition is associative, so a long text is cut
to spans that tasks tokenize by themselves, each span to fragments by fixed
byte ranges, and the fragments are composed ``FAN`` at a time, level by level,
grouped by (document, byte range): no task sees more than a level's share of a
document until the last one puts its row together. Shorter texts are one fragment.

Spans. A blank behind a character that is neither white space nor U+2581
starts a new span: A's pattern never matches across it, and no piece of B has
U+2581 behind another character (checked when the model is loaded; otherwise a
text is one span). So both tokenizers treat spans independently, and a worker
remembers the alignment of the last ones it has seen.

NULL or empty texts, and texts that the tokens of A or B do not spell byte by
byte in each span (B reads U+2581 as a blank), have no tokens: zeros and ''. Repeated rows
align alike and count as documents of their own; other columns pass through,
whatever their names (those named like results are replaced). An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import measured_join, own_names, stored

#: Bytes of a range whose tokens make one fragment; longer texts are cut.
RANGE_BYTES = 1 << 16
#: Fragments' ranges that one task composes.
FAN = 16
#: Spans that are aligned together, and those of them that are tokenized as one text.
SPANS = 10_000
RUN_SPANS = 500
#: Spans whose alignment a worker remembers; when there are more, it starts over.
REMEMBERED = 150_000
#: Characters of texts that are aligned together.
PORTION_CHARS = 1 << 19

BLANK = "▁"
#: A blank that starts no span, as white space or U+2581 precedes it.
INNER_BLANK = re.compile(rf"[\s{BLANK}] ")
PAIR = "array<struct<pair:bigint,n:int>>"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs")
RESULT_TYPES = dict.fromkeys(COLUMNS, "bigint") | {"groups": "string", "pairs": PAIR}
RESULT = "struct<" + ",".join(f"{c}:{kind}" for c, kind in RESULT_TYPES.items()) + ">"
TOKENS = "array<struct<id:int,end:bigint>>"
FRAGMENT = (
    f"doc bigint, part bigint, at bigint, fits boolean, cut boolean, n_a bigint, n_b bigint, n_groups bigint, groups string, "
    f"pairs {PAIR}, head_a {TOKENS}, head_b {TOKENS}, tail_a {TOKENS}, tail_b {TOKENS}"
)

Token = tuple[int, int]  # id and the byte where it ends


def spans(text: str) -> list[str]:
    """The spans of a blank and ``text``, each without the blank that starts it."""
    parts = text.split(" ")
    if not INNER_BLANK.search(text) and not text.startswith(" "):
        return parts
    out, held = [], None
    for i, part in enumerate(parts):
        held = part if held is None else f"{held} {part}"
        if i == len(parts) - 1 or (held and not held[-1].isspace() and held[-1] != BLANK):
            out.append(held)
            held = None
    return out


def pair_up(a: list[Token], b: list[Token]) -> tuple[list[str], list[int], int, int]:
    """Groups and links of tokens that start at the same byte, and how many tokens of each they use."""
    groups, links, done, i, j, from_i, from_j = [], [], 0, 0, 0, 0, 0
    while i < len(a) and j < len(b):
        (x, end_a), (y, end_b) = a[i], b[j]
        links.append(x << 32 | y)
        if end_a == end_b:
            i, j = i + 1, j + 1
            left, right = (",".join(str(t[0]) for t in some) for some in (a[from_i:i], b[from_j:j]))
            groups.append(f"{left}|{right}")
            from_i, from_j, done = i, j, len(links)
        elif end_a < end_b:
            i += 1
        else:
            j += 1
    return groups, links[:done], from_i, from_j


@dataclass
class Fragment:
    """What a stretch of a text knows of its alignment; without a common end, all its tokens are the head."""

    fits: bool = True
    cut: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    groups: list[str] = field(default_factory=list)
    pairs: Counter = field(default_factory=Counter)
    head: tuple[list[Token], list[Token]] = ((), ())
    tail: tuple[list[Token], list[Token]] = ((), ())

    @classmethod
    def of(cls, a: list[Token], b: list[Token], fits: bool = True) -> Fragment:
        """The fragment of the tokens that end in a stretch."""
        common = {end for _, end in a} & {end for _, end in b}
        if not common:
            return cls(fits, False, len(a), len(b), head=(a, b))
        first = min(common)
        i, j = (bisect_left(some, first, key=lambda t: t[1]) + 1 for some in (a, b))
        groups, links, k, m = pair_up(a[i:], b[j:])
        return cls(
            fits, True, len(a), len(b), len(groups), groups, Counter(links), (a[:i], b[:j]), (a[i + k :], b[j + m :])
        )

    def __add__(self, other: Fragment) -> Fragment:
        fits, n_a, n_b = self.fits and other.fits, self.n_a + other.n_a, self.n_b + other.n_b
        if not self.cut:
            head = tuple([*x, *y] for x, y in zip(self.head, other.head, strict=True))
            return Fragment(fits, other.cut, n_a, n_b, other.n_groups, other.groups, other.pairs, head, other.tail)
        open_ = tuple([*x, *y] for x, y in zip(self.tail, other.head, strict=True))
        if not other.cut:
            return Fragment(fits, True, n_a, n_b, self.n_groups, self.groups, self.pairs, self.head, open_)
        groups, links, *_ = pair_up(*open_)
        return Fragment(
            fits,
            True,
            n_a,
            n_b,
            self.n_groups + len(groups) + other.n_groups,
            [*self.groups, *groups, *other.groups],
            self.pairs + Counter(links) + other.pairs,
            self.head,
            other.tail,
        )

    def closed(self) -> Fragment:
        """The same for a whole text, whose start is a common end too."""
        return Fragment(cut=True) + self


@dataclass
class Alignments:
    """Of each text: (n_a, n_b, n_groups, n_links) and groups; of all together: pairs, their links, and where a text's end."""

    totals: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    n: np.ndarray
    ends: np.ndarray

    def array(self, digest: bool) -> pa.StructArray:
        items = pa.StructArray.from_arrays([pa.array(self.pairs), pa.array(self.n.astype(np.int32))], ["pair", "n"])
        ends = pa.array(np.concatenate([[0], self.ends]).astype(np.int32))
        return pa.StructArray.from_arrays(
            [*map(pa.array, self.totals.T.copy()), pa.array(map(line_digest, self.groups) if digest else self.groups, pa.string()), pa.ListArray.from_arrays(ends, items)],
            list(COLUMNS),
        )


def line_digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible ones for themselves, then U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_bytes(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode()


class Aligner:
    def __init__(self, a_json: str, b_model: bytes) -> None:
        # Spark runs a task per core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        spelt = {
            i: bytes(map(alphabet.__getitem__, token)) if set(token) <= alphabet.keys() else token.encode()
            for token, i in self.a.get_vocab().items()
        }
        self.a_bytes = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        self.b_bytes = [piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in some], np.int64) for some in (self.a_bytes, self.b_bytes))
        # An id with the mark behind it: a comma, or what ends the tokens of A or of the group.
        self.a_marked, self.b_marked = (
            [f"{i}{mark}" for i in range(n) for mark in (",", last)]
            for n, last in ((len(self.a_bytes), "|"), (len(self.b_bytes), ";"))
        )
        self._forget()
        self.splits = not any(BLANK in self.b.id_to_piece(i).lstrip(BLANK) for i in range(self.b.get_piece_size()))

    def spans(self, text: str) -> list[str]:
        return spans(text) if self.splits else [text]

    def tokens(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B, all spans behind each other, bytes of each span, and whether both spell it; none if not."""
        closed = [bool(s) and not s[-1].isspace() and s[-1] != BLANK for s in some]
        runs, i = [], 0  # spans that are tokenized as one text
        while i < len(some):
            j = i + 1
            while closed[j - 1] and self.splits and j < min(len(some), i + RUN_SPANS):
                j += 1
            runs.append((i, j))
            i = j
        size = np.fromiter((len(s.encode()) for s in some), np.int64, len(some)) + 1
        fits = np.ones(len(some), bool)
        ids: tuple[list[int], list[int]] = ([], [])
        for (i, j), x, y, spelt in zip(runs, *self._encode([" ".join(some[i:j]) for i, j in runs]), strict=True):
            alone = [(i, x, y, spelt)]
            if not spelt and j - i > 1:
                alone = zip(range(i, j), *self._encode(some[i:j]), strict=True)
            for k, one, other, good in alone:
                if good:
                    ids[0].extend(one)
                    ids[1].extend(other)
                else:
                    fits[k], size[k] = False, 0
        return *(np.array(x, np.int64) for x in ids), size, fits

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A and B for a blank and each text, and whether both spell it."""
        data = [f" {t}" for t in texts]
        a = [e.ids for e in self.a.encode_batch(data, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        return a, b, [
            b"".join([self.a_bytes[i] for i in x]) == d.encode() == b"".join([self.b_bytes[i] for i in y])
            for x, y, d in zip(a, b, data, strict=True)
        ]

    def whole(self, texts: list[str]) -> Alignments:
        """The alignments of whole texts."""
        parts = [self.spans(t) if t else [] for t in texts]
        self._learn(dict.fromkeys(chain.from_iterable(parts)))
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64)
        size = np.array([len(some) for some in parts], np.int64)
        text_of = np.repeat(np.arange(len(texts)), size)
        whole = size > 0
        whole[text_of[~self.fits[at]]] = False
        at, text_of = at[whole[text_of]], text_of[whole[text_of]]
        counts = self.counts[at]
        totals = np.stack([np.bincount(text_of, c, len(texts)) for c in counts.T], axis=1).astype(np.int64)
        n_links = counts[:, 3]
        place = np.repeat(self.first[at] - (np.cumsum(n_links) - n_links), n_links) + np.arange(n_links.sum())
        # A text's links, each as text * pairs + pair.
        pairs = len(self.pair_number) or 1
        held, n = np.unique(np.repeat(text_of, n_links) * pairs + self.links[place], return_counts=True)
        ends = np.searchsorted(held, np.arange(1, len(texts) + 1) * pairs)
        ids = np.fromiter(self.pair_number, np.int64, len(self.pair_number))
        at, lines, i = at.tolist(), [], 0
        for k in np.bincount(text_of, minlength=len(texts)).tolist():
            lines.append(";".join([self.groups[j] for j in at[i : i + k]]))
            i += k
        return Alignments(totals, lines, ids[held % pairs] if len(ids) else ids, n, ends)

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.fits, self.counts = np.zeros(0, bool), np.zeros((0, 4), np.int64)
        self.first, self.links = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pair_number: dict[int, int] = {}

    def _learn(self, some: dict[str, None]) -> None:
        """Align the spans that are not remembered."""
        new = [s for s in some if s not in self.number]
        if len(self.number) + len(new) > REMEMBERED:
            self._forget()
            new = list(some)
        if not new:
            return
        self.number.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        counts, links, fits = [self.counts], [self.links], [self.fits]
        for i in range(0, len(new), SPANS):
            count, pairs, groups, fit = self._align(new[i : i + SPANS])
            ids, which = np.unique(pairs, return_inverse=True)
            numbers = [self.pair_number.setdefault(p, len(self.pair_number)) for p in ids.tolist()]
            links.append(np.array(numbers, np.int32)[which])
            counts.append(count)
            fits.append(fit)
            self.groups += groups
        self.counts, self.links, self.fits = np.concatenate(counts), np.concatenate(links), np.concatenate(fits)
        self.first = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]

    def _align(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Of each span: (n_a, n_b, n_groups, n_links), its pairs one after the other, its groups, and whether it fits."""
        a, b, size, fits = self.tokens(some)
        # Both tokenizers end where a span ends.
        end_a, end_b, span_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(size)
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        twice = ends[1:] == ends[:-1]
        common, ends = ends[1:][twice], np.concatenate([ends[:1], ends[1:][~twice]])
        pairs = a[np.searchsorted(end_a, ends)] << 32 | b[np.searchsorted(end_b, ends)]
        n_a, n_b, n_groups, n_links = (
            np.diff(np.searchsorted(x, span_end, "right"), prepend=0) for x in (end_a, end_b, common, ends)
        )
        # Places of the ids in the line of groups: A's of a group, then B's.
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        until_a, until_b = (np.cumsum(np.bincount(g, minlength=len(common))) for g in (group_a, group_b))
        marked = [""] * (len(a) + len(b))
        for ids, end, names, place in (
            (a, end_a, self.a_marked, np.arange(len(a)) + np.concatenate([[0], until_b])[group_a]),
            (b, end_b, self.b_marked, np.arange(len(b)) + until_a[group_b]),
        ):
            last = np.isin(end, common, assume_unique=True)
            for i, name in zip(place.tolist(), (2 * ids + last).tolist(), strict=True):
                marked[i] = names[name]
        cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        groups = ["".join(marked[i:j])[:-1] for i, j in zip(cuts, cuts[1:], strict=False)]
        return np.stack([n_a, n_b, n_groups, n_links], axis=1), pairs, groups, fits

    def fragments(self, text: str, start: int, range_bytes: int) -> Iterator[tuple[int, int, Fragment]]:
        """(range, first byte, fragment) of a stretch of spans that starts at byte ``start`` of its text."""
        x, y, size, fits = self.tokens(self.spans(text))
        at = start + int(size.sum())
        a, b = (
            list(zip(ids.tolist(), (start + np.cumsum(sizes[ids])).tolist(), strict=True))
            for ids, sizes in ((x, self.a_size), (y, self.b_size))
        )
        fits = bool(fits.all())
        i = j = 0
        for part in range(start // range_bytes, max(at - 1, 0) // range_bytes + 1):
            end = (part + 1) * range_bytes
            k, m = (bisect_left(t, end + 1, key=lambda t: t[1]) for t in (a, b))
            yield part, max(start, part * range_bytes), Fragment.of(a[i:k], b[j:m], fits)
            i, j = k, m


def once_per_process(a_json: str, b_model: bytes) -> Callable[[], Aligner]:
    """One aligner for each Python worker process and pair of models, kept between its tasks."""
    name = "_aligner_" + hashlib.sha256(a_json.encode() + b_model).hexdigest()

    def get() -> Aligner:
        held = getattr(sys, name, None)
        if held is None:
            held = Aligner(a_json, b_model)
            setattr(sys, name, held)
        return held

    return get


def long_spans(data: bytes, range_bytes: int) -> list[tuple[int, str]]:
    """(first byte, text without its first blank) of stretches of about ``range_bytes`` that spans do not cross."""
    out, start, at, size = [], 0, 0, 0
    held: list[str] = []
    for span in spans(data.decode()):
        held.append(span)
        at += 1 + len(span.encode())
        size = at - start
        if size >= range_bytes:
            out.append((start, " ".join(held)))
            held, start = [], at
    if held:
        out.append((start, " ".join(held)))
    return out


def readable(text: bytes | None) -> str:
    """A text, or none if it is not UTF-8."""
    try:
        return (text or b"").decode()
    except UnicodeDecodeError:
        return ""


def _pair_list(pairs: Counter) -> list[tuple[int, int]]:
    return [{"pair": p, "n": n} for p, n in pairs.items()]


def _row(doc: int, part: int, at: int, f: Fragment) -> dict:
    def tokens(some):
        return [{"id": i, "end": e} for i, e in some]

    return {
        "doc": doc,
        "part": part,
        "at": at,
        "fits": f.fits,
        "cut": f.cut,
        "n_a": f.n_a,
        "n_b": f.n_b,
        "n_groups": f.n_groups,
        "groups": ";".join(f.groups),
        "pairs": _pair_list(f.pairs),
        "head_a": tokens(f.head[0]),
        "head_b": tokens(f.head[1]),
        "tail_a": tokens(f.tail[0]),
        "tail_b": tokens(f.tail[1]),
    }


def _fragment(row: dict) -> Fragment:
    def tokens(name):
        return [(t["id"], t["end"]) for t in row[name]]

    return Fragment(
        row["fits"],
        row["cut"],
        row["n_a"],
        row["n_b"],
        row["n_groups"],
        [row["groups"]] if row["groups"] else [],
        Counter({p["pair"]: p["n"] for p in row["pairs"]}),
        (tokens("head_a"), tokens("head_b")),
        (tokens("tail_a"), tokens("tail_b")),
    )


def _fragment_type() -> pa.Schema:
    tokens = pa.list_(pa.struct([("id", pa.int32()), ("end", pa.int64())]))
    pairs = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int32())]))
    kinds = {"fits": pa.bool_(), "cut": pa.bool_(), "groups": pa.string(), "pairs": pairs}
    kinds |= dict.fromkeys(("head_a", "head_b", "tail_a", "tail_b"), tokens)
    names = [c.split()[0] for c in FRAGMENT.split(", ")]
    return pa.schema([(c, kinds.get(c, pa.int64())) for c in names])


def align_column(text: Column, a_json: str, b_model: bytes, digest: bool) -> Column:
    """The alignment of whole texts, given as bytes."""
    load = once_per_process(a_json, b_model)

    @F.arrow_udf(RESULT)
    def align(texts: pa.Array) -> pa.Array:
        held, out, some, size = load(), [], [], 0
        for i, t in enumerate(texts):
            some.append(readable(t.as_py()))
            size += len(some[-1])
            if size >= PORTION_CHARS or i == len(texts) - 1:
                out.append(held.whole(some).array(digest))
                some, size = [], 0
        return pa.concat_arrays(out) if out else held.whole([]).array(digest)

    return align(text)


def compose_long(docs: DataFrame, a_json: str, b_model: bytes, digest: bool, range_bytes: int) -> DataFrame:
    """(doc, result) of long texts: spans, fragments, and levels of composition."""
    load = once_per_process(a_json, b_model)
    schema = _fragment_type()
    results = pa.schema([("doc", pa.int64()), *((c, schema.field(c).type if c in schema.names else pa.int64()) for c in COLUMNS)])

    @F.arrow_udf("array<struct<start:bigint,piece:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        whole = load().splits
        rows = []
        for t in texts:
            data = t.as_py() if readable(t.as_py()) else b""
            some = long_spans(data, range_bytes) if whole else [(0, data.decode())]
            rows.append([{"start": s, "piece": p} for s, p in some])
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("piece", pa.string())])))

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = load()
        for batch in batches:
            for row in batch.to_pylist():
                rows = [_row(row["doc"], *f) for f in held.fragments(row["piece"], row["start"], range_bytes)]
                yield from pa.Table.from_pylist(rows, schema).to_batches()

    def total(table: pa.Table) -> tuple[dict, Fragment]:
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        whole = Fragment()
        for row in rows:
            whole = whole + _fragment(row)
        return rows[0], whole

    def compose(table: pa.Table) -> pa.Table:
        first, whole = total(table)
        return pa.Table.from_pylist([_row(first["doc"], first["part"], first["at"], whole)], schema)

    def finish(table: pa.Table) -> pa.Table:
        first, whole = total(table)
        whole = whole.closed()
        if not whole.fits or whole.tail[0] or whole.tail[1]:
            whole = Fragment()
        links, line = sum(whole.pairs.values()), ";".join(whole.groups)
        line = line_digest(line) if digest else line
        row = (whole.n_a, whole.n_b, whole.n_groups, links, line, _pair_list(whole.pairs))
        return pa.Table.from_pylist([{"doc": first["doc"], **dict(zip(COLUMNS, row, strict=True))}], results)

    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0
    pieces = docs.select("doc", F.explode(cut(F.col("text"))).alias("s")).select("doc", "s.start", "s.piece")
    level = pieces.repartition("doc", "start").mapInArrow(fragments, FRAGMENT)
    parts = longest // range_bytes + 1
    while parts > FAN:
        level = level.withColumn("part", F.expr(f"part div {FAN}")).groupBy("doc", "part").applyInArrow(compose, FRAGMENT)
        parts = -(-parts // FAN)
    out = "doc bigint, " + ", ".join(f"{c} {kind}" for c, kind in RESULT_TYPES.items())
    done = level.groupBy("doc").applyInArrow(finish, out)
    return done.select("doc", F.struct(*COLUMNS).alias("_r"))


def align(
    df: DataFrame, a_path: str, b_path: str, text: str = "text", digest: bool = False, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``df`` with n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``) and pairs (A's id << 32 | B's, and links).

    ``digest``: of groups, which take several times the text's bytes, the SHA-256 in hexadecimal only ('' if there are none).
    """
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        models = a.read(), b.read(), digest
    kept = [c for c in df.columns if c not in COLUMNS]
    df, own = own_names(df)
    names = [own[c] for c in kept]
    data = F.col(own[text]).cast("string").cast("binary")
    size = F.coalesce(F.octet_length(data), F.lit(0))
    short = df.filter(size <= range_bytes).withColumn("_r", align_column(data, *models)).select(*names, "_r")
    long = stored(df.filter(size > range_bytes).select(*dict.fromkeys([*names, own[text]]), F.monotonically_increasing_id().alias("doc")), "long")
    composed = compose_long(long.select("doc", F.col(own[text]).cast("binary").alias("text")), *models, range_bytes)
    both = short.unionByName(long.select("doc", *names).join(composed, "doc").select(*names, "_r"))
    return both.select(*names, "_r.*").toDF(*kept, *COLUMNS)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold a pair linked, and whether its A id has no pair with more."""
    counts = aligned.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = stored(counts, "pairs").withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignment_report(df: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: tokens, groups, links, and how common its links are corpus-wide."""
    aligned = align(df.select("doc_id", "text"), a_path, b_path, digest=True, range_bytes=range_bytes)
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    sums = (
        measured_join(links, link_counts(aligned), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("n_best"),
            F.sum(F.col("n") * F.col("docs")).cast("bigint").alias("count_sum"),
        )
    )
    none = F.lit(0).cast("bigint")
    return aligned.drop("pairs").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), F.col("groups").alias("groups_sha256"),
    )
