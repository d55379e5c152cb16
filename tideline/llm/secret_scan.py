"""Secrets in texts: assignments, access keys, hex runs, and strings whose sliding-window entropy is high.

Expressions only: no rows move, no Python runs. A span is (kind, start, end)
in code points, end exclusive.

* Patterns: leftmost, non-overlapping matches per kind; a match that is too
  short is dropped after it has used up its text.
* Entropy: every run of a character class is a candidate. A window of
  ``WINDOW`` characters slides over it; per step one count goes up and one
  down, and the sum of c*log2(c), kept as an exact integer, changes by four
  table values. The span reaches from the first to the last window at or
  above the class's threshold, which is set so that random strings of the
  class reach it: of those of ``WINDOW`` characters 97 of 100 do, of longer ones more.
* An allow-list of patterns suppresses candidates; candidates that overlap a
  pattern's span, or a span of an earlier class, are not reported again.

A text with many matches takes time in proportion to them: places are summed
up in blocks, and overlaps are found by bisection in each kind's spans, which
are sorted and apart.

NULL counts as empty. Texts of any length are read whole; repeated rows and
other columns, whatever their names, pass through (``secrets`` is replaced if
it exists). An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import own_names

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE_CHARS = 6
#: A run too short to count cannot hold a longer one, so the length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
#: Bits of the fraction in the table of c*log2(c).
FRACTION_BITS = 32


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``pattern`` in which every pattern of ``must`` is found are candidates.

    ``alphabet`` (after lower-casing, if ``fold``) numbers the characters.
    """

    kind: str
    pattern: str
    alphabet: str
    threshold: float
    fold: bool = False
    must: tuple[str, ...] = ()


CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-Fa-f]{20,}", "0123456789abcdef", 2.95, fold=True),
    CharacterClass(
        "entropy_alnum", r"[a-z0-9]{20,}|[A-Z0-9]{20,}", "abcdefghijklmnopqrstuvwxyz0123456789", 3.45, fold=True, must=("[0-9]",)
    ),
    # Plain and URL-safe base64; without all three kinds of characters it is a path, a slug or an identifier.
    CharacterClass(
        "entropy_base64",
        r"[A-Za-z0-9+/_-]{20,}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        3.7,
        must=("[0-9]", "[a-z]", "[A-Z]"),
    ),
)

#: Whole candidates that are no secrets: numbers, words, UUIDs, lower-case paths and identifiers, documentation samples.
ALLOW = (
    r"^[0-9]+$",
    r"^[A-Za-z_/+-]+$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^/?([a-z0-9_]*[a-z][a-z0-9_]*/)+[a-z0-9_]*$",
    r"^[a-z]+(_[a-z0-9]+)+$",
    r"(?i)example|sample|placeholder|xxxxxx",
)

#: Matches whose places are summed up together.
BLOCK = 128

KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of a pattern's matches; ``value`` is the group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    parts = F.arrays_zip(between.alias("gap"), found.alias("hit"), values.alias("value"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.char_length(part["gap"])
        end = begin + F.char_length(part["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def shift(state: Column, block: Column) -> Column:
        moved = F.transform(
            block["out"],
            lambda m: F.struct((m["start"] + state["at"]).alias("start"), (m["end"] + state["at"]).alias("end"), m["value"].alias("value")),
        )
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    def summed(p: Column) -> Column:
        """Places within blocks of matches, then of the blocks: appending to one array would copy it for each match."""
        zero = F.lit(0).cast("bigint").alias("at")
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, BLOCK)
        )
        inside = F.transform(blocks, lambda b: F.aggregate(b, F.struct(zero, empty.alias("out")), step))
        none = F.array().cast("array<array<struct<start:bigint,end:bigint,value:string>>>").alias("out")
        return F.flatten(F.aggregate(inside, F.struct(zero, none), shift, lambda state: state["out"]))

    return F.when(text.rlike(pattern), bound(parts, summed)).otherwise(empty)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value as a lambda's variable: computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def entropy_range(value: Column, cls: CharacterClass, window: int = WINDOW) -> Column:
    """struct<first, last>: where the windows at or above the threshold begin and end; first is -1 if there is none."""
    scale = 1 << FRACTION_BITS
    table = F.array(*(F.lit(round(c * math.log2(c) * scale) if c else 0).cast("bigint") for c in range(window + 2)))
    # H = log2(window) - sum / window, so a high entropy is a small sum.
    most = math.floor((math.log2(window) - cls.threshold) * window * scale)
    chars = F.split(F.lower(value) if cls.fold else value, "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(cls.alphabet), c) - 1)
    zero = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        F.lit(-1).cast("bigint").alias("first"),
        F.lit(-1).cast("bigint").alias("last"),
    )

    def by(index: Column) -> Column:
        return F.get(table, index)

    def step(state: Column, x: Column) -> Column:
        up, down, i = x["up"], x["down"], x["i"]
        more, less = F.get(state["counts"], up), F.get(state["counts"], down)
        total = state["sum"] + F.when(up == down, F.lit(0)).otherwise(
            by(more + 1) - by(more) + F.when(down >= 0, by(less - 1) - by(less)).otherwise(F.lit(0))
        )
        counts = F.transform(
            state["counts"], lambda c, k: c + F.when(k == up, 1).otherwise(0) - F.when(k == down, 1).otherwise(0)
        )
        full = (i >= window - 1) & (total <= most)
        return F.struct(
            counts.alias("counts"),
            total.cast("bigint").alias("sum"),
            F.when(full & (state["first"] < 0), i - (window - 1)).otherwise(state["first"]).cast("bigint").alias("first"),
            F.when(full, i + 1).otherwise(state["last"]).cast("bigint").alias("last"),
        )

    leaving = F.concat(F.array_repeat(F.lit(-1), window), codes)
    index = F.sequence(F.lit(0), F.size(codes) - 1)
    moves = F.slice(
        F.arrays_zip(codes.alias("up"), leaving.alias("down"), index.alias("i")), F.lit(1), F.size(codes)
    )
    return F.aggregate(moves, zero, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            m["value"].alias("value"),
        ),
    ).cast(f"array<{SPAN}>")


def _touches(m: Column, spans: Column) -> Column:
    """Whether ``m`` overlaps one of sorted spans that are apart: if any, the last that starts before its end."""

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        before = F.get(spans, middle)["start"] < m["end"]
        return (
            F.when(s["lo"] >= s["hi"], s)
            .when(before, F.struct((middle + 1).alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi")))
        )

    whole = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    last = F.aggregate(steps, whole, halve, lambda s: s["lo"]) - 1
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, last)["end"] > m["start"], F.lit(False))


def _fit(found: Column, taken: list[Column], cls: CharacterClass, allow: tuple[str, ...]) -> Column:
    """The candidates that are apart from all spans so far, hold what the class asks for and are not allowed."""
    together = F.struct(found.alias("found"), *(t.alias(f"t{i}") for i, t in enumerate(taken)))

    def kept(all_: Column) -> Column:
        def fits(m: Column) -> Column:
            good = ~_any(m["value"], allow)
            for p in cls.must:
                good = good & m["value"].rlike(p)
            for i in range(len(taken)):
                good = good & ~_touches(m, all_[f"t{i}"])
            return good

        return F.filter(all_["found"], fits)

    return bound(together, kept)


def scan_secrets(
    df: DataFrame,
    text: str = "text",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
    window: int = WINDOW,
) -> DataFrame:
    """``df`` with ``secrets``: array<struct<start, rank, end, kind, value>> in the order of start, then kind."""
    kept = [c for c in df.columns if c != "secrets"]
    df, own = own_names(df)
    names = [own[c] for c in kept]
    df = df.select(*names, F.coalesce(own[text], F.lit("")).alias("_text"))
    t = F.col("_text")
    assign = F.filter(matches(t, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= ASSIGN_VALUE_CHARS)
    df = df.withColumns(
        {
            "_assign": assign,
            "_access": matches(t, ACCESS),
            "_hex": matches(t, HEX),
            **{f"_{c.kind}": matches(t, c.pattern) for c in classes},
        }
    )
    taken = ["_assign", "_access", "_hex"]
    for c in classes:
        fit = _fit(F.col(f"_{c.kind}"), [F.col(k) for k in taken], c, allow)
        high = F.transform(
            F.filter(_ranged(fit, c, window), lambda x: x["r"]["first"] >= 0),
            lambda x: F.struct(
                (x["m"]["start"] + x["r"]["first"]).alias("start"),
                (x["m"]["start"] + x["r"]["last"]).alias("end"),
                F.substring(
                    x["m"]["value"], (x["r"]["first"] + 1).cast("int"), (x["r"]["last"] - x["r"]["first"]).cast("int")
                ).alias("value"),
            ),
        )
        found = F.col(f"_{c.kind}")
        df = df.withColumn(f"_{c.kind}", F.when(F.size(found) > 0, high).otherwise(found))
        taken.append(f"_{c.kind}")
    # Structs order by start, then kind; spans of one kind never share a start.
    every = F.concat(*(_spans(F.col(k), k[1:]) for k in taken))
    return df.select(*names, F.array_sort(every)).toDF(*kept, "secrets")


def _ranged(found: Column, cls: CharacterClass, window: int) -> Column:
    return F.transform(found, lambda m: F.struct(m.alias("m"), entropy_range(m["value"], cls, window).alias("r")))


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | value.rlike(p)
    return found


def span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_report(df: DataFrame) -> DataFrame:
    """Counts and digests of :func:`scan_secrets` per document."""
    s = F.col("secrets")

    def of(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter(s, lambda x: x["rank"] < 3)
    return scan_secrets(df.select("doc_id", "text")).select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(s).alias("spans"),
    )
