"""Quality classifier from weak labels.

1. Labellers: overlapping heuristics vote clean, junk or neither on every
   document, by expressions over the whole text.
2. Label model: expectation-maximisation estimates, for each labeller, how
   often it votes how on clean and on junk documents, and the share of clean
   ones. Its input is the number of documents per pattern of votes, counted over all
   documents; there are at most 3^labellers patterns, so the driver sees a
   few thousand rows at most.
3. Scorer: posteriors of a bounded sample (``SAMPLE`` documents, drawn by hash)
   train a logistic model on hashed byte n-grams. It scores every whole text.

A document is kept if its score is ``THRESHOLD`` or more. NULL and empty texts
have no features and are rejected with score 0; other columns pass through
``keep_clean``; repeated rows score alike. An empty table gives an empty result;
without a single text to learn from nothing is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.features import dense, fit_logistic, gram_counts, margin, sparse, unit
from tideline.llm.shared import WORD, own_names

#: Documents that the scorer is fitted on, at most.
SAMPLE = 2000
THRESHOLD = 0.05
#: Bytes of text at which half of the evidence counts.
EVIDENCE = 100
ROUNDS = 50
CLEAN, JUNK, NONE = 1, 0, 2
#: Frequent words of the languages at hand.
SMALL_WORDS = (
    *("the", "of", "and", "to", "in", "is"),
    *("de", "la", "le", "que", "el", "en", "et", "les", "des"),
    *("der", "die", "und", "das", "den"),
)


def _count(text: Column, pattern: str) -> Column:
    """Characters that a pattern's matches hold."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _vote(junk: Column, clean: Column) -> Column:
    return F.when(junk, JUNK).when(clean, CLEAN).otherwise(NONE)


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that the labellers share, each a pass over the text."""
    lines = F.split(text, "\n")
    return {
        "chars": F.char_length(text),
        "letters": _count(text, r"\p{L}+"),
        "upper": _count(text, r"\p{Lu}+"),
        "spaces": _count(text, r"[\x20\x09-\x0D]+"),
        "words": F.regexp_count(text, F.lit(WORD)),
        "marks": F.regexp_count(text, F.lit(r"[#$%&*@^~!?+=<>]{2,}")),
        "bars": F.regexp_count(text, F.lit(r"[\x20\x09][|\t][\x20\x09]")),
        "stops": F.regexp_count(text, F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")),
        "small": F.regexp_count(text, F.lit(rf"(?i)(?<![\p{{L}}])({'|'.join(SMALL_WORDS)})(?![\p{{L}}])")),
        "again": F.regexp_count(text, F.lit(rf"(?<![^\x20\x09-\x0D])({WORD})[\x20\x09-\x0D]+\1(?![^\x20\x09-\x0D])")),
        "runs": F.regexp_count(
            text, F.lit(rf"(?<![^\x20\x09-\x0D])({WORD})(?:[\x20\x09-\x0D]+\1(?![^\x20\x09-\x0D])){{4}}")
        ),
        "lines": F.size(lines),
        "unlike": F.size(F.array_distinct(lines)),
    }


def votes() -> list[Column]:
    """The labellers, over the columns of :func:`statistics`."""
    words, letters = F.greatest("words", F.lit(1)), F.greatest("letters", F.lit(1))
    inked = F.greatest(F.col("chars") - F.col("spaces"), F.lit(1))
    marks, bars = F.col("marks") / words, F.col("bars") / words
    upper, stops = F.col("upper") / letters, F.col("stops") / words
    long = F.col("words") >= 20
    return [
        _vote(marks > 0.05, marks < 0.005),
        _vote(upper > 0.3, upper < 0.12),
        _vote(bars > 0.05, bars == 0),
        _vote(F.col("letters") / inked < 0.75, F.col("letters") / inked > 0.88),
        _vote(long & (stops < 0.01), stops > 0.03),
        _vote(long & (F.col("small") / words < 0.02), F.col("small") / words > 0.1),
        _vote((F.col("lines") >= 4) & (F.col("unlike") / F.col("lines") < 0.5), F.col("unlike") == F.col("lines")),
        _vote(F.col("again") / words > 0.1, F.col("again") / words < 0.02),
        _vote(F.col("runs") > 0, F.col("again") == 0),
        _vote((inked / words > 12) | (inked / words < 2), (inked / words > 3) & (inked / words < 9)),
    ]


def with_votes(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pattern``: an array of votes, a labeller each."""
    body = F.coalesce(F.col(text), F.lit(""))
    stats = {f"_{k}": v for k, v in statistics(body).items()}
    held = df.withColumns(stats).select(*df.columns, F.struct(*(F.col(c).alias(c[1:]) for c in stats)).alias("_s"))
    # One projection per step, so that no statistic is computed twice.
    flat = held.select(*df.columns, "_s.*")
    return flat.select(*df.columns, F.array(*votes()).alias("pattern"))


class LabelModel:
    """Vote probabilities per labeller and class, and the share of clean documents."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> None:
        k, m = patterns.shape
        onehot = np.stack([patterns == v for v in (JUNK, CLEAN, NONE)], axis=2).astype(float)
        # Labellers name rare faults and seldom do so wrongly: the first guess is junk where any of them does.
        posterior = np.where((patterns == JUNK).any(axis=1), 0.1, 0.95)
        for _ in range(rounds):
            weight = np.stack([counts * (1 - posterior), counts * posterior])
            self.prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
            table = np.einsum("ck,kmv->cmv", weight, onehot) + 1.0
            self.table = table / table.sum(axis=2, keepdims=True)
            posterior = self.posterior(patterns)
        self.accuracy = np.einsum("cm,c->m", np.stack([self.table[0, :, JUNK], self.table[1, :, CLEAN]]), self.prior)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        at = np.arange(patterns.shape[1])
        log = np.log(self.prior)[:, None] + np.log(self.table[:, at, patterns]).sum(axis=2)
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -50, 50)))


def fit_labels(voted: DataFrame) -> LabelModel | None:
    rows = voted.groupBy("pattern").count().collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r.pattern)
    return LabelModel(np.array([r.pattern for r in rows]), np.array([r["count"] for r in rows], float))


def text_features(text: bytes) -> np.ndarray:
    """Hashed n-grams, and in the first dimensions how much of the text repeats the word or line before.

    Short texts have short vectors: little evidence moves a score little.
    """
    x = unit(gram_counts(text))
    for at, parts in enumerate((text.split(), text.split(b"\n"))):
        repeats = sum(map(eq, parts, parts[1:]))
        x[at] = np.sqrt(repeats / max(1, len(parts)))
    return x * np.sqrt(len(text) / (len(text) + EVIDENCE))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes and features of each text, packed: big-endian bytes take the order of the numbers, none of which is negative."""
    for batch in batches:
        for text, pattern in zip(batch.column("text").to_pylist(), batch.column("pattern").to_pylist(), strict=True):
            at, x = sparse(text_features(text.encode()))
            packed = {"pattern": np.array(pattern, "u1"), "at": at.astype(">i4"), "x": x.astype(">f4")}
            yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in packed.items()})


def fit_scorer(df: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """Weights of the scorer, learned from a table's texts alone."""
    texts = df.select(F.col(f"`{text}`").alias("text")).filter(F.length("text") > 0)
    voted = with_votes(texts)
    labels = fit_labels(voted.select("pattern"))
    if labels is None:
        return None
    n = texts.count()
    # Twice the sample passes the filter on average; the limit, on a hash, makes the bound strict.
    some = texts.withColumn("_h", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30))).filter(
        F.col("_h") < min(1.0, 2 * sample / n) * (1 << 30)
    )
    first = some.withColumn("_rank", F.row_number().over(W.partitionBy(F.pmod("_h", F.lit(8))).orderBy("_h", "text")))
    chosen = with_votes(first.filter(F.col("_rank") <= sample // 8).select("text"))
    # Bytes, not arrays: the driver would hold each number as an object, twice, in the JVM and in Python.
    rows = chosen.mapInArrow(_features, "pattern binary, at binary, x binary").collect()
    rows = sorted((bytes(r.pattern), bytes(r.at), bytes(r.x)) for r in rows)
    if not rows:
        return None
    target = labels.posterior(np.array([np.frombuffer(p, "u1") for p, *_ in rows]))
    return fit_logistic(dense([(np.frombuffer(at, ">i4"), np.frombuffer(x, ">f4")) for _, at, x in rows]), target)


def score_column(weights: np.ndarray | None, text: Column) -> Column:
    if weights is None:
        return F.lit(0.0)
    model = weights[None, :]

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.binary()).to_pylist():
            m = float(margin(model, text_features(t))[0]) if t else -np.inf
            out.append(1.0 / (1.0 + np.exp(-m)) if m > -700 else 0.0)
        return pa.array(out, pa.float64())

    return score(text)


def keep_clean(df: DataFrame, text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``df`` that the scorer accepts."""
    weights = fit_scorer(df, text, sample)
    own, names = own_names(df)
    scored = own.withColumn("_score", score_column(weights, F.col(names[text])))
    return scored.filter(F.col("_score") >= threshold).select(*names.values()).toDF(*df.columns)


def quality_report(df: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, kept) for every row."""
    weights = fit_scorer(df, "text", sample)
    scored = df.select("doc_id", score_column(weights, F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).alias("kept"))
