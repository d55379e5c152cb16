"""Language identification in two steps: the family first, then one-versus-one machines within it.

Texts are hashed byte n-grams, read whole. A linear support vector machine per
family, against the rest, picks the family; inside it a machine per pair of
languages votes, ties going to the larger sum of margins, then to the first
name. Machines are fitted from a bounded sample of every language: at most
``SAMPLE`` texts of each, drawn by hash among those with a letter. A family
machine sees the whole sample, each family weighted alike and each language
alike within it. Only sparse features of the sample leave the executors. Up to
``DRIVER_LANGUAGES`` languages the driver fits the machines, beyond that Spark
tasks do, one machine at a time. The sample grows with the number of languages,
not of texts; models are a few weights per language and travel with the
function. Prediction is a pass over the texts, nothing is shuffled.

Learned from: text and language of rows that are not held out. Rows with NULL
text, NULL language or no letter teach nothing. A prediction uses the text
only; ``und`` with score 0 stands for NULL texts, texts without a letter, and
all texts if nothing was learned. A NULL doc_id counts as held out. Repeated
rows are predicted alike. Other columns pass through. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.features import DIMENSIONS, SparseRows, fit_svm, gram_counts, margin, sparse, unit
from tideline.operators.sizing import lookup

#: Texts per language that the machines are fitted on.
SAMPLE = 300
#: Most languages whose machines the driver fits by itself.
DRIVER_LANGUAGES = 16
LETTER = r"\p{L}"

#: Language families by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}


Rows = list[tuple[str, list[int], list[float]]]


class Sample:
    """The rows of a sample by language, and the fit of one machine on them."""

    def __init__(self, rows: Rows, families: dict[str, list[str]]) -> None:
        self.families = families
        self.by_lang: dict[str, list] = {}
        for lang, at, x in rows:
            self.by_lang.setdefault(lang, []).append((at, x))
        self.whole: tuple | None = None

    def fit(self, job: tuple[str, str | None, str | None]) -> np.ndarray:
        """The machine of a family against the rest, or of a pair of languages."""
        name, one, other = job
        if one is not None:
            up, down = self.by_lang[one], self.by_lang[other]
            return fit_svm(SparseRows(up + down), np.arange(len(up) + len(down)) < len(up))
        if self.whole is None:
            rows, of, weight = [], [], []
            for family, langs in self.families.items():
                for lang in langs:
                    mine = self.by_lang[lang]
                    rows += mine
                    of += [family] * len(mine)
                    weight += [1.0 / (len(langs) * len(mine))] * len(mine)
            self.whole = SparseRows(rows), np.array(of), np.array(weight)
        m, of, weight = self.whole
        return fit_svm(m, of == name, weight)


def fit_on_executors(spark: SparkSession):
    """Fits machines as Spark tasks: jobs to weights, in the order of jobs."""

    def fit_all(sample: Sample, jobs: list[tuple]) -> list[np.ndarray]:
        shared = spark.sparkContext.broadcast(sample)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    w = shared.value.fit(jobs[i]).astype(np.float64).tobytes()
                    yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int64()), "w": pa.array([w], pa.binary())})

        found = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "i bigint, w binary").collect()
        shared.unpersist()
        return [np.frombuffer(bytes(r.w)) for r in sorted(found, key=lambda r: r.i)]

    return fit_all


class Hierarchy:
    """Fitted machines; plain arrays, so that it travels with a function."""

    def __init__(self, rows: Rows, families: Mapping[str, tuple[str, ...]], fit_all=None) -> None:
        family_of = {lang: family for family, langs in families.items() for lang in langs}
        self.languages = sorted({lang for lang, *_ in rows})
        self.families: dict[str, list[str]] = {}
        for lang in self.languages:
            self.families.setdefault(family_of.get(lang, lang), []).append(lang)
        self.names = sorted(self.families)
        jobs: list[tuple] = [(name, None, None) for name in self.names] if len(self.names) > 1 else []
        self.pairs: dict[str, list[tuple[int, int]]] = {}
        for name, langs in self.families.items():
            self.pairs[name] = [(i, j) for i in range(len(langs)) for j in range(i + 1, len(langs))]
            jobs += [(name, langs[i], langs[j]) for i, j in self.pairs[name]]
        sample = Sample(rows, self.families)
        fitted = fit_all(sample, jobs) if fit_all and jobs else [sample.fit(job) for job in jobs]
        none = np.zeros((0, DIMENSIONS + 1))
        machines: dict[str, list] = {name: [] for name in self.families}
        for (name, one, _), w in zip(jobs, fitted, strict=True):
            if one is not None:
                machines[name].append(w)
        of_family = [w for (_, one, _), w in zip(jobs, fitted, strict=True) if one is None]
        self.family_machines = np.stack(of_family) if of_family else none
        self.pair_machines = {name: np.stack(ws) if ws else none for name, ws in machines.items()}

    def predict(self, text: str) -> tuple[str, float]:
        x = unit(gram_counts(text.lower().encode()))
        name, score = self.names[0], 1.0
        if len(self.names) > 1:
            margins = margin(self.family_machines, x)
            order = np.argsort(-margins, kind="stable")
            name = self.names[order[0]]
            score = _sure(margins[order[0]] - margins[order[1]])
        langs = self.families[name]
        if len(langs) == 1:
            return langs[0], score
        votes, sums = np.zeros(len(langs)), np.zeros(len(langs))
        margins = margin(self.pair_machines[name], x)
        for (i, j), m in zip(self.pairs[name], margins.tolist(), strict=True):
            votes[i if m >= 0 else j] += 1
            sums[i] += m
            sums[j] -= m
        best = max(range(len(langs)), key=lambda i: (votes[i], sums[i], -i))
        against = [abs(m) for (i, j), m in zip(self.pairs[name], margins.tolist(), strict=True) if best in (i, j)]
        return langs[best], score * _sure(2 * min(against))


def _sure(gap: float) -> float:
    return float(1.0 / (1.0 + np.exp(-2.0 * gap)))


def held_out(key: str = "doc_id", parts: int = 5) -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % parts == 0, F.lit(True))


def readable(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(LETTER), F.lit(False))


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "_rank", "text"))
        for lang, rank, text in zip(*columns, strict=True):
            at, x = sparse(unit(gram_counts(text.lower().encode())))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang],
                    "rank": pa.array([rank], pa.int32()),
                    "at": pa.array([at], pa.list_(pa.int32())),
                    "x": pa.array([x], pa.list_(pa.float32())),
                }
            )


def learn(
    df: DataFrame, sample: int = SAMPLE, families: Mapping[str, tuple[str, ...]] = FAMILIES
) -> Hierarchy | None:
    """Machines from rows with ``doc_id``, ``text`` and ``lang``; NULL languages and letterless texts are left out."""
    labelled = df.filter(F.col("lang").isNotNull() & readable())
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_count"))
    # Four times the sample passes the first filter on average; the rank makes the bound strict.
    h = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    known = lookup(labelled.withColumn("_h", h), counts, ["lang"])
    some = known.filter(F.col("_h") < F.least(F.lit(1.0), 4 * sample / F.col("_count")) * (1 << 30))
    ranked = some.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("_h", "doc_id", "text")))
    chosen = ranked.filter(F.col("_rank") <= sample).select("lang", "_rank", "text")
    rows = chosen.mapInArrow(_sparse_rows, "lang string, rank int, at array<int>, x array<float>").collect()
    # In the order of the hash within a language.
    rows = [(r.lang, r.at, r.x) for r in sorted(rows, key=lambda r: (r.lang, r["rank"]))]
    if not rows:
        return None
    many = len({lang for lang, *_ in rows}) > DRIVER_LANGUAGES
    return Hierarchy(rows, families, fit_on_executors(df.sparkSession) if many else None)


def predict_column(model: Hierarchy | None, text: Column) -> Column:
    """struct<lang, score> of a text that has a letter."""
    if model is None:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        found = [("und", 0.0) if t is None else model.predict(t) for t in texts.to_pylist()]
        langs, scores = zip(*found, strict=True) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)


def language_report(df: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learned from the rows that are not held out."""
    model = learn(df.select("doc_id", "text", "lang").filter(~held_out()), sample)
    predicted = df.select(
        "doc_id",
        held_out().alias("held_out"),
        predict_column(model, F.when(readable(), F.col("text"))).alias("_p"),
    )
    return predicted.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
