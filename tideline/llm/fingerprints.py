"""Document fingerprints: threshold-scaled sketches, and how much of one text another holds.

A sketch is every distinct hash of a text's five-word shingles below a fixed
fraction of the hash range. The fraction is the same for all texts, so a
sketch grows with its text, the sketch of two texts together is the union of
theirs, and the share of one sketch found in another estimates the share of
shingles, however unequal the texts are. A text none of whose hashes is that
small keeps its least one, so only texts without words have an empty sketch; unions keep
the least of both in the same way (:func:`merged`).

Expressions only: hashes are the leading 64 bits of MD5, as hexadecimal
digits. Whole texts are read; words are split at ASCII white space; a text of
fewer than five words is one shingle.

NULL counts as empty. Two empty sketches hold each other wholly; an empty and another
one nothing of each other. Equal texts have equal sketches; repeated rows
pass through, as do other columns, whatever their names (``sketch`` is
replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.llm.shared import own_names

SHINGLE_WORDS = 5
#: Share of all hashes that sketches keep.
FRACTION = 1 / 8
HEX_DIGITS = 16
SPLIT = r"[\x20\x09-\x0D]+"
#: Text that one bucket of neighbours holds, and most buckets; beyond, they get larger, and Spark spills them.
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 100_000


def limit(fraction: float) -> str:
    """The least hash that is too large, in hexadecimal digits."""
    if not 0 < fraction < 1:
        raise ValueError("the fraction lies between 0 and 1")
    return f"{int(fraction * 16**HEX_DIGITS):0{HEX_DIGITS}x}"


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """array<string> of a text's shingle hashes in order, repeats included."""

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1)))
        shingle = lambda i: F.array_join(F.slice(w, i, words), " ")
        hashes = F.transform(starts, lambda i: F.substring(F.md5(shingle(i)), 1, HEX_DIGITS))
        return F.when(F.size(w) > 0, hashes).otherwise(F.array().cast("array<string>"))

    split = F.filter(F.split(F.coalesce(text, F.lit("")), SPLIT), lambda w: w != "")
    # Bound as the variable of a lambda, the words are split once and not once for each shingle.
    return F.get(F.transform(F.array(split), of), 0)


def _scaled(hashes: Column, fraction: float) -> Column:
    def kept(h: Column) -> Column:
        small = F.filter(h, lambda x: x < limit(fraction))
        return F.when((F.size(small) > 0) | (F.size(h) == 0), F.array_sort(F.array_distinct(small))).otherwise(
            F.array(F.array_min(h))
        )

    return F.get(F.transform(F.array(hashes), kept), 0)


def sketch(text: Column, fraction: float = FRACTION, words: int = SHINGLE_WORDS) -> Column:
    """array<string>: a text's shingle hashes below the fraction, sorted; the least one if none is."""
    return _scaled(shingle_hashes(text, words), fraction)


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts together, from theirs."""
    return _scaled(F.array_union(a, b), fraction)


def containment(a: Column, b: Column) -> Column:
    """The share of ``a`` that ``b`` holds, 0 to 1."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.size(a) > 0, shared / F.size(a)).when(F.size(b) > 0, F.lit(0.0)).otherwise(F.lit(1.0))


def resemblance(a: Column, b: Column) -> Column:
    """Shared hashes as a share of all, 0 to 1."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) > 0, shared.cast("double") / (F.size(a) + F.size(b) - shared)).otherwise(F.lit(1.0))


def with_sketch(df: DataFrame, text: str = "text", fraction: float = FRACTION, words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with ``sketch``; nothing is shuffled."""
    kept = [c for c in df.columns if c != "sketch"]
    df, own = own_names(df)
    return df.select(*(own[c] for c in kept), sketch(F.col(own[text]), fraction, words).alias("sketch")).toDF(*kept, "sketch")


def bucket_of(key: Column, bounds: list[str]) -> Column:
    """The last of the sorted ``bounds`` that is not above ``key``, by bisection; the first is not above any key."""
    # One literal, however many bounds: the optimizer folds the split.
    bound = F.split(F.lit(",".join(bounds)), ",")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(bound, middle) <= key
        return (
            F.when(s["hi"] - s["lo"] <= 1, s)
            .when(below, F.struct(middle.alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi")))
        )

    whole = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, whole, halve, lambda s: s["lo"])


def place_key(doc_id: Column, text: Column) -> Column:
    """A text whose order is that of the documents: by doc_id, NULL first, then by the MD5 of the text."""
    number = F.lpad((doc_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(number, F.lit("")), F.lit("/"), F.md5(text))


def bucket_bounds(keys: DataFrame, buckets: int) -> list[str]:
    """The least key of each of about ``buckets`` ranges of equal numbers of rows."""
    ranges = keys.repartitionByRange(max(1, buckets), "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
    return sorted(r.key for r in ranges.collect()) or [""]


def with_next(docs: DataFrame, columns: dict[str, str], bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` (key, text, ...) with columns of the next document in the order of the keys; the first follows the last.

    Ranges of keys are dealt to buckets. The first document of a bucket is also
    sent to the bucket before, where it comes last and only lends its columns.
    Rows are dealt once, whole; of the keys, only the least of each bucket is known beforehand.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    bounds = bucket_bounds(docs.select("key"), min(MAX_BUCKETS, math.ceil(size / bucket_bytes)))
    n = len(bounds)
    own = docs.withColumn("_own", bucket_of(F.col("key"), bounds))
    is_first = F.get(F.split(F.lit(",".join(bounds)), ","), F.col("_own")) == F.col("key")
    lent = F.struct(((F.col("_own") + (n - 1)) % n).alias("bucket"), F.lit(True).alias("lent"))
    kept = F.struct(F.col("_own").alias("bucket"), F.lit(False).alias("lent"))
    dealt = own.withColumn("_at", F.explode(F.when(is_first, F.array(kept, lent)).otherwise(F.array(kept))))
    order = W.partitionBy("_at.bucket").orderBy("_at.lent", "key")
    ahead = {new: F.lead(old).over(order) for old, new in columns.items()}
    return dealt.withColumns(ahead).filter(~F.col("_at.lent")).drop("_own", "_at")


def fingerprint_report(df: DataFrame, fraction: float = FRACTION, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every document beside its edited text and the next document; rows that repeat doc_id and text follow each other."""
    docs = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("key", place_key(F.col("doc_id"), F.col("text"))).withColumn("s", sketch(F.col("text"), fraction))
    met = with_next(docs, {"doc_id": "next_id", "text": "next_text", "s": "next_s"}, bucket_bytes)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    met = met.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "next_id", "s", "next_s", edited.alias("edited")
    )
    met = met.select(
        "doc_id", "n_chars", "next_id", "s", "next_s",
        F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), fraction).alias("e"),
    )
    s, e, n = F.col("s"), F.col("e"), F.col("next_s")
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join(s, ",").alias("fingerprint"),
        F.array_join(e, ",").alias("edited_fingerprint"),
        containment(s, e).alias("near_edited"),
        containment(s, n).alias("near_next"),
        "next_id",
        resemblance(s, e).alias("jaccard_edited"),
        resemblance(s, n).alias("jaccard_next"),
    )
