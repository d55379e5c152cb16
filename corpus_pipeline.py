"""Documents to token digests: quality, exact dedup, near dedup, mixing, byte-level BPE.

Each stage reads what its predecessor kept, written as Parquet to the shared
folder, and returns the columns of documents; the last one returns a row of
digests per mixed row.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm.bpe import bpe_report
from tideline.llm.exact_dedup import dedup
from tideline.llm.mixing import mix
from tideline.llm.near_texts import drop_near_duplicates
from tideline.llm.quality import keep_clean
from tideline.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id."""
    return dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its five-word shingles: the smallest doc_id."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them, in its order: each file is a run of the schedule."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each text's ids, and digest of the bytes that they decode to."""
    return bpe_report(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing", mixing),
    ("byte-level BPE", encode),
]

#: SQL has no fitted classifier, SimHash or BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
