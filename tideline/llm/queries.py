"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm.alignment import alignment_report
from tideline.llm.bpe import bpe_report
from tideline.llm.exact_dedup import dedup_report
from tideline.llm.fingerprints import fingerprint_report
from tideline.llm.langid import language_report
from tideline.llm.mixing import mix_report
from tideline.llm.quality import quality_report
from tideline.llm.runs import run_report
from tideline.llm.secret_scan import secret_report
from tideline.llm.sharding import shard_report
from tideline.llm.simhash import simhash_report
from tideline.llm.topk import topk_report
from tideline.llm.warc import archive_report

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark, sf_dir):
    return secret_report(table(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    return archive_report(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark, sf_dir, path: str | None = None):
    """``path``: the rank file; by default that of the public tokenizers."""
    return bpe_report(
        table(spark, sf_dir, "documents"), path or tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN
    )


def op4_exact_dedup(spark, sf_dir):
    return dedup_report(table(spark, sf_dir, "documents"))


def op5_top_k(spark, sf_dir):
    return topk_report(table(spark, sf_dir, "embeddings"))


def op6_quality(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents"))


def op7_sharding(spark, sf_dir):
    return shard_report(table(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash_report(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_report(table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents"))


def op11_runs(spark, sf_dir):
    return run_report(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark, sf_dir):
    return fingerprint_report(table(spark, sf_dir, "documents"))


def op13_alignment(spark, sf_dir, a_path: str | None = None, b_path: str | None = None):
    """``a_path``, ``b_path``: the two vocabularies; by default those of the public tokenizers."""
    return alignment_report(
        table(spark, sf_dir, "documents"),
        a_path or tokenizers.path("byte_bpe_50k.json"),
        b_path or tokenizers.path("piece_bpe_32k.model"),
    )


def llm_queries() -> dict[str, Query]:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op2_warc": op2_warc,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_top_k": op5_top_k,
        "op6_quality": op6_quality,
        "op7_sharding": op7_sharding,
        "op8_simhash": op8_simhash,
        "op9_language_id": op9_language_id,
        "op10_mixing": op10_mixing,
        "op11_runs": op11_runs,
        "op12_fingerprints": op12_fingerprints,
        "op13_alignment": op13_alignment,
    }
