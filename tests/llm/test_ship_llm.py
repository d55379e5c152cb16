import pathlib
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as contract
queries = contract.queries()
for name in ("op2_warc", "op3_byte_bpe", "op4_exact_dedup", "op5_top_k", "op6_quality", "op8_simhash", "op9_language_id", "op11_runs", "op13_alignment"):
    print("rows", name, queries[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_not_find_the_package(tmp_path):
    repo = str(pathlib.Path(__file__).resolve().parents[2])
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=600
    )
    assert run.stdout.count("rows op") == 9, run.stderr[-2000:]
