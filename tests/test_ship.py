import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as contract
print("rows", contract.entry(spark).count())
"""


def test_executors_need_not_find_the_package(tmp_path):
    import pathlib

    repo = str(pathlib.Path(__file__).resolve().parents[1])
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "rows 5" in run.stdout, run.stderr[-2000:]
