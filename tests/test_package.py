"""The package reaches executors whose working directory does not have it."""

import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", entry.queries()["additive_forecast_p9_48h"](spark, "/root/testdata/sf0.001").count())
"""


def test_a_fit_runs_from_an_empty_directory(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    rows = [int(x.split()[1]) for x in done.stdout.splitlines() if x.startswith("ROWS")]
    assert rows and rows[0] > 0, done.stderr[-2000:]
