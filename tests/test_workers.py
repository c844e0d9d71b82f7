"""Python workers must not need the package on their path: the driver harness may import the
entry module from elsewhere, and executors on a cluster may not have the package installed."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("ROWS", E.queries()["recommendations_part"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_map_in_pandas_runs_without_package_on_worker_path():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run(
            [sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600
        )
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
