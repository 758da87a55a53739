"""Queries run in a process that starts elsewhere and has no path to the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__
print("ROWS", __spark_entry__.queries()["op5_license_matches"](spark, sys.argv[1]).count())
"""


def test_from_another_folder(tiny, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, tiny], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]
