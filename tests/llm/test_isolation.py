"""Executors need no copy of the package: every query of the subpackage runs from another folder."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as e
for name, query in e.queries().items():
    if name.startswith(sys.argv[1]):
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
        print("RAN", name, flush=True)
print("ALL-RAN")
"""


@pytest.mark.parametrize("names", ["op2_", "op3_", "op1"])
def test_queries_run_from_another_folder(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "ALL-RAN" in out.stdout, out.stderr[-3000:]
