"""The driver imports __spark_entry__ from elsewhere: Python tasks must not need the package
on their import path (kernels are shipped by value)."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as e
assert len(e.entry(spark).collect()) == 5
assert e.queries()["exact_diameter"](spark, "/root/testdata/sf0.001").count() == 1
print("ENTRY-OK")
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_entry_runs_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="dispersa-entry-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ENTRY-OK" in out.stdout, out.stderr[-3000:]
