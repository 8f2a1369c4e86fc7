"""Queries with Python stages run from any folder, without the package on the path of the workers."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", entry.queries()["similarity_pairs_dense"](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the given tables are not here")
def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
