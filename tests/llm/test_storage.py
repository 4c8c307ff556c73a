"""Intermediate tables: there while the application runs, gone after it."""

import os
import subprocess
import sys
import time

PROGRAM = """
import sys
from pyspark.sql import SparkSession
from tillroll.llm.storage import written
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
tables = [written(spark.range(n), "numbers") for n in (3, 0)]
assert [t.count() for t in tables] == [3, 0]
spark.range(2).write.parquet(sys.argv[1] + "/kept")
"""


def tables(folder):
    return sorted(n for n in os.listdir(folder) if n.startswith("llm-"))


def test_tables_go_with_the_application(tmp_path):
    folder = str(tmp_path)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])}
    subprocess.run([sys.executable, "-c", PROGRAM, folder], check=True, timeout=180, env=env)
    ends = time.monotonic() + 30
    while tables(folder) and time.monotonic() < ends:
        time.sleep(0.2)
    assert tables(folder) == []
    assert os.path.exists(f"{folder}/kept")
