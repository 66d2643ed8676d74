"""The package reaches the executors' Python from any working directory."""

import os
import pathlib
import subprocess
import sys

JOB = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from quakespark.session import ship_package
ship_package(spark)
ship_package(spark)

def where(batches):
    for batch in batches:
        import quakespark.operators.raytrace as r
        yield batch.assign(path=r.__file__)

print("FOUND", spark.range(2).mapInPandas(where, "id bigint, path string").collect()[0].path)
"""


def test_from_another_folder(tmp_path):
    repo = str(pathlib.Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", JOB.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND" in out.stdout and "quakespark.zip" in out.stdout, out.stderr[-2000:]
