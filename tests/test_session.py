"""Scratch folders without ``spark.checkpoint.dir``, in a session of its own."""

import os
import subprocess
import sys
from pathlib import Path

from latewatch.operators import ranking as R

JOB = """
from pyspark.sql import SparkSession
from latewatch.session import checkpoint_root, scratch_path
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
assert a != b and a.startswith(checkpoint_root(spark))
spark.range(3).write.parquet(a)
try:
    from latewatch.llm.common import written
except ModuleNotFoundError:
    pass
else:
    assert written(spark.range(4), "y").count() == 4
print("rows", spark.read.parquet(a).count())
"""


def test_a_local_session_without_a_checkpoint_folder(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1]), "TMPDIR": str(tmp_path)}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    found = subprocess.run([sys.executable, "-c", JOB], env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3" in found.stdout, found.stderr[-2000:]


def test_weather_split_is_ordered(spark):
    df = spark.createDataFrame([(True, 1), (None, 2), (False, 3)], "is_raining boolean, stop_events long")
    assert [r.is_raining for r in R.weather_split(df).collect()] == [None, False, True]
