"""The shared folder comes from the session; what is written there is read back whole."""

import subprocess
import sys
import os

from corpusloom.session import materialize, scratch_path, shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from corpusloom.session import materialize, shared_dir
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
assert shared_dir(spark).endswith(sys.argv[1]), shared_dir(spark)
df = materialize(spark.range(3), "kept")
assert df.inputFiles()[0].replace("file://", "").startswith(sys.argv[1]), df.inputFiles()
assert df.count() == 3
spark.stop()
"""


def test_configured_folder_is_used_and_left_clean(tmp_path):
    path = str(tmp_path / "shared")
    env = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT, path], capture_output=True, text=True, timeout=120, env=env)
    assert done.returncode == 0, done.stderr[-2000:]
    left = [n for n in os.listdir(path) if n.startswith("corpusloom-")] if os.path.isdir(path) else []
    assert left == []


def test_scratch_paths_are_new(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))
    df = spark.createDataFrame([(1, None), (2, ["a"])], "i int, a array<string>")
    back = materialize(df)
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
