"""The shared checkpoint folder: read from the session; a private temp folder
only in local mode."""

import os
import subprocess
import sys

import pytest

from voltaic.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    """Just enough of a SparkSession (a Connect-like one: no SparkContext)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_setting_is_used_as_is():
    s = _Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert scratch_path(s, "stage").startswith("hdfs://nn/shared/ckpt/stage-")


def test_cluster_without_setting_raises():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session({"spark.master": "k8s://https://api:443"}))


def test_plain_local_session_runs_the_sinks(tmp_path):
    """A real session of its own, without any Spark configuration, writes and checks tables."""
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
from voltaic.plans.catalog import QUERIES
from voltaic.session import checkpoint_root
print("ROWS", QUERIES["SNK-5"](spark, SF).count(), QUERIES["QC-8"](spark, SF).count(), checkpoint_root(spark) == checkpoint_root(spark))
""".replace("SF", repr("/root/testdata/sf0.001"))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000 6 True" in done.stdout, done.stderr[-2000:]
