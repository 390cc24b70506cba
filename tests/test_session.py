"""The shared folder of a session: named, or unset on one machine and on a cluster."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from avionyx import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Cluster:
    """A session of a standalone cluster, as far as the shared folder goes."""

    def __init__(self, **conf):
        self.conf = {k.replace("__", "."): v for k, v in conf.items()}
        self.sparkContext, self.master, self.folder = self, "spark://head:7077", None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("folder", ["/mnt/shared/checkpoints", "file:///mnt/shared/checkpoints", "hdfs://head/checkpoints"])
def test_named_folder_of_a_cluster_is_taken(folder):
    assert session.checkpoint_dir(_Cluster(spark__checkpoint__dir=folder)) == folder


def test_cluster_without_a_folder_uses_its_warehouse():
    cluster = _Cluster(spark__sql__warehouse__dir="file:/mnt/shared/warehouse/")
    assert session.checkpoint_dir(cluster) == "file:/mnt/shared/warehouse/_checkpoints" == session.checkpoint_dir(cluster)


def _with_master(master, **conf):
    out = _Cluster(**conf)
    out.master = master
    return out


def test_executors_of_a_local_cluster_do_not_share_a_temporary_folder():
    cluster = _with_master("local-cluster[3,2,3000]", spark__sql__warehouse__dir="file:/mnt/shared/warehouse")
    assert session.checkpoint_dir(cluster) == "file:/mnt/shared/warehouse/_checkpoints"


@pytest.mark.parametrize("master", ["local", "local[2]", "local[*]", "local[4,2]"])
def test_one_process_uses_a_temporary_folder(master, tmp_path, monkeypatch):
    monkeypatch.setattr(session.tempfile, "tempdir", str(tmp_path))
    assert session.checkpoint_dir(_with_master(master)).startswith(str(tmp_path))


RUN = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from avionyx.session import materialize
rows = materialize(spark.range(5)).count(), materialize(spark.range(7)).count()
print("rows", *rows)
"""


def test_session_without_a_named_folder(tmp_path):
    """As a plain Spark session has it: no ``spark.checkpoint.dir`` at all."""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT, "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", RUN], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 5 7" in done.stdout, done.stderr[-2000:]
