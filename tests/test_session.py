"""The checkpoint folder: taken from the session, a scratch one for local masters only."""

import os
import subprocess
import sys

import pytest

from tunetrail import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_a_preset_folder(tmp_path):
    code = ("from tunetrail.session import build_session, ensure_checkpoint_dir; s = build_session('local[1]', 1); "
            "d = ensure_checkpoint_dir(s); assert 'tunetrail-ckpt-' in d, d; assert s.range(3).checkpoint().count() == 3; print('fine')")
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "fine" in out.stdout, out.stderr[-2000:]


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, folder=None, conf=None):
        self.sparkContext, self.conf = _Context(master, folder), conf or {}


def test_a_cluster_must_name_its_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(_Session(master))
        assert session.ensure_checkpoint_dir(_Session(master, conf={"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"
    assert session.ensure_checkpoint_dir(_Session("yarn", "hdfs:///set")) == "hdfs:///set"
