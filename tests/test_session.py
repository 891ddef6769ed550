"""Session defaults fill only what is unset; a cluster must name its shared folder."""

import os
import subprocess
import sys

import pytest

from ratewise import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_stay():
    code = ("from ratewise.session import build_session\n"
            "s = build_session('local[1]', shuffle_partitions=4)\n"
            "print([s.conf.get('spark.sql.' + k) for k in ('adaptive.skewJoin.enabled',"
            " 'adaptive.advisoryPartitionSizeInBytes', 'shuffle.partitions', 'session.timeZone')])")
    conf = ["spark.sql.adaptive.skewJoin.enabled=false", "spark.sql.adaptive.advisoryPartitionSizeInBytes=512m",
            "spark.sql.shuffle.partitions=9"]
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": " ".join(f"--conf {c}" for c in conf) + " pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, env=env, capture_output=True, text=True, timeout=180)
    assert "['false', '512m', '9', 'UTC']" in out.stdout, out.stderr[-2000:]


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path

    def getConf(self):
        return {}


class FakeSession:
    def __init__(self, master, conf=()):
        self.sparkContext, self.values = FakeContext(master), dict(conf)
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(FakeSession(master))
    assert session.checkpoint_dir(FakeSession(master, {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_a_local_master_gets_a_folder():
    assert os.path.isdir(session.checkpoint_dir(FakeSession("local[4]")))
