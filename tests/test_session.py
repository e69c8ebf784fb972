"""Shared-folder rules: never a machine-local folder on a cluster."""

import pytest

from sortproof.session import checkpoint_root, scratch_path


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key):
        if key not in self.values:
            raise KeyError(key)
        return self.values[key]


class _Session:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext = _Ctx(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_cluster_setting_is_read_from_the_session():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    assert checkpoint_root(s) == "hdfs://nn/ckpt"
    assert scratch_path(s, "sorted").startswith("hdfs://nn/ckpt/sortproof/sorted-")
    assert checkpoint_root(_Session("k8s://x", ckpt="s3a://b/ck")) == "s3a://b/ck"


def test_local_session_gets_its_own_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    s = _Session("local[2]")
    root = checkpoint_root(s)
    assert root.startswith(str(tmp_path)) and checkpoint_root(s) == root


def test_scratch_tables_can_be_cleared(spark, records_df):
    import os

    from sortproof.operators.sort import rank_records
    from sortproof.session import clear_scratch, scratch_path, write_and_read

    clear_scratch(spark)
    rank_records(records_df([(1, "a", "b", "c")]), "id").collect()
    path = scratch_path(spark, "own")
    write_and_read(records_df([(1, "a", "b", "c")]), path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert clear_scratch(spark) == 2 and not os.path.exists(local) and clear_scratch(spark) == 0
