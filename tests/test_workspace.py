import pytest

from sluice import workspace


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D401 - mimics RuntimeConfig.get
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Ctx:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, ckpt=None):
        self.conf = _Conf({"spark.checkpoint.dir": ckpt} if ckpt else {})
        self.sparkContext = _Ctx(master)


def test_uses_the_session_folder():
    assert workspace.work_root(_Session("yarn", "hdfs:///shared/ckpt/")) == "hdfs:///shared/ckpt"
    assert workspace.new_dir(_Session("yarn", "s3a://b/c"), "stage").startswith("s3a://b/c/sluice/stage/")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.work_root(_Session("yarn"))


def test_local_session_gets_a_folder_and_keeps_its_settings():
    s = _Session("local[2]")
    root = workspace.work_root(s)
    assert workspace.work_root(s) == root
    assert s.conf == {} and s.sparkContext.dir is None  # the session is the caller's
