import pytest

from pointstream.storage import shared_folder, shared_root


class Context:
    def __init__(self, master, folder=None):
        self.master = master
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_named_folder_is_used():
    assert shared_root(Session("yarn", "hdfs:///shared/ck/")) == "hdfs:///shared/ck"
    assert shared_root(Session("yarn", folder="hdfs:///other")) == "hdfs:///other"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_root(Session("spark://host:7077"))


def test_local_session_gets_one_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    session = Session("local[2]")
    root = shared_root(session)
    assert shared_root(session) == root
    first, second = shared_folder(session, "a"), shared_folder(session, "a")
    assert first.startswith(f"{root}/pointstream/a-") and first != second
