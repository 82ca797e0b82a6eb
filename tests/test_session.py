"""The shared scratch folder."""

from types import SimpleNamespace

import pytest

from policylens.session import ensure_checkpoint_dir, workers_import_this


def fake(master, configured=None, current=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, environment={})
    sc.setCheckpointDir = lambda path: setattr(sc, "getCheckpointDir", lambda: path)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: configured or default))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake(master))
    assert ensure_checkpoint_dir(fake(master, configured="hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(fake(master, current="hdfs:///set")) == "hdfs:///set"


def test_a_local_session_gets_a_folder(monkeypatch, tmp_path):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    assert ensure_checkpoint_dir(fake("local[2]")).startswith(str(tmp_path))


def test_workers_get_the_package_folder_once():
    session = fake("local[2]")
    workers_import_this(session)
    first = dict(session.sparkContext.environment)
    workers_import_this(session)
    assert session.sparkContext.environment == first and first["PYTHONPATH"]
