"""The shared folder and the scopes of intermediate tables."""

import threading
from types import SimpleNamespace

import pytest

from flowmill import session
from flowmill.session import materialize, new_path, scratch


def fake(master, application="app-1", folder=None):
    conf = SimpleNamespace(get=lambda name, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=application))


def test_folder_that_is_not_set():
    one = session.shared_dir(fake("local[4]"))
    assert one == session.shared_dir(fake("local[4]")) != session.shared_dir(fake("local", "app-2"))
    assert session.shared_dir(fake("yarn", folder="/shared/")) == "/shared"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))


def test_scopes_of_threads_are_apart(spark):
    inside, done = threading.Event(), threading.Event()
    kept = []

    def other():
        inside.wait(60)
        kept.append(materialize(spark.range(5), "other"))
        done.set()

    thread = threading.Thread(target=other)
    thread.start()
    with scratch(spark):
        own = materialize(spark.range(3), "own")
        inside.set()
        assert done.wait(120)
        with scratch(spark):
            inner = new_path(spark, "inner")
            spark.range(2).write.parquet(inner)
        assert own.count() == 3
        with pytest.raises(Exception):
            spark.read.parquet(inner)
    thread.join()
    assert kept[0].count() == 5
    with pytest.raises(Exception):
        own.count()
