"""Where intermediate tables go."""

import pytest

from terrane.llm import storage


class Session:
    def __init__(self, **conf):
        self.held, self.conf = conf, self

    def get(self, key, default=None):
        return self.held.get(key, default)


def test_the_named_folder_goes_first():
    for master in ("local[2]", "local-cluster[2,1,1024]", "yarn"):
        assert storage.shared_dir(Session(**{"spark.checkpoint.dir": "hdfs://x/y/", "spark.master": master})) == "hdfs://x/y"


def test_only_a_local_session_gets_a_folder_of_its_own():
    for master in ("local", "local[4]", "local[*]"):
        session = Session(**{"spark.master": master, "spark.app.id": master})
        assert storage.shared_dir(session) == storage.shared_dir(session)
    for master in ("local-cluster[3,2,3000]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError):
            storage.shared_dir(Session(**{"spark.master": master, "spark.app.id": "1"}))


def test_saved_without_a_named_folder(spark, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda s, named=storage.shared_dir: named(Session(**{"spark.master": "local[4]", "spark.app.id": "2"})))
    assert storage.saved(spark.range(5), "five").count() == 5
