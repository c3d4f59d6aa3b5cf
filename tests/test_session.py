"""The shared working folder and staged tables."""

import os

import pytest

from tickloom import session
from tickloom.session import stage, staging, work_dir


class FakeSession:
    """Only what ``work_dir`` asks of a session."""

    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_the_cluster_names_the_folder():
    fake = FakeSession(**{"spark.checkpoint.dir": "hdfs://x/shared", "spark.master": "yarn"})
    assert work_dir(fake, "a").startswith("hdfs://x/shared/a-")
    assert work_dir(fake, "a") != work_dir(fake, "a")


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(FakeSession(**{"spark.master": "spark://x"}), "a")
    monkeypatch.setattr(session, "_local_root", None)
    local = FakeSession(**{"spark.master": "local[2]"})
    assert os.path.isdir(os.path.dirname(work_dir(local, "a")))


def test_staged_tables_live_as_long_as_their_scope(spark):
    with staging(spark):
        kept = stage(spark.range(5), "kept")
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    assert stage(spark.range(3), "free").count() == 3
