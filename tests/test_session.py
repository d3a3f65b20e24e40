"""The shared working folder and the shuffle sizes."""

from types import SimpleNamespace

import pytest

from cambio.session import shuffle_settings, work_dir


def session(master, shared=None, application="app-1"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master, applicationId=application),
    )


def test_the_folder_comes_from_the_session():
    a, b = (work_dir(session("yarn", "hdfs:///shared/"), "staging") for _ in range(2))
    assert a.startswith("hdfs:///shared/staging-") and a != b


def test_a_cluster_never_uses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session("yarn"), "staging")


def test_a_local_master_may():
    a, b = (work_dir(session("local[2]"), "staging") for _ in range(2))
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]


def test_shuffle_sizes():
    assert shuffle_settings(1)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    assert shuffle_settings(10_240)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "81920"
