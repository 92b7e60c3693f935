"""The shared folder: named by the cluster, made up only in local mode."""

from types import SimpleNamespace

import pytest

from attrspark import session as S


def fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_cluster_names_the_folder():
    assert S.shared_folder(fake("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert S.scratch_path(fake("/shared", "yarn"), "x").startswith("/shared/attrspark/x-")


def test_a_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError):
        S.shared_folder(fake(None, "yarn"))


def test_a_local_session_gets_one_folder():
    assert S.shared_folder(fake(None, "local[2]")) == S.shared_folder(fake(None, "local[2]"))


def test_scratch_paths_differ(spark):
    assert S.scratch_path(spark, "a") != S.scratch_path(spark, "a")
