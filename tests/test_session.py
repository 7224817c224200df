from types import SimpleNamespace

import pytest

from silverlode.session import scratch_path, scratch_root, stash


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master)
    )


def test_configured_folder_wins():
    assert scratch_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_path(fake("yarn", "hdfs:///shared"), "x").startswith("hdfs:///shared/silverlode/x-")


def test_unset_folder_is_an_error_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(fake("spark://host:7077"))


def test_unset_folder_is_temporary_in_local_mode():
    assert scratch_root(fake("local[2]")) == scratch_root(fake("local[*]"))


def test_stash_keeps_rows_and_cuts_the_plan(spark):
    df = spark.range(10).selectExpr("id", "id * 2 as twice")
    stored = stash(df, "test")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
