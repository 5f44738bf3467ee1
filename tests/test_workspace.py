from types import SimpleNamespace

import pytest

from topicframe import workspace


def _session(master, named=None):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_session_names_the_folder():
    assert workspace.shared_dir(_session("spark://x", "s3a://shared/dir/")) == "s3a://shared/dir"
    assert workspace.shared_dir(_session("local[2]", "/named")) == "/named"


def test_only_a_local_session_may_leave_it_open():
    with pytest.raises(ValueError, match="shared by all executors"):
        workspace.shared_dir(_session("yarn"))
    assert workspace.shared_dir(_session("local[2]")) == workspace.shared_dir(_session("local[*]"))


def test_paths_are_never_shared():
    session = _session("local[2]", "/named")
    first, second = workspace.fresh_path(session, "a b"), workspace.fresh_path(session, "a b")
    assert first != second and first.startswith("/named/")


def test_a_held_table_is_computed_once(spark):
    from pyspark.sql import functions as F

    held = workspace.hold(spark.range(3).withColumn("u", F.uuid()), "held")
    assert {r.u for r in held.collect()} == {r.u for r in held.collect()}
