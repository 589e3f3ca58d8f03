import os
from types import SimpleNamespace

import pytest

from loamline import session as s


def test_local_masters():
    assert all(s.is_local(m) for m in ("local", "local[4]", "local[*, 3]"))
    assert not any(s.is_local(m) for m in ("local-cluster[2,1,1024]", "spark://h:7077", "yarn", "k8s://https://h", "localhost"))


def run_of(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: folder or default), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))


def test_clusters_need_a_shared_folder():
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        far = run_of(master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            s.new_dir(far, "t")
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            s.checkpointed(SimpleNamespace(sparkSession=far))
    assert s.shared_root(run_of("yarn", "hdfs://n/c/")) == "hdfs://n/c"
    near = run_of("local")
    assert s.shared_root(near).startswith("file:///") and s.shared_root(near) == s.shared_root(near)


def test_written_tables_go(spark):
    df = s.written(spark.range(10), "t")
    (uri,) = [u for u in s.MADE if u == df._loamline_path]
    assert df.count() == 10
    s.dropped(df)
    assert uri not in s.MADE and not os.path.exists(uri.removeprefix("file://"))


def test_unused_names(spark):
    df = spark.range(1).selectExpr("1 as _a", "2 as __A")
    assert s.unused("_a", df) == "___a" and s.unused("b", df) == "b"
