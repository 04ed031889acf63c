import os
from types import SimpleNamespace

import pytest

from gleanrow.functions import storage


def test_tables_are_kept_and_cleared(spark):
    table = storage.stored(spark.range(5), "five")
    assert table.count() == 5
    path = storage.run_dir(spark).removeprefix("file:")
    assert os.path.isdir(path)
    storage.clear(spark)
    assert not os.path.exists(path)
    assert storage.stored(spark.range(3), "three").count() == 3


def test_scratch_tables_go(spark):
    with storage.scratch(spark):
        kept = storage.run_dir(spark) + "/kept"
        table = storage.stored(spark.range(4), "inner")
        (path,) = {os.path.dirname(f) for f in table.inputFiles()}
        table.write.parquet(kept)
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))
    assert spark.read.parquet(kept).count() == 4
    assert "scratch-" not in storage.new_path(spark, "after")


def test_no_machine_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default: default))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_dir(session)
        session.conf = SimpleNamespace(get=lambda key, default: "hdfs:///shared/")
        assert storage.shared_dir(session) == "hdfs:///shared"
