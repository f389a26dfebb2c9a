from types import SimpleNamespace

import pytest

from pageloom.llm.storage import saved, shared_dir


def _session(master, named=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda folder: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_folder_of_a_cluster_must_be_named():
    with pytest.raises(ValueError):
        shared_dir(_session("spark://host:7077"))
    assert shared_dir(_session("spark://host:7077", "hdfs://store/tmp")) == "hdfs://store/tmp"
    assert shared_dir(_session("local[2]"))


def test_saved_keeps_rows(spark):
    assert saved(spark.range(3)).count() == 3 and saved(spark.range(0)).count() == 0
