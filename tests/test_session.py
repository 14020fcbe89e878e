from types import SimpleNamespace

import pytest

from leakwatch import session


@pytest.mark.parametrize("master", ["yarn", "k8s://host", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    unset = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master=master)))


def test_a_named_folder_is_used_anywhere():
    named = SimpleNamespace(get=lambda key, default=None: "hdfs://shared/" if key == "spark.checkpoint.dir" else default)
    held = SimpleNamespace(conf=named, sparkContext=SimpleNamespace(master="yarn"))
    assert session.shared_root(held) == "hdfs://shared"


def test_one_machine():
    assert session.is_one_machine("local") and session.is_one_machine("local[8]") and not session.is_one_machine("local-cluster[1,1,1]")
