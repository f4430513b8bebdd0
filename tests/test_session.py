from types import SimpleNamespace

import pytest

from tidewatch.session import ensure_checkpoint_dir


def fake(master, found):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: found.get("dir"),
                              getConf=lambda: SimpleNamespace(get=lambda key, default: default),
                              setCheckpointDir=lambda path: found.update(dir=path))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "yarn", "spark://host:7077"])
def test_a_cluster_has_to_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake(master, {}))
    assert ensure_checkpoint_dir(fake(master, {"dir": "/shared"})) == "/shared"


@pytest.mark.parametrize("master", ["local", "local[8]"])
def test_a_local_session_may_use_a_scratch_folder(master):
    assert "tidewatch-ckpt-" in ensure_checkpoint_dir(fake(master, {}))
