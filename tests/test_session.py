from types import SimpleNamespace

import pytest

from skytally import session
from skytally.session import work_dir


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_dir_is_the_shared_folder():
    a, b = (work_dir(fake("spark://host:7077", "hdfs://x/checkpoints/"), "late") for _ in range(2))
    assert a.startswith("hdfs://x/checkpoints/late-") and a != b


def test_folder_must_be_named():
    for master in ("spark://host:7077", "local[2]"):
        with pytest.raises(ValueError, match="checkpoint"):
            work_dir(fake(master), "late")


def test_named_folder_counts_where_the_setting_is_missing(monkeypatch):
    monkeypatch.setattr(session, "_work_base", None)
    session.use_work_folder("/named")
    assert work_dir(fake("local[2]"), "late").startswith("/named/late-")
    assert work_dir(fake("local[2]", "hdfs://x"), "late").startswith("hdfs://x/late-")
