"""The shared folder: taken from the session, given out once, dropped on request."""

import os

from jobmart import session


def test_shared_folders_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    path = session.shared_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.shared_dir(spark, "x") != path
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    assert session.drop_shared(spark) == 1  # the other folder was never written
    assert not os.path.exists(path) and session.drop_shared(spark) == 0
