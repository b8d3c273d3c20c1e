"""Staged tables and the shared folder."""

from pathlib import Path

import pytest

from kinloom import session


def test_staged_tables_can_be_deleted(spark):
    df = session.staged(spark.range(10).repartition(3, "id"), "probe")
    path = Path(df._kinloom_staged.removeprefix("file://"))
    assert df.count() == 10 and path.is_dir()
    session.unstage(df, spark.range(1))
    assert not path.exists()
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"


class Cluster:
    """What shared_folder asks of a session whose executors have other disks."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"

        class getConf:
            get = staticmethod(lambda key: None)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)
    assert session.is_local("local[8]") and session.is_local("local")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")
