from kgspark import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master = master


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


def test_scratch_root_needs_a_shared_folder_on_a_cluster():
    import pytest

    assert session.scratch_root(_Session("local[2]")) == session.scratch_root(_Session("local[2]"))
    with pytest.raises(RuntimeError):
        session.scratch_root(_Session("spark://host:7077"))


def test_cut_survives_and_is_dropped(spark):
    df = session.cut(spark.range(3), "t")
    assert df.count() == 3
    session.drop_cuts(spark)
    assert session.cut(spark.range(2), "t").count() == 2


def test_scratch_is_deleted_and_what_lies_outside_stays(spark):
    import os

    with session.scratch(spark):
        inner = session.cut(spark.range(3), "t")
        outside = session.cut_path(spark, "kept", inner=False)
        inner.write.parquet(outside)
        path = inner.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert os.path.exists(path)
    assert not os.path.exists(path) and spark.read.parquet(outside).count() == 3
