import pytest

from caselake.session import bounded, new_path, shared_folder, spread, written


class Session:
    """The two things the folder is taken from."""

    def __init__(self, setting, master, folder=None):
        self.setting, self.master, self.folder = setting, master, folder
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_named_folder_is_used():
    assert shared_folder(Session("hdfs://x/ckpt/", "yarn", "other")) == "hdfs://x/ckpt"
    assert shared_folder(Session(None, "yarn", "hdfs://x/ckpt/1")) == "hdfs://x/ckpt/1"


def test_a_cluster_without_a_folder_is_an_error():
    session = Session(None, "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
    assert session.folder is None


def test_local_mode_falls_back_once():
    session = Session(None, "local[2]")
    assert shared_folder(session) == shared_folder(session) == session.folder


def test_written_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    again = written(df, "t")
    assert again.exceptAll(df).count() == 0 and again.schema == df.schema
    assert new_path(spark, "t") != new_path(spark, "t")


def test_bounded_broadcasts_only_small_tables(spark):
    big, small = spark.range(1000), spark.range(20).withColumnRenamed("id", "k")

    def plan(side):
        return big.join(side, big.id == side.k)._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(bounded(small, 20))
        assert "SortMergeJoin" in plan(bounded(small, 19))
        assert bounded(small, 19).count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 9)
    assert spread(wide, "id") is wide
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
