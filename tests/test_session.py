import pytest

from strata import session


class Conf(dict):
    pass


class FakeSession:
    """Stands for a session on a master that the tests cannot have."""

    def __init__(self, master, conf=(), checkpoint=None):
        self.conf = Conf(conf)
        self.sparkContext = self
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://host:7077"))


def test_folder_comes_from_the_setting():
    named = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.scratch_path(named, "x").startswith("hdfs:///shared/strata/x-")


def test_written_frames_keep_schema_and_rows(spark):
    df = spark.range(5).selectExpr("id", "struct(id AS a) AS s")
    out = session.written(df, "t")
    assert out.schema.simpleString() == df.schema.simpleString() and out.count() == 5


def test_settings_from_the_session_may_be_zero(spark):
    from strata.conf import PipelineConf

    spark.conf.set("max_files_per_trigger", "0")
    try:
        assert PipelineConf.from_session(spark, source_path="", table_path="", checkpoint_path="").max_files_per_trigger == 0
    finally:
        spark.conf.unset("max_files_per_trigger")


def test_a_managed_table_is_not_declared_away(spark):
    import pytest

    from strata.sources import register_table, replace_table

    spark.sql("DROP TABLE IF EXISTS strata_managed")
    stored = replace_table(spark.range(3), "strata_managed")
    with pytest.raises(ValueError):
        register_table(spark, "strata_managed", stored.schema, "/nowhere")
    assert spark.read.table("strata_managed").count() == 3
    spark.sql("DROP TABLE strata_managed")
