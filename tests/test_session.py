"""The shared folder for lineage cuts."""
import pytest

from claimflow import session


class Context:
    def __init__(self, master, conf=None, own=None):
        self.master, self.conf, self.own = master, conf or {}, own

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, path):
        self.own = path


class Session:
    def __init__(self, *args, **kw):
        self.sparkContext = Context(*args, **kw)
        self.conf = {}


def test_cluster_without_a_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session(master))


def test_named_folder_wins_and_a_set_one_is_kept():
    s = Session("yarn", {"spark.checkpoint.dir": "hdfs://a/b"})
    assert session.ensure_checkpoint_dir(s) == "hdfs://a/b" == s.sparkContext.own
    s = Session("yarn", own="hdfs://mine")
    assert session.ensure_checkpoint_dir(s) == "hdfs://mine" == s.sparkContext.own


def test_local_run_gets_a_scratch_folder():
    s = Session("local[2]")
    assert session.ensure_checkpoint_dir(s) == s.sparkContext.own


def test_written_stage_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "array(id) as a", "cast(null as string) as s")
    out = session.write_stage(df, "t")
    assert out.dtypes == df.dtypes and sorted(r.id for r in out.collect()) == list(range(10))
