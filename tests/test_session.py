"""The shared checkpoint folder: read from the session, set only in local mode."""

from types import SimpleNamespace

import pytest

from evidentia.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)

    def set(self, k, v):
        self[k] = v


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


def _session(master, conf=None):
    return SimpleNamespace(conf=_Conf(conf or {}), sparkContext=_Context(master))


def test_cluster_setting_used_as_is():
    s = _session("spark://head:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_cluster_without_setting_is_refused():
    s = _session("yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(s)
    assert "spark.checkpoint.dir" not in s.conf


def test_local_without_setting_gets_scratch_folder():
    s = _session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.conf["spark.checkpoint.dir"] == d and s.sparkContext.dir == d
    assert ensure_checkpoint_dir(s) == d


def test_sized_conf():
    from evidentia.session import sized_conf
    c = sized_conf(shuffle_bytes=100 * 1024 ** 4, slots=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (200 * 1024 ** 2)
    assert sized_conf(shuffle_bytes=1, slots=8)["spark.sql.shuffle.partitions"] == "16"
    assert int(c["spark.sql.execution.arrow.maxBytesPerBatch"]) == 64 * 1024 ** 2
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_sized_conf_applies_to_a_pandas_udf(spark):
    """The byte cap is accepted by this Spark and a pandas UDF still sees every row."""
    from evidentia.functions.text import normalize_text
    from evidentia.session import sized_conf
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "4096")
    try:
        df = spark.range(2000).selectExpr("id", "repeat('ﬁx ', 100) AS text")
        out = df.select(normalize_text("text").alias("t")).where("t = repeat('fix ', 100)")
        assert out.count() == 2000
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
    assert key in sized_conf(1, 1)
