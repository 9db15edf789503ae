"""Checkpoint-folder lookup: read from the session, fall back only when unset."""

import pytest

from tickforge import session as S


class _Conf:
    def __init__(self, value=None, settable=True):
        self.value, self.settable = value, settable

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):
        if not self.settable:
            raise RuntimeError("CANNOT_MODIFY_CONFIG")
        self.value = value


class _SC:
    def __init__(self, master="local[4]"):
        self.dir, self.master = None, master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, conf):
        self.conf, self.sparkContext = conf, _SC()


def test_uses_configured_folder():
    sp = _Spark(_Conf("hdfs://shared/ckpt"))
    assert S.checkpoint_dir(sp) == "hdfs://shared/ckpt"
    assert S.scratch_path(sp, "x") == "hdfs://shared/ckpt/x"


def test_fallback_when_unset_even_if_conf_is_read_only():
    sp = _Spark(_Conf(None, settable=False))
    d1 = S.checkpoint_dir(sp)
    assert d1 and S.checkpoint_dir(sp) == d1      # stable per context
    assert sp.sparkContext.getCheckpointDir() == d1


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_the_setting(master):
    sp = _Spark(_Conf(None))
    sp.sparkContext = _SC(master)
    with pytest.raises(RuntimeError):
        S.checkpoint_dir(sp)


def test_scratch_scope_removes_its_intermediates(spark):
    import os
    with S.scratch_scope(spark):
        t = S.materialize(spark.range(5), "t-scope")
        path = os.path.dirname(t.inputFiles()[0].removeprefix("file://"))
        assert t.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


def test_wide_rows_run_compiled(spark):
    """Generated methods stay within what the JVM compiles, unless the session has a limit of its own."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit, None)
    try:
        spark.conf.unset(limit)
        S.ensure_conf(spark)
        assert int(spark.conf.get(limit)) <= 8_000
        spark.conf.set(limit, "9000")
        S.ensure_conf(spark)
        assert spark.conf.get(limit) == "9000"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
