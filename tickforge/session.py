"""Session helpers.

The library never creates a cluster session on its own; callers pass theirs.
``local_session`` exists for tests and the bench. ``checkpoint_dir`` reads the
shared folder the cluster names in ``spark.checkpoint.dir``; without the setting a local
master gets a scratch folder and any other an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the operators rely on: UTC wall clock (timestamp adapters
# and the SQL oracle both assume it) and adaptive execution for skewed joins.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
# Rows of many computed columns make generated methods of more bytes than the JVM compiles (8,000 on HotSpot); up
# to its own limit of 65,535 the engine lets them run interpreted, row by row. Above this one it splits them instead.
DEFAULT_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on (UTC session time zone), and the limit of generated methods
    where the session has none of its own."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tickforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("TICKFORGE_DRIVER_MEM", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[int, str] = {}
_SCRATCH: dict[int, list[str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``. Only a local master may
    go without: it gets a scratch folder, remembered per SparkContext. On a cluster a
    machine-local folder would hide files from other executors, so a missing setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master {master})")
        key = id(spark.sparkContext)
        d = _FALLBACK.get(key) or tempfile.mkdtemp(prefix="tickforge-ckpt-")
        _FALLBACK[key] = d
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    _SCRATCH.setdefault(id(spark.sparkContext), []).append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class scratch_scope:
    """Context manager for a job: removes, at its end, the intermediates written to the shared
    folder inside it. Results have to be written or collected before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = len(_SCRATCH.setdefault(id(self.spark.sparkContext), []))
        return self

    def __exit__(self, *exc):
        paths = _SCRATCH[id(self.spark.sparkContext)]
        for path in paths[self.before:]:
            remove_path(self.spark, path)
        del paths[self.before:]
        return False


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the session's file systems are closed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts lineage, survives executor loss, computes the input once
    (an eager reliable checkpoint would run the input plan twice). The files go with their
    ``scratch_scope``, or else with the session."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
