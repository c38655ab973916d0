"""Session construction and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale; a cluster deployment overrides
# shuffle partitions and file split size from its own defaults.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "claimflow") -> SparkSession:
    """Return the active session, or build one for local runs and tests."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CLAIMFLOW_DRIVER_MEMORY", "16g"))
    if master and master.startswith("local"):
        builder = builder.config("spark.checkpoint.dir",
                                 tempfile.mkdtemp(prefix="claimflow-ckpt-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    for getter in (lambda: spark.conf.get("spark.checkpoint.dir", None),
                   lambda: spark.sparkContext.getConf().get("spark.checkpoint.dir", None)):
        try:
            value = getter()
        except Exception:  # pragma: no cover - conf access differs by deploy mode
            value = None
        if value:
            return value
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts: the one the cluster names, else the one
    the caller has set, else, in local runs only, a scratch folder. Executors
    of a cluster don't share the driver's disk, so there a missing setting is
    an error."""
    sc = spark.sparkContext
    value = checkpoint_dir(spark)
    if value is None:
        value = sc.getCheckpointDir()
        if value is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            value = tempfile.mkdtemp(prefix="claimflow-ckpt-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(value)
    return value


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written stage table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what several steps
    read is computed once, its lineage ends, and nothing stays cached."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
