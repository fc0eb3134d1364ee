"""Session settings the operators rely on, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. Shuffle partition counts are left to the cluster: AQE
# coalesces whatever is configured to the advisory size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Set when the session is built. No Python call site per column expression: it costs
# several JVM calls each.
STARTUP_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "lumentide", **conf: str) -> SparkSession:
    """A session with the settings above; `conf` overrides or extends them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**STARTUP_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    """The setting of the cluster, or the folder given to `setCheckpointDir`."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = own.get() if own.isDefined() else None
    return found


def shared_dir(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A fresh folder below `root`, by default below the cluster's `spark.checkpoint.dir`.

    Executors write there and others read it, so it has to be shared storage. A
    temporary folder of the driver's machine is used only where all tasks run on that
    machine, with a local master; elsewhere a missing setting is an error.
    """
    base = root or _checkpoint_dir(spark)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(
                "no shared folder: pass one, or set spark.checkpoint.dir to a folder that "
                "the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lumentide-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder of shared storage, such as pinned data nobody reads any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def pin(df: DataFrame, purpose: str = "pinned", root: str | None = None) -> DataFrame:
    """Write `df` once to shared storage and read it back.

    Used where several consumers share a small but expensive result. Unlike a
    cached result it is still there after executors are lost, and nothing
    upstream is computed a second time. Give a `root` of your own to remove it later.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose, root)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
