"""SparkSession construction and cluster-aware helpers.

On a cluster the session is created by the launcher and its settings win;
``configure`` only fills in what is unset. Intermediate tables go to the
shared folder in ``spark.checkpoint.dir``; only a local session may go without.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on; a value the session already has is kept.
LIBRARY_CONF = {
    # Day boundaries, hour bands and epoch conversions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # decode(x, 'GBK') for the charset fallback needs the JVM charsets.
    "spark.sql.legacy.javaCharsets": "true",
    # Runtime re-planning: partition coalescing, skew-join splitting and
    # runtime broadcast conversion from measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static INSERT OVERWRITE ... PARTITION (stat_date = d) replaces one day.
    "spark.sql.sources.partitionOverwriteMode": "static",
}
# A setting with a default never reads as unset; this one counts as set by the launcher only if it is no default.
CHARSETS = "spark.sql.legacy.javaCharsets"


def get_session(master: str | None = None, app_name: str = "adsift",
                shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Return the active session, or build one (local mode for tests)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return configure(active)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in LIBRARY_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply library settings that neither the launcher nor the session sets yet."""
    given = spark.sparkContext.getConf()
    for key, value in LIBRARY_CONF.items():
        now = spark.conf.get(key, None)
        if now is None or (key == CHARSETS and given.get(key) is None and now != value):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    A local session without one gets a fresh scratch folder; on a cluster its
    absence is an error, as a machine's own folder is of no use there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not (sc.master or "").startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="adsift-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once their results are consumed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "tables"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
