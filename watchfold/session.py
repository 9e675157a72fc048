"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces partitions from
# runtime statistics; skew-join splitting covers a hot contract or user.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every Column function by default:
    # a few JVM round trips per call, most of a plan's build time on the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "watchfold",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones); locally pass ``local[N]`` and about N.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used. Only a session in one process (``local`` or ``local[n]``: tests, the
    bench) without it gets a fresh temporary folder, removed at exit; any other
    session without it is an error.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir() or current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        # A folder on one machine is lost with it; a cluster must name a shared one.
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
    local = tempfile.mkdtemp(prefix="watchfold-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts]) if parts else base

