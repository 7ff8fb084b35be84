"""Session construction and the shared checkpoint folder.

On a cluster the session comes configured: ``spark.checkpoint.dir`` names a
shared folder and shuffle sizing is set for the data.  Locally (tests, bench)
``get_session`` fills in only what is unset.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only when the key is not already set on the builder/cluster.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MiB splits keep scan tasks well inside executor memory at any scale.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


# Shuffle files of a query go when it ends, not when the driver happens to collect garbage:
# what a chain of steps needs on disk are its tables and the shuffles of one step.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DEFAULTS[TIDY] = "true"


def tidy(spark: SparkSession) -> None:
    """Set :data:`TIDY` in a session that was built elsewhere, unless that session has set it."""
    if spark.conf.get(TIDY, None) is None:
        spark.conf.set(TIDY, "true")


# Stored tables are read far less often than they are moved: ids that count up pack well.
PACKED = {"compression": "zstd"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelflife", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with local-friendly defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    b = b.master(master or os.environ.get("SHELFLIFE_MASTER", "local[*]"))
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the session (``spark.checkpoint.dir``, which the cluster sets to
    a shared folder).  A local session without one gets a fresh scratch folder;
    on a cluster that is an error, because executors do not share local disks.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all "
                               "executors share")
        d = tempfile.mkdtemp(prefix="shelflife-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the program ends."""
    if not _scratch:
        atexit.register(drop_scratch)
    path = f"{checkpoint_dir(spark).rstrip('/')}/shelflife-{tag}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def drop_scratch() -> None:
    """Remove the folders handed out by :func:`scratch_path`; needs a live session."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)
