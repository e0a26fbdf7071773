"""Session settings and the shared work folder.

Everything that has to outlive a task (staged CSV files, versioned table
snapshots, streaming checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (local tests) do we pick one.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings for the time being; those that the session has set stay."""
    own = spark.conf.getAll
    added = {k: v for k, v in wanted.items() if k not in own}
    try:
        for key, value in added.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session. Only a local-mode session (tests) without one gets
    a folder of its own; on a cluster an unset folder is an error, because a
    driver-local folder is invisible to executors and lost with the driver.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint folder.

    Writers create it; what a session leaves in it goes when the session's
    driver ends.
    """
    base = checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = f"{base}/ledgerline/{leaf}"
    if unique:
        atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # the session was stopped before the driver ended
        return
    try:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # nothing to do about a lost JVM or store at exit
        return
