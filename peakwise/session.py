"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Settings the operators are designed for.  AQE coalesces shuffle partitions and splits
#: skewed joins; ``forceOptimizeSkewedJoin`` accepts one more shuffle to split a hot key.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Paths handed out, by application.
_made: dict[str, list[str]] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without that setting: all its tasks share one machine, and the
    path is below the session's warehouse.  :func:`release` removes what was written.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove everything written to paths of :func:`shared_path` in this application.

    Call it when the results are written: frames that read those tables can no longer run.
    Returns how many paths there were.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
