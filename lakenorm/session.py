"""Session settings the engine relies on, and the shared scratch location.

Every public job calls :func:`configure` first. The settings are the ones a
Spark user would put into ``spark-defaults.conf`` for this kind of job:

* ``spark.sql.caseSensitive=true`` - JSON with ``Foo`` and ``foo`` side by side
  can only be read and merged when names are case sensitive.
* ``spark.sql.sources.partitionColumnTypeInference.enabled=false`` - keeps
  ``dt=00000000`` / ``dt=20240101`` a string.
* ``spark.sql.sources.partitionOverwriteMode=dynamic`` - an overwrite replaces
  only the ``dt`` partitions present in the written frame.
* adaptive execution on, so shuffle sizes follow the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session (idempotent)."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "lakenorm") -> SparkSession:
    """Local session for tests and the benchmark (a cluster brings its own)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the distributed location every executor can reach. A
    session without it is an error: a folder made here would be on the driver's
    disk, out of the executors' reach (tests and the bench set one of their own).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/lakenorm/{label}-{uuid.uuid4().hex[:12]}"
