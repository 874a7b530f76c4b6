"""Parquet target table: scan (S4) and partition sink with dynamic overwrite.

The sink writes all touched ``dt`` partitions of a frame in one job. With
``partitionOverwriteMode=dynamic`` only those partitions are replaced, at job
commit, so a failed job leaves the previous table in place and a rerun is
idempotent. A ``rebalance`` on ``dt`` before the write makes each task hold
(mostly) one day: adaptive execution splits a hot day into several tasks
of the advisory size and merges small days, so the file count follows the
data volume instead of ``tasks x days``.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

PARTITION_COL = "dt"


LEGACY = "spark.sql.parquet.writeLegacyFormat"


@contextmanager
def _legacy(spark: SparkSession, value: bool | None):
    """The session's legacy switch, for one write only."""
    if value is None:
        yield
        return
    before = spark.conf.get(LEGACY)
    spark.conf.set(LEGACY, str(bool(value)).lower())
    try:
        yield
    finally:
        spark.conf.set(LEGACY, before)


def observed(seen: Observation) -> dict:
    """What was observed; nothing if there was no row at all and adaptive
    execution has dropped the observation with the plan."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


def write_partitions(df: DataFrame, table_path: str, partition_col: str = PARTITION_COL,
                     rebalance: bool = True, legacy_format: bool | None = None) -> set[str | None]:
    """Replace exactly the ``dt`` partitions present in ``df``; returns their
    values (one per day, observed during the write)."""
    spark = df.sparkSession
    configure(spark)
    out, seen = df, None
    if partition_col in df.columns:
        seen = Observation(f"days-{uuid.uuid4().hex}")
        day = F.col(partition_col)
        out = out.observe(seen, F.collect_set(day).alias("days"), F.count(F.when(day.isNull(), 1)).alias("nulls"))
    if rebalance and partition_col in df.columns:
        out = out.hint("rebalance", partition_col)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_col in df.columns:
        w = w.partitionBy(partition_col)
    with _legacy(spark, legacy_format):
        w.parquet(table_path)
    if seen is None:
        return set()
    got = observed(seen)
    if not got:
        return set()
    return set(got["days"] or []) | ({None} if got["nulls"] else set())


def read_table(spark: SparkSession, table_path: str, schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """Read the target table. Pass the stored table schema (``schema``) to see
    columns added in newer partitions without merging every footer."""
    configure(spark)
    r = spark.read.option("mergeSchema", str(bool(merge_schema)).lower())
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(table_path)
