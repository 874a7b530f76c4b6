"""Schemas as tables: the rebuild decision's joins.

A schema becomes a small frame of ``(col_name, data_type)`` rows (one per
column, built on the driver from ``df.schema``); the comparison is a join of
two such frames, as a ``DESCRIBE`` based check would do it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import is_nested, schema_rows

ROWS_SCHEMA = "col_name string, data_type string"


def schema_frame(spark: SparkSession, schema: T.StructType, depth: int | None = None) -> DataFrame:
    """``schema_rows`` as a frame."""
    return spark.createDataFrame(schema_rows(schema, depth), ROWS_SCHEMA)


def root_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Root columns that are not containers, as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields if not is_nested(f.dataType)]
    return spark.createDataFrame(rows, ROWS_SCHEMA)


def nested_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Leaves below root containers (``a___b``, ``a_exploded___b``), as rows."""
    nested = T.StructType([f for f in schema.fields if is_nested(f.dataType)])
    return schema_frame(spark, nested)


def root_diff(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Root columns of both schemas side by side (J2): ``col_name, old, new,
    compatible``. Added or removed columns are compatible, a changed type is not."""
    o = root_frame(spark, old).withColumnRenamed("data_type", "old")
    n = root_frame(spark, new).withColumnRenamed("data_type", "new")
    j = o.join(n, "col_name", "full_outer")
    compatible = F.col("old").isNull() | F.col("new").isNull() | (F.col("old") == F.col("new"))
    return j.select("col_name", "old", "new", compatible.alias("compatible"))


def nested_same(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Nested leaves equal in name and type in both schemas (J1): ``n_same``."""
    j = nested_frame(spark, old).join(nested_frame(spark, new), ["col_name", "data_type"], "inner")
    return j.agg(F.count(F.lit(1)).alias("n_same"))
