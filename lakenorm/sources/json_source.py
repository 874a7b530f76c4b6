"""JSON table scans (S1-S3) and the JSON sink.

A table is a directory ``<table>/dt=YYYYMMDD/*.json[.gz]``. Spark's partition
discovery supplies ``dt`` (kept a string by ``session.configure``). Schema
inference is a distributed pass over exactly the files that are read, so
an incremental run infers over the new partitions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import configure
from . import fs

PARTITION_COL = "dt"


def _reader(spark: SparkSession, corrupt: str):
    return spark.read.option("mode", "DROPMALFORMED" if corrupt == "drop" else "PERMISSIVE")


def infer_json_schema(spark: SparkSession, paths: list[str], corrupt: str = "keep", with_values: bool = False) -> T.StructType:
    """Schema of the data itself, without partition columns: one distributed
    pass over exactly these folders. ``with_values``: only fields that have a
    value somewhere (others would be strings)."""
    reader = _reader(spark, corrupt).option("recursiveFileLookup", "true").option("dropFieldIfAllNull", str(with_values).lower())
    return reader.json(paths).schema


def read_json_table(spark: SparkSession, table_path: str, partitions: list[str] | None = None,
                    schema: T.StructType | str | None = None, corrupt: str = "keep",
                    partition_col: str = PARTITION_COL) -> DataFrame:
    """Read a date-partitioned JSON table, or only ``partitions`` of it.

    ``partitions`` holds partition values (``"20240101"``) or directory names
    (``"dt=20240101"``). Only those directories are listed and inferred; the
    ``dt`` column is still present (``basePath``). ``corrupt="keep"`` keeps
    malformed lines in ``_corrupt_record``, ``"drop"`` drops them. Data that
    holds a key named like the partition column, in any case, is an error: its
    values would be lost behind the folder's.
    """
    configure(spark)
    dirs = partitions
    if dirs is None:
        dirs = [d for d in fs.list_dirs(spark, table_path) if d.startswith(f"{partition_col}=")]
        if not dirs:
            return _reader(spark, corrupt).json(table_path) if schema is None else _reader(spark, corrupt).schema(schema).json(table_path)
    elif not dirs:
        return spark.createDataFrame([], T.StructType([T.StructField(partition_col, T.StringType())]))
    paths = [f"{table_path.rstrip('/')}/{p if '=' in p else f'{partition_col}={p}'}" for p in dirs]
    if schema is None:
        data = infer_json_schema(spark, paths, corrupt)
        if any(f.name.lower() == partition_col for f in data.fields):
            raise ValueError(f"the data holds a column named like the partition column {partition_col!r}")
        schema = data
    if not isinstance(schema, str) and partition_col not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(partition_col, T.StringType())])
    return _reader(spark, corrupt).schema(schema).option("basePath", table_path).json(paths)


def read_json_partition(spark: SparkSession, table_path: str, partition: str,
                        schema: T.StructType | str | None = None) -> DataFrame:
    """One partition, as the reference reads it: by its directory.

    Reading the whole table with a filter on ``dt`` prunes the other
    directories as well; this form also skips inference over them.
    """
    return read_json_table(spark, table_path, [partition], schema=schema)


def write_json(df: DataFrame, path: str, mode: str = "append", partition_col: str | None = PARTITION_COL,
               compression: str | None = None) -> None:
    """JSON lines sink; appends by default (S6), partitioned by ``dt`` if present."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_col and partition_col in df.columns:
        w = w.partitionBy(partition_col)
    w.json(path)
