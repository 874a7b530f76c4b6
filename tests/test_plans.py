"""Physical plans: pruning and pushdown reach the scans, shuffle counts."""

from pyspark.sql import functions as F

from lakenorm.plans.convert import full_import, read_converted
from lakenorm.sources.json_source import read_json_table
from tests.test_jobs import _source


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_converted_table_scan_prunes_columns_and_partitions(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102", "20240103"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    full_import(spark, src, tgt, log, table="clicks")
    q = read_converted(spark, tgt, log, "clicks").filter(F.col("dt") == "20240102").select("id", F.col("user.name"))
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(dt" in plan and "20240102" in plan
    assert "ReadSchema: struct<id:bigint,user:struct<name:string>>" in plan     # nested pruning too
    assert q.count() == 3


def test_incremental_read_lists_only_new_partitions(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102", "20240103"])
    df = read_json_table(spark, src, ["dt=20240103"])
    assert len(df.inputFiles()) == 1 and df.select("dt").distinct().collect()[0][0] == "20240103"


def test_import_write_plan_has_dedup_then_rebalance(spark, tmp_path):
    from lakenorm.operators.normalize import normalize
    df = normalize(read_json_table(spark, _source(tmp_path, ["20240101"]))).hint("rebalance", "dt")
    lines = [ln for ln in _plan(df).splitlines() if "Exchange " in ln]
    assert len(lines) == 2 and "REBALANCE" in lines[0] and "hashpartitioning(dt" in lines[0]


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """A day holding a third of the rows is split by adaptive execution at the
    rebalance before the write (along map outputs), instead of one task
    writing the whole day."""
    import os
    from lakenorm.sources.parquet_sink import write_partitions
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        day = F.concat(F.lit("202401"), F.lpad((F.col("id") % 9 + 2).cast("string"), 2, "0"))
        df = spark.range(0, 300000, 1, 8).select(
            "id", (F.col("id") * 7919 % 100003).alias("v"),
            F.when(F.col("id") % 3 == 0, F.lit("20240101")).otherwise(day).alias("dt"))
        path = str(tmp_path / "hot")
        write_partitions(df, path)
    finally:
        spark.conf.set(key, old)
    files = len([f for f in os.listdir(os.path.join(path, "dt=20240101")) if f.endswith(".parquet")])
    assert files > 1
    assert spark.read.parquet(path).count() == 300000
