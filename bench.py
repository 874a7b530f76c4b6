"""

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs, default 3, after one warm-up).
Inputs are staged once from the driver tables (untimed); every timed run
writes into fresh folders. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from lakenorm.operators.normalize import normalize  # noqa: E402
from lakenorm.plans import fixtures as fx  # noqa: E402
from lakenorm.plans.convert import full_import, incremental_import  # noqa: E402
from lakenorm.session import build_session, scratch_path  # noqa: E402
from lakenorm.sources.json_source import infer_json_schema, read_json_table  # noqa: E402
from lakenorm.sources.partitions import validate_partitions  # noqa: E402


def _timed(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.splitlines() if "Exchange " in line and "ReusedExchange" not in line)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app="lakenorm-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakenorm-bench-"))

    events_src = fx.stage_messy_events(spark, sf_dir)
    li_docs = fx.stage_json(fx.lineitem_documents(spark, sf_dir), "bench-li-docs")
    conv_docs = fx.stage_json(fx.conversation_documents(spark, sf_dir), "bench-conv-docs")
    li = fx.table(spark, sf_dir, "lineitem")
    fuse_src = fx.stage_json(li.select("l_returnflag", "l_linestatus",
                                       F.array(F.struct(F.col("l_linenumber").alias("N"))).alias("A"),
                                       F.array(F.struct((F.col("l_quantity").cast("int") % 3).alias("Q"))).alias("B")),
                             "bench-fuse")
    health_tgt = scratch_path(spark, "bench-health")
    full_import(spark, events_src, health_tgt)
    n_events = fx.table(spark, sf_dir, "events").count()

    def run_full():
        full_import(spark, events_src, scratch_path(spark, "bench-full"), scratch_path(spark, "bench-log"),
                    table="events")

    def run_incremental():
        # untimed set-up happens inside; only the increment is measured
        src, tgt, log = (scratch_path(spark, x) for x in ("bench-inc-src", "bench-inc-tgt", "bench-inc-log"))
        fx.stage_messy_events(spark, sf_dir, src, where=fx.day() < "20240130")
        full_import(spark, src, tgt, log, table="events")
        fx.stage_messy_events(spark, sf_dir, src, where=fx.day() == "20240130")
        t0 = time.perf_counter()
        res = incremental_import(spark, src, tgt, log, table="events")
        assert res.mode == "incremental", res.mode
        return time.perf_counter() - t0

    def run_normalize():
        _noop(normalize(spark.read.json(li_docs)))

    def run_fold_arrays():
        _noop(normalize(spark.read.json(conv_docs)).select("conv_id", F.inline_outer("turns")))

    def run_fuse():
        _noop(normalize(spark.read.json(fuse_src), rows="fuse"))

    def run_health():
        validate_partitions(spark, health_tgt).collect()

    def run_inference():
        infer_json_schema(spark, [events_src])

    queries = {}
    queries["full_import"] = _timed(run_full, runs)
    run_incremental()
    queries["incremental_import"] = statistics.median(run_incremental() for _ in range(runs))
    queries["normalize_schema"] = _timed(run_normalize, runs)
    queries["fold_arrays"] = _timed(run_fold_arrays, runs)
    queries["fuse_arrays_two"] = _timed(run_fuse, runs)
    queries["validate_partitions"] = _timed(run_health, runs)
    inference = _timed(run_inference, runs)

    # driver cost of planning the normaliser for a wide schema (no data: an
    # empty frame isolates the plan building)
    wide = T.StructType(
        [T.StructField(f"Col{c}" if c % 10 == 0 else f"col{c}", T.LongType() if c % 3 else T.StringType())
         for c in range(1200)]
        + [T.StructField(f"COL{c}", T.LongType()) for c in range(0, 1200, 10)]
        + [T.StructField("St", T.StructType([T.StructField(f"F{j}", T.LongType()) for j in range(400)])),
           T.StructField("Arr", T.ArrayType(T.StructType([T.StructField(f"g{j}", T.LongType())
                                                          for j in range(150)])))])
    wide_df = spark.createDataFrame([], wide)
    normalize(wide_df)   # warm-up
    t0 = time.perf_counter()
    normalize(wide_df).schema
    wide_plan_sec = time.perf_counter() - t0

    # the whole import: dedup exchange and the rebalance of the write
    plan_df = normalize(read_json_table(spark, events_src)).hint("rebalance", "dt")
    shuffles = _exchanges(normalize(spark.read.json(li_docs)))
    out = {
        "metric": "total_sec",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows_per_sec_full_import": round(2 * n_events / queries["full_import"], 1),
        "shuffles_normalize_schema": shuffles,
        "shuffles_full_import": _exchanges(plan_df),
        "inference_sec_full_import": round(inference, 3),
        "driver_plan_sec_wide_schema": round(wide_plan_sec, 3),
        "cpus": cpus,
        "cores_machine": os.cpu_count(),
        "mem_gb_machine": round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30, 1),
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
