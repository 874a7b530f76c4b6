"""Registered queries: one per operator of the inventory, with oracle SQL.

Each query takes ``(spark, sf_dir)``, derives its input from the driver's
tables (``fixtures``), runs the operator on Spark and returns a frame of flat
scalar columns. ``ORACLE`` holds the same result as DuckDB SQL over the
tables; ``D`` below is ``strftime(ts,'%Y%m%d')``, ``P`` is ``'dt='||D``.
Queries about the environment (file times, any-row picks) return what must
hold for it whatever it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import is_flat, needs_recalc, schema_rows, unify_schemas
from ..operators.align import (align, comments, null_fill, set_comment, tag_drop_rename, union_by_name,
                               witness_row)
from ..operators.normalize import case_merge, distinct_rows, normalize, normalized_projection
from ..operators.schema_diff import nested_same, root_diff
from ..operators.unfold import explode_arrays, fold_structs, unfold, unfold_structs
from ..session import configure, scratch_path
from ..sources import worklog as wl
from ..sources.json_source import read_json_partition, read_json_table, write_json
from ..sources.parquet_sink import read_table, write_partitions
from ..sources.partitions import (drop_partition, file_inventory, file_path, latest_file_date, list_partitions,
                                  max_partition, partition_counts, partition_from_path, partitions_to_recalc,
                                  validate_partitions)
from . import fixtures as fx
from .convert import convert_database, full_import, incremental_import, read_converted

Query = Callable[[SparkSession, str], DataFrame]

D = "strftime(ts,'%Y%m%d')"
P = f"('dt='||{D})"


def _flat_events(df: DataFrame) -> DataFrame:
    """Flat columns of a normalised ``messy_events`` table."""
    cols = ["event_id", "user_id", "event_type", "value", F.col("props.k").alias("k"), "dt"]
    if "extra" in df.columns:
        cols.insert(5, "extra")
    return df.select(*cols)


# ---------------------------------------------------------------- scans, sinks

def q_json_scan(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "props", fx.day().alias("dt"))
    path = fx.stage_json(ev, "json-scan")
    df = read_json_table(spark, path)
    return df.select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


def q_json_scan_partition(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", fx.day().alias("dt"))
    path = fx.stage_json(ev, "json-part")
    return read_json_partition(spark, path, "dt=20240103").select("event_id", "user_id", "event_type", "value", "dt")


def q_json_scan_merged(spark, sf):
    ev = fx.table(spark, sf, "events")
    early = fx.day() <= F.lit("20240115")
    path = fx.stage_json(ev.filter(early).select("event_id", "user_id", "event_type", fx.day().alias("dt")),
                         "json-merged")
    fx.stage_json(ev.filter(~early).select("event_id", "value", "event_type", fx.day().alias("dt")), "", path)
    return read_json_table(spark, path).select("event_id", "user_id", "value", "event_type", "dt")


def q_json_append_sink(spark, sf):
    cu = fx.table(spark, sf, "customer")
    path = scratch_path(spark, "json-append")
    write_json(cu.filter(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name"), path, mode="overwrite")
    write_json(cu.filter(F.col("c_custkey") % 2 == 1).select("c_custkey", "c_acctbal"), path, mode="append")
    return spark.read.json(path).select("c_custkey", "c_name", "c_acctbal")


def q_parquet_scan(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", fx.day().alias("dt"))
    path = scratch_path(spark, "pq-scan")
    write_partitions(ev, path)
    return read_table(spark, path).select("event_id", "event_type", "dt")


def q_parquet_partition_overwrite(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", fx.day().alias("dt"))
    path = scratch_path(spark, "pq-overwrite")
    write_partitions(ev, path)
    patch = ev.filter(F.col("dt") == "20240103").select((F.col("event_id") + 1000000).alias("event_id"), "dt")
    write_partitions(patch, path)
    return read_table(spark, path).select("event_id", "dt")


def q_drop_partition(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", fx.day().alias("dt"))
    path = scratch_path(spark, "pq-drop")
    write_partitions(ev, path)
    drop_partition(spark, path, "dt=20240105")
    return read_table(spark, path).select("event_id", "dt")


def q_list_partitions(spark, sf):
    return list_partitions(spark, fx.stage_messy_events(spark, sf))


def q_max_partition(spark, sf):
    return max_partition(spark, fx.stage_messy_events(spark, sf))


def q_partition_from_path(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", fx.day().alias("dt"))
    df = read_json_table(spark, fx.stage_json(ev, "from-path"))
    return partition_from_path(df).select("event_id", "partition")


def q_partitions_to_recalc(spark, sf):
    source = list_partitions(spark, fx.stage_messy_events(spark, sf))
    done = source.filter(F.substring("partition", -1, 1) < "5")
    return partitions_to_recalc(source, done)


def q_partition_counts(spark, sf):
    df = read_json_table(spark, fx.stage_messy_events(spark, sf, extra=False))
    return partition_counts(normalize(df))


def q_validate_partitions(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "event_type", fx.day().alias("dt"))
    path = scratch_path(spark, "pq-health")
    write_partitions(ev, path)
    from ..sources import fs
    # damaged days: a junk file before all data, beside data, and after it; a valid file without rows
    for day in ("19990101", "20240110", "20240205"):
        fs.write_text(spark, f"{path}/dt={day}/part-00000-junk.parquet", "this is not parquet\n")
    empty = ev.filter(F.lit(False)).drop("dt")
    empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/dt=20240206")
    return validate_partitions(spark, path)


# ------------------------------------------------------- projections, schema

def q_case_merge(spark, sf):
    docs = fx.table(spark, sf, "documents")
    staged = docs.select("doc_id",
                         F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("Lang"),
                         F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x-"), F.col("lang"))).alias("lang"))
    df = spark.read.json(fx.stage_json(staged, "case-merge"))
    return case_merge(df)


def q_case_merge_types(spark, sf):
    ev = fx.table(spark, sf, "events")
    staged = ev.select("event_id",
                       F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("K"),
                       F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("k"))
    df = spark.read.json(fx.stage_json(staged, "case-types"))
    return case_merge(df)


def q_unfold_structs(spark, sf):
    return unfold_structs(unfold_structs(fx.nested_orders(spark, sf)))


def q_unfold_depth(spark, sf):
    once = unfold(fx.nested_orders(spark, sf), depth=1)
    return once.select("o_orderkey", "O___o_orderstatus", F.col("O___In").getField("P").alias("in_p"))


def q_fold_structs(spark, sf):
    flat = unfold(fx.nested_orders(spark, sf))
    folded = fold_structs(flat)
    return folded.select("o_orderkey", F.col("O.o_orderstatus").alias("status"), F.col("O.In.P").alias("price"))


def q_explode_outer_arrays(spark, sf):
    df = spark.read.json(fx.stage_json(fx.customer_orders(spark, sf), "cust-orders"))
    ex = explode_arrays(df, "os")
    return ex.select("c_custkey", F.col("os_exploded.o_orderkey").alias("o_orderkey"))


def q_all_null_flag(spark, sf):
    df = spark.read.json(fx.stage_json(fx.customer_orders(spark, sf, all_null_element=True), "cust-orders-null"))
    norm = normalize(df)
    return norm.groupBy("c_custkey").agg(F.sum(F.size("os")).cast("int").alias("n"))


def q_fold_arrays(spark, sf):
    df = spark.read.json(fx.stage_json(fx.conversation_documents(spark, sf), "conv-docs"))
    norm = normalize(df)
    return norm.select("conv_id", F.inline_outer("turns")).select("conv_id", "turn", "role")


def q_normalize_schema(spark, sf):
    df = spark.read.json(fx.stage_json(fx.lineitem_documents(spark, sf), "li-docs"))
    norm = normalize(df)
    return norm.select("l_orderkey", F.col("meta.k").alias("k"), F.inline_outer("lines")) \
        .select("l_orderkey", "k", "lineno", "partkey")


def q_sort_columns(spark, sf):
    cu = fx.table(spark, sf, "customer")
    staged = cu.select("c_name", F.struct(F.col("c_acctbal").alias("Zeta"), F.col("c_nationkey").alias("alpha"),
                                          F.col("c_mktsegment").alias("Mid")).alias("Info"), "c_custkey")
    norm = normalize(spark.read.json(fx.stage_json(staged, "sort-cols")))
    # the names in schema order as one text beside the values under them
    names = ",".join(name for name, _ in schema_rows(norm.schema))
    return norm.select(F.lit(names).alias("names"), F.to_json(F.struct("*")).alias("row"))


def q_fuse_arrays(spark, sf):
    o = fx.table(spark, sf, "orders")
    staged = o.select("o_custkey", "o_orderstatus", F.array(F.struct(F.col("o_orderpriority").alias("Prio")))
                      .alias("Items"))
    norm = normalize(spark.read.json(fx.stage_json(staged, "fuse")), rows="fuse")
    # the elements themselves, each with the number of rows and elements it was folded with
    return norm.select("o_custkey", "o_orderstatus", F.size("items").alias("n_items"), F.inline_outer("items"))


def q_fuse_arrays_single(spark, sf):
    o = fx.table(spark, sf, "orders")
    staged = o.select("o_custkey", "o_orderstatus", F.array(F.struct(F.col("o_orderpriority").alias("Prio")))
                      .alias("Items"))
    norm = normalize(spark.read.json(fx.stage_json(staged, "fuse1")), rows="fuse", unwrap_single_field=True)
    return norm.select("o_custkey", "o_orderstatus", F.lit(norm.schema["items"].dataType.simpleString()).alias("items_type"),
                       F.explode_outer("items").alias("prio"))


def q_fuse_arrays_two(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    staged = li.select("l_returnflag", "l_linestatus",
                       F.array(F.struct(F.col("l_linenumber").alias("N"))).alias("A"),
                       F.array(F.struct((F.col("l_quantity").cast("int") % 3).alias("Q"))).alias("B"))
    norm = normalize(spark.read.json(fx.stage_json(staged, "fuse2")), rows="fuse")
    of = lambda c, f: F.array_join(F.sort_array(F.transform(c, lambda x: x[f].cast("string"))), ",")
    return norm.select("l_returnflag", "l_linestatus", of("a", "n").alias("a"), of("b", "q").alias("b"))


def q_fuse_nested(spark, sf):
    """An array inside a root struct whose elements hold arrays: rows equal
    outside are folded, and elements equal outside their nested arrays."""
    li = fx.table(spark, sf, "lineitem")
    subs = F.array(F.struct(F.col("l_linenumber").alias("N")))
    items = F.array(F.struct(F.col("l_linestatus").alias("K"), subs.alias("Subs")))
    staged = li.select("l_suppkey", F.struct(F.col("l_returnflag").alias("R"), items.alias("Items")).alias("G"))
    norm = normalize(spark.read.json(fx.stage_json(staged, "fuse-nested")), rows="fuse")
    each = norm.select("l_suppkey", F.col("g.r").alias("r"), F.size("g.items").alias("n_items"), F.inline_outer("g.items"))
    return each.select("l_suppkey", "r", "n_items", "k", F.size("subs").alias("n_subs"), F.inline_outer("subs"))


def q_rows_distinct(spark, sf):
    ev = fx.table(spark, sf, "events").select("user_id", "event_type")
    return distinct_rows(ev.unionAll(ev))


def q_union_by_name(spark, sf):
    c = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"))
    return union_by_name([c, s])


def q_align_schema(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return align(c, T._parse_datatype_string("c_custkey bigint, c_nationkey bigint, segment string"))


def q_null_fill(spark, sf):
    ev = fx.table(spark, sf, "events")
    holes = ev.select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("value"),
                      F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("event_type"))
    return null_fill(holes)


def q_tag_drop_rename(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return tag_drop_rename(ev, tags={"source": "json"}, drop=["value"], rename={"event_type": "type"})


def q_witness_row(spark, sf):
    df = spark.read.json(fx.stage_json(fx.customer_orders(spark, sf), "witness"))
    # any row will do, so the witness comes from the projection: no dedup shuffle for one row
    w = witness_row(normalized_projection(df))
    # whichever row it is: every column and field is filled, and an empty array has one element of sentinels
    no_element = F.size("os") == 1
    shown = [F.col("c_custkey"), F.col("c.name"), F.col("os")[0]["o_orderkey"], F.col("os")[0]["o_orderstatus"]]
    n = fx.table(spark, sf, "customer").agg(F.count(F.lit(1))).scalar()
    return w.select(n.alias("n_customers"), no_element.alias("one_element"), *[c.isNotNull().alias(f"shown_{i}") for i, c in enumerate(shown)])


def q_column_comment(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "event_type")
    ev = set_comment(set_comment(ev, "event_id", "1"), "event_id", "2", append=True)
    ev = set_comment(set_comment(ev, "event_type", "x"), "event_type", None)
    # comments travel with the Parquet schema: read them back from the written table
    path = scratch_path(spark, "pq-comment")
    ev.write.parquet(path)
    back = spark.read.parquet(path)
    found = comments(back)
    return back.select("event_id", F.lit(found.get("event_id")).cast("string").alias("comment"),
                       F.lit(found.get("event_type")).cast("string").alias("type_comment"))


# ------------------------------------------------------------------ filters

def q_filter_eq(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.filter(F.col("event_type") == "view").select("event_id", "user_id")


def q_filter_not(spark, sf):
    ev = fx.table(spark, sf, "events").withColumn("drop", F.col("event_type") == "click")
    return ev.filter(~F.col("drop")).select("event_id")


def q_filter_contains(spark, sf):
    return fx.table(spark, sf, "part").filter(F.col("p_name").contains("ring")).select("p_partkey")


# ----------------------------------------------------------------- work log

def _events_log(spark, sf, where=None, run_by_day=False, max_partition_col=None) -> str:
    """A work log built from ``events``: table = event type, one ``done``
    row per (type, day); written with ``append_frame``."""
    ev = fx.table(spark, sf, "events")
    if where is not None:
        ev = ev.filter(where)
    part = F.concat(F.lit("dt="), fx.day())
    run = F.date_format("ts", "yyyy-MM-dd") if run_by_day else F.lit("run-1")
    rows = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("table"),
                     part.alias("partition"),
                     (max_partition_col if max_partition_col is not None else part).alias("maxPartition"),
                     run.alias("run_id"), F.lit("done").alias("status"),
                     F.lit(wl.now_stamp()).alias("written_at"),
                     F.lit(None).cast("string").alias("table_schema"),
                     F.lit(None).cast("string").alias("source_schema")).distinct()
    path = scratch_path(spark, "worklog")
    wl.init_log(spark, path)
    wl.append_frame(path, rows)
    return path


def q_worklog_append(spark, sf):
    path = _events_log(spark, sf)
    # the jobs' own way to append: a further run per type, started and done
    for t in sorted(r[0] for r in fx.table(spark, sf, "events").select("event_type").distinct().collect()):
        run = wl.new_run_id()
        wl.mark_started(spark, path, t, ["dt=open", "dt=extra"], run)
        wl.mark_done(spark, path, t, ["dt=extra"], "dt=open", run)
    return wl.done_partitions(wl.read_log(spark, path))


def q_worklog_remove_partition(spark, sf):
    path = _events_log(spark, sf)
    wl.remove_partition(spark, path, "click", "dt=20240102")
    return wl.done_partitions(wl.read_log(spark, path))


def q_worklog_remove_table(spark, sf):
    path = _events_log(spark, sf)
    wl.remove_table(spark, path, "click")
    return wl.done_partitions(wl.read_log(spark, path))


def q_worklog_latest_run(spark, sf):
    path = _events_log(spark, sf, run_by_day=True)
    latest = wl.latest_run(wl.read_log(spark, path))
    return latest.groupBy("table").agg(F.max("partition").alias("last_finished"))


def q_max_done_partition(spark, sf):
    log = wl.read_log(spark, _events_log(spark, sf))
    types = sorted(r[0] for r in fx.table(spark, sf, "events").select("event_type").distinct().collect())
    return union_by_name([wl.max_done_partition(log, t).withColumn("table", F.lit(t)) for t in types])


def q_was_interrupted(spark, sf):
    ev = fx.table(spark, sf, "events")
    newest = ev.agg(F.max(fx.day())).scalar()
    keep = (F.col("event_type") != "click") | (fx.day() <= "20240125")
    path = _events_log(spark, sf, where=keep, max_partition_col=F.concat(F.lit("dt="), newest))
    summary = wl.run_summary(wl.read_log(spark, path))
    return summary.select("table", "interrupted")


def q_has_new_partitions(spark, sf):
    keep = (fx.day() < "20240120") | (F.col("event_type") == "click")
    log = wl.read_log(spark, _events_log(spark, sf, where=keep))
    source = list_partitions(spark, fx.stage_messy_events(spark, sf))
    types = sorted(r[0] for r in fx.table(spark, sf, "events").select("event_type").distinct().collect())
    rows = [(t, wl.has_new_partitions(log, source, t), wl.has_new_partitions(log, source, t, rule="max")) for t in types]
    return spark.createDataFrame(rows, "table string, has_new boolean, has_new_max boolean")


# ------------------------------------------------------------ schema algebra

def _pair_schemas(spark, sf) -> tuple[T.StructType, T.StructType]:
    old_path, new_path = fx.schema_pair(spark, sf)
    drop_dt = lambda s: T.StructType([f for f in s.fields if f.name != "dt"])
    return drop_dt(read_json_table(spark, old_path).schema), drop_dt(read_json_table(spark, new_path).schema)


def q_schema_rows(spark, sf):
    df = spark.read.json(fx.stage_json(fx.customer_orders(spark, sf), "schema-rows"))
    return spark.createDataFrame(schema_rows(df.schema), "col_name string, data_type string")


def q_schema_root_diff(spark, sf):
    old, new = _pair_schemas(spark, sf)
    return root_diff(spark, old, new)


def q_schema_nested_diff(spark, sf):
    old, new = _pair_schemas(spark, sf)
    return nested_same(spark, old, new)


def q_unify_schemas(spark, sf):
    old, new = _pair_schemas(spark, sf)
    return spark.createDataFrame(schema_rows(unify_schemas(old, new)), "col_name string, data_type string")


def q_needs_recalc(spark, sf):
    old, new = _pair_schemas(spark, sf)
    unified = unify_schemas(old, new)
    with_extra = T.StructType(list(old.fields) + [T.StructField("extra", T.BooleanType())])
    rows = [("direct", needs_recalc(old, new)),
            ("unified", needs_recalc(old, unified)),
            ("unified_old_only", needs_recalc(old, unified, strict="old_only")),
            ("root_added", needs_recalc(old, with_extra))]
    return spark.createDataFrame(rows, "check string, rebuild boolean")


def q_is_flat(spark, sf):
    flat = read_json_table(spark, fx.stage_messy_events(spark, sf)).drop("Props")
    nested = spark.read.json(fx.stage_json(fx.customer_orders(spark, sf), "is-flat"))
    return spark.createDataFrame([("events", is_flat(flat.schema)), ("customer_orders", is_flat(nested.schema))],
                                 "frame string, is_flat boolean")


# ------------------------------------------------------------------- jobs

def q_full_import(spark, sf):
    src = fx.stage_messy_events(spark, sf)
    tgt, log = scratch_path(spark, "pq-full"), scratch_path(spark, "log-full")
    full_import(spark, src, tgt, log, table="events")
    return _flat_events(read_converted(spark, tgt, log, "events"))


def q_incremental_import(spark, sf):
    src = scratch_path(spark, "events-inc")
    tgt, log = scratch_path(spark, "pq-inc"), scratch_path(spark, "log-inc")
    d = fx.day()
    fx.stage_messy_events(spark, sf, src, where=d <= "20240110")
    incremental_import(spark, src, tgt, log, table="events")
    fx.stage_messy_events(spark, sf, src, where=(d > "20240110") & (d <= "20240120"))
    incremental_import(spark, src, tgt, log, table="events")
    fx.stage_messy_events(spark, sf, src, where=d > "20240120", extra=True)
    incremental_import(spark, src, tgt, log, table="events")
    return _flat_events(read_converted(spark, tgt, log, "events"))


def q_stream_import(spark, sf):
    from ..streaming.ingest import stream_import
    src, tgt, log, ck = (scratch_path(spark, x) for x in ("events-stream", "pq-stream", "log-stream", "ck-stream"))
    d, even = fx.day(), F.col("event_id") % 2 == 0
    late = (d == "20240105") & even             # half of day 5 arrives with the second batch
    fx.stage_messy_events(spark, sf, src, where=(d <= "20240110") & ~late)
    stream_import(spark, src, tgt, log, ck, table="events")
    fx.stage_messy_events(spark, sf, src, where=((d > "20240110") & (d <= "20240120")) | late)
    stream_import(spark, src, tgt, log, ck, table="events")
    fx.stage_messy_events(spark, sf, src, where=d > "20240120")
    stream_import(spark, src, tgt, log, ck, table="events")
    return _flat_events(read_converted(spark, tgt, log, "events"))


def q_convert_database(spark, sf):
    root, target, log = (scratch_path(spark, x) for x in ("db-json", "db-parquet", "db-log"))
    click = F.col("event_type") == "click"
    fx.stage_messy_events(spark, sf, f"{root}/clicks", where=click)
    fx.stage_messy_events(spark, sf, f"{root}/rest", where=~click)
    convert_database(spark, root, target, log, parallel=2)
    frames = [read_converted(spark, f"{target}/{t}", log, t).select(F.lit(t).alias("tbl"), "event_id", "dt")
              for t in ("clicks", "rest")]
    return union_by_name(frames)


def q_file_inventory(spark, sf):
    """Rows of the files that the inventory lists, per day: each file is found
    under its path, has a length and a time."""
    path = fx.stage_messy_events(spark, sf)
    rows = (read_json_table(spark, path).select(file_path().alias("_path")).groupBy("_path").agg(F.count(F.lit(1)).alias("n")))
    inv = file_inventory(spark, path).where("length > 0 and modificationTime is not null")
    # both name a file by its plain path; one has the scheme's slashes
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    return (inv.join(rows, plain(F.col("path")) == plain(F.col("_path"))).groupBy("dt")
            .agg(F.sum("n").alias("n_rows"), F.count_distinct("path").alias("n_files")).select("dt", "n_rows", (F.col("n_files") > 0).alias("listed")))


def q_latest_file_date(spark, sf):
    before = spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd') as d").first().d
    path = fx.stage_messy_events(spark, sf)
    newest = file_inventory(spark, path).agg(F.date_format(F.max("modificationTime"), "yyyy-MM-dd").alias("d")).first().d
    events = fx.table(spark, sf, "events").agg(F.count(F.lit(1))).scalar()
    return latest_file_date(spark, path).select(
        events.alias("n_events"), (F.col("latest_file_date") >= before).alias("is_new"), (F.col("latest_file_date") == newest).alias("is_newest"))


# ------------------------------------------------- jobs over changing sources

def _events_rows(spark, tgt, log):
    return read_converted(spark, tgt, log, "events")


def q_incremental_many_partitions(spark, sf):
    """``events`` by day and hour: hundreds of folders with escaped names."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-hours", "pq-hours", "log-hours"))
    ev = fx.table(spark, sf, "events").select("event_id", "event_type", F.date_format("ts", "yyyyMMdd:HH").alias("dt"))
    fx.stage_json(ev.where("dt < '20240105'"), "", src)
    incremental_import(spark, src, tgt, log, table="events")
    fx.stage_json(ev.where("dt >= '20240105'"), "", src)
    incremental_import(spark, src, tgt, log, table="events")
    return _events_rows(spark, tgt, log).select("event_id", "event_type", "dt")


def q_incremental_late_files(spark, sf):
    """Half of three days arrives late, with a new column; then a type change in
    a later day forces a rebuild."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-late", "pq-late", "log-late"))
    d, even = fx.day(), F.col("event_id") % 2 == 0
    ev = fx.table(spark, sf, "events")
    late = d.isin("20240102", "20240105", "20240109") & even
    base = [F.col("event_id"), F.col("user_id").alias("User"), d.alias("dt")]
    fx.stage_json(ev.where(~late & (d <= "20240120")).select(*base), "", src)
    incremental_import(spark, src, tgt, log, table="events")
    fx.stage_json(ev.where(late).select(*base, F.col("event_type").alias("Late")), "", src)
    incremental_import(spark, src, tgt, log, table="events")
    text = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("User")
    fx.stage_json(ev.where(d > "20240120").select("event_id", text, d.alias("dt")), "", src)
    assert incremental_import(spark, src, tgt, log, table="events").mode == "rebuild"
    return _events_rows(spark, tgt, log).select("event_id", "user", "late", "dt")


def q_incremental_type_change(spark, sf):
    """A column that is text first and a number, a flag or an object in later days."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-types", "pq-types", "log-types"))
    d = fx.day()
    ev = fx.table(spark, sf, "events")
    steps = [(d <= "20240110", F.col("event_type")), ((d > "20240110") & (d <= "20240115"), F.col("event_id")),
             ((d > "20240115") & (d <= "20240120"), F.col("event_id") % 2 == 0),
             (d > "20240120", F.struct(F.col("event_id").alias("B"), F.col("event_type").alias("a")))]
    for where, value in steps:
        fx.stage_json(ev.where(where).select("event_id", value.alias("v"), d.alias("dt")), "", src)
        incremental_import(spark, src, tgt, log, table="events")
    return _events_rows(spark, tgt, log).select("event_id", "v", "dt")


def q_incremental_null_days(spark, sf):
    """Columns that are null in whole days, before or after the days that have
    their values: they keep the type that the values have."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-nulls", "pq-nulls", "log-nulls"))
    d, first = fx.day(), fx.day() <= "20240110"
    line = F.to_json(F.struct("event_id", F.when(~first, F.col("user_id")).alias("Late"), F.when(first, F.col("value")).alias("Early"),
                              F.struct(F.when(d > "20240120", F.col("event_id") % 2 == 0).alias("Flag")).alias("In")), {"ignoreNullFields": "false"})
    ev = fx.table(spark, sf, "events").select(line.alias("line"), d.alias("dt"))
    for where in (F.col("dt") <= "20240110", (F.col("dt") > "20240110") & (F.col("dt") <= "20240120"), F.col("dt") > "20240120"):
        ev.where(where).write.mode("append").partitionBy("dt").text(src)
        incremental_import(spark, src, tgt, log, table="events")
    return _events_rows(spark, tgt, log).select("event_id", "late", "early", F.col("in.flag").alias("flag"), "dt")


def q_import_after_crash(spark, sf):
    """The first run breaks off after its data was written, before its log was;
    the next one repairs it without new data."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-crash", "pq-crash", "log-crash"))
    fx.stage_messy_events(spark, sf, src, where=fx.day() <= "20240115")
    incremental_import(spark, src, tgt, log, table="events")
    fx.stage_messy_events(spark, sf, src, where=fx.day() > "20240115", extra=True)
    parts = sorted(r.partition for r in list_partitions(spark, src).collect())
    # what such a run leaves: its started rows and a part of its data
    wl.mark_started(spark, log, "events", parts[-10:], wl.new_run_id())
    write_partitions(normalize(read_json_table(spark, src, parts[-10:-5])).drop("extra").limit(100), tgt)
    interrupted = wl.was_interrupted(spark, log, "events")
    again = incremental_import(spark, src, tgt, log, table="events")
    settled = incremental_import(spark, src, tgt, log, table="events")
    return _flat_events(_events_rows(spark, tgt, log)).withColumn("repaired", F.lit(
        interrupted and set(parts[-10:]) <= set(again.partitions) and settled.mode == "none"
        and not wl.was_interrupted(spark, log, "events")))


def q_incremental_emptied_day(spark, sf):
    """A converted day whose source files are replaced by files without rows."""
    src, tgt, log = (scratch_path(spark, x) for x in ("events-emptied", "pq-emptied", "log-emptied"))
    from ..sources import fs
    fx.stage_messy_events(spark, sf, src)
    incremental_import(spark, src, tgt, log, table="events")
    for day in ("dt=20240103", "dt=20240117"):
        fs.delete_dir(spark, f"{src}/{day}")
        fs.write_text(spark, f"{src}/{day}/part-0.json", "\n" if day.endswith("3") else "")
    incremental_import(spark, src, tgt, log, table="events")
    return _flat_events(_events_rows(spark, tgt, log))


QUERIES: dict[str, Query] = {
    "json_scan": q_json_scan,
    "json_scan_partition": q_json_scan_partition,
    "json_scan_merged": q_json_scan_merged,
    "json_append_sink": q_json_append_sink,
    "parquet_scan": q_parquet_scan,
    "parquet_partition_overwrite": q_parquet_partition_overwrite,
    "drop_partition": q_drop_partition,
    "list_partitions": q_list_partitions,
    "max_partition": q_max_partition,
    "partition_from_path": q_partition_from_path,
    "partitions_to_recalc": q_partitions_to_recalc,
    "partition_counts": q_partition_counts,
    "validate_partitions": q_validate_partitions,
    "file_inventory": q_file_inventory,
    "latest_file_date": q_latest_file_date,
    "case_merge": q_case_merge,
    "case_merge_types": q_case_merge_types,
    "unfold_structs": q_unfold_structs,
    "unfold_depth": q_unfold_depth,
    "fold_structs": q_fold_structs,
    "explode_outer_arrays": q_explode_outer_arrays,
    "all_null_flag": q_all_null_flag,
    "fold_arrays": q_fold_arrays,
    "normalize_schema": q_normalize_schema,
    "sort_columns": q_sort_columns,
    "fuse_arrays": q_fuse_arrays,
    "fuse_arrays_single": q_fuse_arrays_single,
    "fuse_arrays_two": q_fuse_arrays_two,
    "fuse_nested": q_fuse_nested,
    "rows_distinct": q_rows_distinct,
    "union_by_name": q_union_by_name,
    "align_schema": q_align_schema,
    "null_fill": q_null_fill,
    "tag_drop_rename": q_tag_drop_rename,
    "witness_row": q_witness_row,
    "column_comment": q_column_comment,
    "filter_eq": q_filter_eq,
    "filter_not": q_filter_not,
    "filter_contains": q_filter_contains,
    "worklog_append": q_worklog_append,
    "worklog_remove_partition": q_worklog_remove_partition,
    "worklog_remove_table": q_worklog_remove_table,
    "worklog_latest_run": q_worklog_latest_run,
    "max_done_partition": q_max_done_partition,
    "was_interrupted": q_was_interrupted,
    "has_new_partitions": q_has_new_partitions,
    "schema_rows": q_schema_rows,
    "schema_root_diff": q_schema_root_diff,
    "schema_nested_diff": q_schema_nested_diff,
    "unify_schemas": q_unify_schemas,
    "needs_recalc": q_needs_recalc,
    "is_flat": q_is_flat,
    "full_import": q_full_import,
    "incremental_import": q_incremental_import,
    "stream_import": q_stream_import,
    "convert_database": q_convert_database,
    "incremental_many_partitions": q_incremental_many_partitions,
    "incremental_late_files": q_incremental_late_files,
    "incremental_type_change": q_incremental_type_change,
    "incremental_emptied_day": q_incremental_emptied_day,
    "incremental_null_days": q_incremental_null_days,
    "import_after_crash": q_import_after_crash,
}

_EVENTS_FLAT = (f"SELECT DISTINCT event_id, user_id, event_type, value, "
                f"CAST(json_extract(props,'$.k') AS BIGINT) AS k, {D} AS dt FROM events")

ORACLE: dict[str, str] = {
    "json_scan": "SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) AS k FROM events",
    "json_scan_partition": f"SELECT event_id, user_id, event_type, value, {D} AS dt FROM events "
                           f"WHERE {D} = '20240103'",
    "json_scan_merged": f"SELECT event_id, CASE WHEN {D} <= '20240115' THEN user_id END AS user_id, "
                        f"CASE WHEN {D} > '20240115' THEN value END AS value, event_type, {D} AS dt FROM events",
    "json_append_sink": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name, "
                        "CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal FROM customer",
    "parquet_scan": f"SELECT event_id, event_type, {D} AS dt FROM events",
    "parquet_partition_overwrite": f"SELECT CASE WHEN {D} = '20240103' THEN event_id + 1000000 ELSE event_id END "
                                   f"AS event_id, {D} AS dt FROM events",
    "drop_partition": f"SELECT event_id, {D} AS dt FROM events WHERE {D} <> '20240105'",
    "list_partitions": f"SELECT DISTINCT {P} AS partition FROM events",
    "max_partition": f"SELECT max({P}) AS max_partition FROM events",
    "partition_from_path": f"SELECT event_id, {P} AS partition FROM events",
    "partitions_to_recalc": f"WITH s AS (SELECT DISTINCT {P} AS partition FROM events), "
                            "c AS (SELECT partition FROM s WHERE substr(partition, -1) < '5') "
                            "SELECT partition FROM s WHERE partition NOT IN "
                            "(SELECT partition FROM c WHERE partition < (SELECT max(partition) FROM c))",
    "partition_counts": f"SELECT {D} AS dt, count(*) AS n FROM events GROUP BY 1",
    "validate_partitions": f"SELECT DISTINCT {D} AS dt, 'ok' AS status FROM events WHERE {D} <> '20240110' UNION ALL "
                           "SELECT * FROM (VALUES ('19990101','unreadable'), ('20240110','unreadable'), ('20240205','unreadable'), "
                           "('20240206','empty')) t(dt, status)",
    "file_inventory": f"SELECT {D} AS dt, 2 * count(*) AS n_rows, true AS listed FROM events GROUP BY 1",
    "latest_file_date": "SELECT count(*) AS n_events, true AS is_new, true AS is_newest FROM events",
    "witness_row": "SELECT count(*) AS n_customers, true AS one_element, true AS shown_0, true AS shown_1, true AS shown_2, "
                   "true AS shown_3 FROM customer",
    "case_merge": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang WHEN doc_id % 3 = 0 THEN 'x-' || lang END "
                  "AS lang FROM documents",
    "case_merge_types": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) "
                        "WHEN event_id % 3 = 0 THEN event_type END AS k FROM events",
    "unfold_structs": 'SELECT o_orderkey, o_orderstatus AS "O___o_orderstatus", o_totalprice AS "O___In___P" '
                      "FROM orders",
    "unfold_depth": 'SELECT o_orderkey, o_orderstatus AS "O___o_orderstatus", o_totalprice AS in_p FROM orders',
    "fold_structs": "SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders",
    "explode_outer_arrays": "SELECT c_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS o_orderkey "
                            "FROM customer LEFT JOIN orders ON c_custkey = o_custkey",
    "all_null_flag": "SELECT c_custkey, CAST(count(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END) AS INTEGER) "
                     "AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "fold_arrays": "SELECT DISTINCT conv_id, turn, role FROM conversations",
    "normalize_schema": "SELECT DISTINCT l_orderkey, l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS lineno, "
                        "l_partkey AS partkey FROM lineitem",
    "sort_columns": "SELECT 'c_custkey,c_name,info___alpha,info___mid,info___zeta' AS names, '{\"c_custkey\":' || c_custkey || "
                    "',\"c_name\":\"' || c_name || '\",\"info\":{\"alpha\":' || c_nationkey || ',\"mid\":\"' || c_mktsegment || "
                    "'\",\"zeta\":' || CAST(c_acctbal AS DOUBLE) || '}}' AS row FROM customer",
    "fuse_arrays": "SELECT DISTINCT o_custkey, o_orderstatus, CAST(count(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey, "
                   "o_orderstatus) AS INTEGER) AS n_items, o_orderpriority AS prio FROM orders",
    "fuse_arrays_single": "SELECT DISTINCT o_custkey, o_orderstatus, 'array<string>' AS items_type, o_orderpriority AS prio FROM orders",
    "fuse_arrays_two": "WITH a AS (SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) % 3 AS q, "
                       "list_sort(list(DISTINCT l_linenumber)) AS ns FROM lineitem GROUP BY 1, 2, 3) "
                       "SELECT l_returnflag, l_linestatus, array_to_string(ns, ',') AS a, "
                       "string_agg(DISTINCT CAST(q AS VARCHAR), ',' ORDER BY CAST(q AS VARCHAR)) AS b FROM a "
                       "GROUP BY l_returnflag, l_linestatus, ns",
    "fuse_nested": "WITH d AS (SELECT DISTINCT l_suppkey, l_returnflag AS r, l_linestatus AS k, CAST(l_linenumber AS BIGINT) AS n "
                   "FROM lineitem) SELECT l_suppkey, r, CAST(i.c AS INTEGER) AS n_items, k, "
                   "CAST(count(*) OVER (PARTITION BY l_suppkey, r, k) AS INTEGER) AS n_subs, n "
                   "FROM d JOIN (SELECT l_suppkey, r, count(DISTINCT k) AS c FROM d GROUP BY 1, 2) i USING (l_suppkey, r)",
    "rows_distinct": "SELECT DISTINCT user_id, event_type FROM events",
    "union_by_name": "SELECT c_custkey AS k, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS bal FROM customer "
                     "UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier",
    "align_schema": "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS segment "
                    "FROM customer",
    "null_fill": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value ELSE CAST(-2147483648.0 AS DOUBLE) END "
                 "AS value, CASE WHEN event_id % 3 = 0 THEN event_type ELSE '___NOVALUE___' END AS event_type "
                 "FROM events",
    "tag_drop_rename": "SELECT event_id, user_id, event_type AS type, 'json' AS source FROM events",
    "column_comment": "SELECT event_id, '1,2' AS comment, CAST(NULL AS VARCHAR) AS type_comment FROM events",
    "filter_eq": "SELECT event_id, user_id FROM events WHERE event_type = 'view'",
    "filter_not": "SELECT event_id FROM events WHERE NOT (event_type = 'click')",
    "filter_contains": "SELECT p_partkey FROM part WHERE contains(p_name, 'ring')",
    "worklog_append": f'SELECT DISTINCT event_type AS "table", unnest([{P}, \'dt=extra\']) AS partition FROM events',
    "worklog_remove_partition": f'SELECT DISTINCT event_type AS "table", {P} AS partition FROM events '
                                f"WHERE event_type <> 'click' OR {D} <> '20240102'",
    "worklog_remove_table": f'SELECT DISTINCT event_type AS "table", {P} AS partition FROM events '
                            "WHERE event_type <> 'click'",
    "worklog_latest_run": f'SELECT "table", max(partition) AS last_finished FROM (SELECT event_type AS "table", '
                          f"CAST(ts AS DATE) AS date, {P} AS partition FROM events) l "
                          "WHERE date = (SELECT max(CAST(e.ts AS DATE)) FROM events e WHERE e.event_type = l.\"table\") "
                          "GROUP BY 1",
    "max_done_partition": f'SELECT event_type AS "table", max({P}) AS max_done_partition FROM events GROUP BY 1',
    "was_interrupted": f'SELECT event_type AS "table", max({P}) <> (SELECT max({P}) FROM events) AS interrupted '
                       f"FROM events WHERE event_type <> 'click' OR {D} <= '20240125' GROUP BY 1",
    "has_new_partitions": f'SELECT event_type AS "table", count(DISTINCT {D}) < (SELECT count(DISTINCT {D}) FROM events) AS has_new, '
                          f"max({P}) <> (SELECT max({P}) FROM events) AS has_new_max "
                          f"FROM events WHERE {D} < '20240120' OR event_type = 'click' GROUP BY 1",
    "schema_rows": "SELECT * FROM (VALUES ('c___name','string'), ('c_custkey','bigint'), "
                   "('os_exploded___o_orderkey','bigint'), ('os_exploded___o_orderstatus','string')) "
                   "t(col_name, data_type)",
    "schema_root_diff": "SELECT * FROM (VALUES ('event_id','bigint','bigint',true), ('a','string','double',false), "
                        "('extra',NULL,'boolean',true)) t(col_name, old, new, compatible)",
    "schema_nested_diff": "SELECT CAST(1 AS BIGINT) AS n_same",
    "unify_schemas": "SELECT * FROM (VALUES ('a','string'), ('event_id','bigint'), ('st___p','bigint'), "
                     "('st___q','string'), ('extra','boolean')) t(col_name, data_type)",
    "needs_recalc": "SELECT * FROM (VALUES ('direct',true), ('unified',true), ('unified_old_only',false), "
                    "('root_added',false)) t(\"check\", rebuild)",
    "is_flat": "SELECT * FROM (VALUES ('events',true), ('customer_orders',false)) t(frame, is_flat)",
    "full_import": _EVENTS_FLAT,
    "incremental_many_partitions": "SELECT event_id, event_type, strftime(ts,'%Y%m%d:%H') AS dt FROM events",
    "incremental_late_files": f"SELECT DISTINCT event_id, CASE WHEN {D} > '20240120' THEN 'u' ELSE '' END || user_id AS \"user\", "
                              f"CASE WHEN {D} IN ('20240102','20240105','20240109') AND event_id % 2 = 0 THEN event_type END AS late, "
                              f"{D} AS dt FROM events",
    "incremental_type_change": f"SELECT event_id, CASE WHEN {D} <= '20240110' THEN event_type WHEN {D} <= '20240115' THEN "
                               f"CAST(event_id AS VARCHAR) WHEN {D} <= '20240120' THEN CAST(event_id % 2 = 0 AS VARCHAR) ELSE "
                               f"'{{\"B\":' || event_id || ',\"a\":\"' || event_type || '\"}}' END AS v, {D} AS dt FROM events",
    "incremental_null_days": f"SELECT DISTINCT event_id, CASE WHEN {D} > '20240110' THEN user_id END AS late, "
                             f"CASE WHEN {D} <= '20240110' THEN value END AS early, "
                             f"CASE WHEN {D} > '20240120' THEN event_id % 2 = 0 END AS flag, {D} AS dt FROM events",
    "incremental_emptied_day": _EVENTS_FLAT + f" WHERE {D} NOT IN ('20240103', '20240117')",
    "import_after_crash": f"SELECT *, true AS repaired FROM (SELECT DISTINCT event_id, user_id, event_type, value, "
                          f"CAST(json_extract(props,'$.k') AS BIGINT) AS k, "
                          f"CASE WHEN {D} > '20240115' THEN event_id % 7 END AS extra, {D} AS dt FROM events)",
    "stream_import": _EVENTS_FLAT,
    "convert_database": f"SELECT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'rest' END AS tbl, event_id, "
                        f"{D} AS dt FROM events",
    "incremental_import": f"SELECT DISTINCT event_id, user_id, event_type, value, "
                          f"CAST(json_extract(props,'$.k') AS BIGINT) AS k, "
                          f"CASE WHEN {D} > '20240120' THEN event_id % 7 END AS extra, {D} AS dt FROM events",
}
