"""Listing ledger, health check by footers, linear folding of nested arrays."""

import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from lakenorm.operators.fuse import unite
from lakenorm.operators.normalize import PAIRS, distinct_elements
from lakenorm.plans.convert import full_import, incremental_import, read_converted
from lakenorm.sources import fs, partitions
from lakenorm.sources.partitions import NO_BYTES, footer_counts, list_days, validate_partitions
from lakenorm.streaming.ingest import stream_import

DAYS = [f"202401{d:02d}" for d in range(1, 13)]


def write_file(root, dt, name, rows):
    d = os.path.join(root, f"dt={dt}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))


def at_rest(root, days=DAYS):
    for d in days:
        os.utime(os.path.join(root, f"dt={d}"), (time.time() - 3600,) * 2)


@pytest.fixture
def source(tmp_path):
    root = str(tmp_path / "src" / "clicks")
    for d in DAYS:
        for k in range(20):
            write_file(root, d, f"part-{k}.json", [{"Id": k}])
    at_rest(root)
    return root


@pytest.fixture
def listed(monkeypatch):
    """Days whose files were listed, call by call."""
    calls = []
    inner = partitions.partition_files

    def spy(spark, table, names=None):
        assert names is not None, "an index of the whole tree"
        calls.append(sorted(names))
        return inner(spark, table, names)
    monkeypatch.setattr(partitions, "partition_files", spy)
    return calls


def values(spark, tgt, log):
    return sorted((r.dt, r.id) for r in read_converted(spark, tgt, log, "clicks").collect())


def test_only_changed_folders_are_listed(spark, tmp_path, source, listed, monkeypatch):
    monkeypatch.setattr(partitions, "LIST_CHUNK", 5)
    tgt, log = str(tmp_path / "tgt"), str(tmp_path / "log")
    assert incremental_import(spark, source, tgt, log, table="clicks").mode == "full"
    assert [len(c) for c in listed] == [5, 5, 2]            # never an index of more days than a chunk
    listed.clear()
    assert incremental_import(spark, source, tgt, log, table="clicks").mode == "none"
    assert listed == [["dt=20240110", "dt=20240111", "dt=20240112"]]      # the look-back
    listed.clear()
    write_file(source, "20240104", "late.json", [{"Id": 100}])            # a late file in an old day
    res = incremental_import(spark, source, tgt, log, table="clicks")
    assert sorted(d for c in listed for d in c) == ["dt=20240104", "dt=20240110", "dt=20240111", "dt=20240112"]
    assert res.partitions == ["dt=20240104", "dt=20240112"]
    assert ("20240104", 100) in values(spark, tgt, log) and len(values(spark, tgt, log)) == 12 * 20 + 1
    # the changed day has no time that could vouch for it until it has been at rest
    listed.clear()
    assert incremental_import(spark, source, tgt, log, table="clicks", look_back=0).mode == "none"
    assert listed == [["dt=20240104"]]


def test_exact_listing_sees_a_file_overwritten_in_place(spark, tmp_path, source):
    tgt, log = str(tmp_path / "tgt"), str(tmp_path / "log")
    incremental_import(spark, source, tgt, log, table="clicks")
    before = os.stat(f"{source}/dt=20240102").st_mtime
    write_file(source, "20240102", "part-3.json", [{"Id": 333}])
    assert os.stat(f"{source}/dt=20240102").st_mtime == before
    assert incremental_import(spark, source, tgt, log, table="clicks").mode == "none"      # documented
    res = incremental_import(spark, source, tgt, log, table="clicks", look_back=None)
    assert res.partitions == ["dt=20240102", "dt=20240112"] and ("20240102", 333) in values(spark, tgt, log)


def test_times_that_vouch_for_nothing_are_not_kept(spark, source):
    os.makedirs(f"{source}/dt=20240103/sub")
    at_rest(source)
    os.utime(f"{source}/dt=20240105")                       # changed just now
    os.makedirs(f"{source}/dt=20240199")                    # nothing in it yet
    write_file(source, "20240198", "empty.json", [])
    days = list_days(spark, source)
    assert days.times["dt=20240103"] is None and days.times["dt=20240105"] is None
    assert days.times["dt=20240104"] == str(int(os.stat(f"{source}/dt=20240104").st_mtime * 1000))
    assert "dt=20240199" not in days.listings and days.listings["dt=20240198"] == NO_BYTES
    again = list_days(spark, source, None, days.listings, {k: v for k, v in days.times.items() if v}, look_back=0)
    assert again.listings == days.listings
    assert again.listed == ["dt=20240103", "dt=20240105", "dt=20240198", "dt=20240199"]
    assert list_days(spark, str(source) + "-none").listings == {}


def test_stale_days_are_logged_in_one_append(spark, tmp_path, source, monkeypatch):
    from lakenorm.sources import worklog as wl
    tgt, log = str(tmp_path / "tgt"), str(tmp_path / "log")
    full_import(spark, source, tgt, log, table="clicks")
    for d in DAYS[:4]:
        shutil.rmtree(f"{source}/dt={d}")
    appends = []
    inner = wl.append_rows
    monkeypatch.setattr(wl, "append_rows", lambda s, path, rows: (appends.append(len(rows)), inner(s, path, rows))[1])
    res = full_import(spark, source, tgt, log, table="clicks")
    assert len(res.dropped) == 4 and appends == [8, 4, 8]    # started, removed, done
    assert len(wl.table_status(spark, log, "clicks").done) == 8


def test_stream_clears_a_day_whose_files_became_empty(spark, tmp_path, source):
    tgt, log, ckpt = (str(tmp_path / x) for x in ("tgt", "log", "ckpt"))
    stream_import(spark, source, tgt, log, ckpt, table="clicks")
    assert len(values(spark, tgt, log)) == 12 * 20
    shutil.rmtree(f"{source}/dt=20240106")
    write_file(source, "20240106", "part-new.json", [])
    stream_import(spark, source, tgt, log, ckpt, table="clicks")
    assert {d for d, _ in values(spark, tgt, log)} == set(DAYS) - {"20240106"}


# ------------------------------------------------------------ health by footers

def test_rows_are_counted_by_footers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tbl")
    spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("dt")).write.partitionBy("dt").parquet(path)
    spark.range(0).coalesce(1).write.parquet(f"{path}/dt=9")
    empty = next(f for f in os.listdir(f"{path}/dt=9") if f.endswith(".parquet"))
    for k in range(1000):
        shutil.copy(f"{path}/dt=9/{empty}", f"{path}/dt=9/copy-{k}.parquet")
    plan = footer_counts(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan

    def not_on_the_driver(*_):
        raise AssertionError("a footer read on the driver")
    monkeypatch.setattr(fs, "parquet_rows", not_on_the_driver)
    want = {"0": "ok", "1": "ok", "2": "ok", "9": "empty"}
    assert {r.dt: r.status for r in validate_partitions(spark, path).collect()} == want
    # broken files among those without rows: footers are read by tasks
    data = open(f"{path}/dt=9/{empty}", "rb").read()
    for day, raw in (("1", b"junk"), ("8", data[:-8] + b"\xff\xff\xff\x7fPAR1"), ("7", b"PAR1" + b"\0" * 40 + b"PAR1")):
        os.makedirs(f"{path}/dt={day}", exist_ok=True)
        with open(f"{path}/dt={day}/broken.parquet", "wb") as fh:
            fh.write(raw)
    want |= {"1": "unreadable", "8": "unreadable", "7": "unreadable"}
    monkeypatch.setattr(partitions, "SILENT_CHUNK", 300)
    for deep in (False, True):
        assert {r.dt: r.status for r in validate_partitions(spark, path, deep=deep).collect()} == want


# --------------------------------------------------------- folding in a value

def nested(spark, n, keys):
    item = F.struct((F.col("i") % keys).alias("a"), F.when(F.col("i") % 5 > 0, F.array(
        F.struct((F.col("i") % 7).alias("b")), F.struct((F.col("i") % 3).alias("b")))).alias("c"))
    return spark.range(n).withColumnRenamed("id", "i").agg(F.collect_list(item).alias("x")).cache()


def test_nested_fold_equals_plain_grouping(spark):
    df = nested(spark, 300, 11)
    got = df.select(unite(F.col("x"), df.schema["x"].dataType)).first()[0]
    want = {}
    for e in df.first().x:
        want.setdefault(e.a, set()).update(c.b for c in e.c or ())
    assert {e.a: [c.b for c in e.c] for e in got} == {a: sorted(b) for a, b in want.items()}
    assert len(got) == 11


def test_nested_fold_grows_linearly(spark):
    def seconds(n):
        df = nested(spark, n, n // 4)
        fold = df.select(F.size(unite(F.col("x"), df.schema["x"].dataType)))
        fold.collect()
        t = time.perf_counter()
        assert fold.first()[0] == n // 4
        return time.perf_counter() - t
    seconds(1000)
    assert seconds(64000) < 1.0 + 20 * seconds(4000)         # quadratic: 256 times


@pytest.mark.parametrize("n", [0, 1, PAIRS, PAIRS + 1, 400])
def test_long_arrays_lose_the_same_elements(spark, n):
    df = spark.range(3).select(F.transform(F.slice(F.sequence(F.lit(1), F.lit(500)), 1, n), lambda i: F.when(
        i % 6 > 0, F.struct((i * 7 % 31).alias("a"), F.when(i % 4 > 0, F.col("id") + i % 3).alias("b")))).alias("x"))
    r = df.selectExpr("array_distinct(x) w", f"{distinct_elements('x')} g", "array_distinct(array_sort(x)) wo",
                      f"{distinct_elements('x', True)} go").collect()
    assert all(x.w == x.g and x.wo == x.go for x in r)


# ------------------------------------------------- leaves that are null for days

NULLS = {   # values of a column by day, for five days
    "a": [None, 5, 5, None, 7], "b": [5, None, None, None, 2.5], "c": [None, None, "x", None, 3],
    "d": [[], [{"k": 1}], None, [], [{"k": None}]], "e": [{"k": None}, {"k": None}, {"k": [1]}, None, {"k": []}],
    "F": [None, None, None, None, None], "g": [[None], [None], [True], [None], []], "h": [{"x": {"y": None}}, None, {"x": None}, {"x": {"y": 1}}, None],
}


def test_days_without_values_do_not_decide_types(spark, tmp_path):
    """Day after day gives the schema and the rows of one import of all days."""
    src, tgt, log = (str(tmp_path / x) for x in ("src/clicks", "tgt", "log"))
    for day in range(5):
        write_file(src, f"2024010{day + 1}", "part-0.json", [{"i": day, **{c: v[day] for c, v in NULLS.items()}}])
        incremental_import(spark, src, tgt, log, table="clicks")
        assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"
    full_import(spark, src, f"{tgt}-full", f"{log}-full", table="clicks")
    one, all_ = (read_converted(spark, t, l, "clicks") for t, l in ((tgt, log), (f"{tgt}-full", f"{log}-full")))
    assert dict(one.dtypes) == dict(all_.dtypes)
    assert sorted(map(str, one.select(sorted(one.columns)).collect())) == sorted(map(str, all_.select(sorted(one.columns)).collect()))
    assert dict(all_.dtypes)["f"] == "string" and dict(all_.dtypes)["b"] == "double"


def test_void_leaves_merge_like_one_inference():
    from pyspark.sql import types as T

    from lakenorm.functions.schema import may_be_void, readable, string_leaves, unify_schemas, void_leaves, void_resolved, void_where_missing
    parse = T.StructType.fromDDL
    day1 = parse("v string, o struct<x: string, y: bigint>, l array<string>, s string")
    assert string_leaves(day1) == [("v",), ("o", "x"), ("l", "[]"), ("s",)]
    void = void_leaves(day1, {("v",), ("o", "x"), ("l", "[]")})
    day2 = parse("v bigint, o struct<x: array<bigint>, y: bigint>, l array<struct<a: bigint>>, s string")
    assert unify_schemas(void, day2) == unify_schemas(day2, void) == day2 and void_resolved(void, unify_schemas(void, day2))
    assert readable(void) == day1 and not void_resolved(void, day1)
    assert may_be_void(day2, day1) and not may_be_void(day1, day1) and not may_be_void(void, day1)
    assert void_where_missing(day1, parse("o struct<y: bigint>, s string")) == void_leaves(parse("v string, o struct<x: string, y: bigint>, l string, s string"),
                                                                                          {("v",), ("o", "x"), ("l",)})
