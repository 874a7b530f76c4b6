"""Partitions, work log and import jobs (FIXTURES sections 2, 5, 6)."""

import json
import os

from pyspark.sql import functions as F

from lakenorm.plans.convert import convert_database, full_import, incremental_import, read_converted
from lakenorm.session import scratch_path
from lakenorm.sources import worklog as wl
from lakenorm.sources.partitions import (drop_partition, file_inventory, list_partitions, partitions_to_recalc,
                                         validate_partitions)


def write_day(root, dt, rows):
    d = os.path.join(root, f"dt={dt}")
    os.makedirs(d, exist_ok=True)
    n = len(os.listdir(d))
    with open(os.path.join(d, f"part-{n}.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))


def frame(spark, values, name="partition"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def todo(spark, source, done):
    out = partitions_to_recalc(frame(spark, source), frame(spark, done))
    return sorted(r.partition for r in out.collect())


def test_work_list_w1_to_w3(spark):
    assert todo(spark, ["01", "02", "03"], []) == ["01", "02", "03"]
    assert todo(spark, ["01", "02", "03"], ["01", "02"]) == ["02", "03"]
    assert todo(spark, ["01", "02", "03", "04"], ["01", "03"]) == ["02", "03", "04"]


def _log(spark, rows):
    path = scratch_path(spark, "test-log")
    wl.append_rows(spark, path, [(d, "t", p, m, r, "done", wl.now_stamp()) for d, p, m, r in rows])
    return path


def test_l1_l2_l3_interrupted(spark):
    finished = _log(spark, [("d1", "dt=20240101", "dt=20240102", "r1"), ("d1", "dt=20240102", "dt=20240102", "r1")])
    assert not wl.was_interrupted(spark, finished, "t")
    broken = _log(spark, [("d1", "dt=20240101", "dt=20240103", "r1"), ("d1", "dt=20240102", "dt=20240103", "r1")])
    assert wl.was_interrupted(spark, broken, "t")
    assert wl.was_interrupted(spark, finished, "other")


def test_l4_to_l6_new_partitions(spark):
    log = wl.read_log(spark, _log(spark, [("d", "dt=20240101", "dt=20240103", "r"),
                                          ("d", "dt=20240103", "dt=20240103", "r")]))
    assert not wl.has_new_partitions(log, frame(spark, ["dt=20240101", "dt=20240103"]), "t")
    assert wl.has_new_partitions(log, frame(spark, ["dt=20240101", "dt=20240103", "dt=20240104"]), "t")
    backfill = frame(spark, ["dt=20240101", "dt=20240102", "dt=20240103"])
    assert not wl.has_new_partitions(log, backfill, "t", rule="max")
    assert wl.has_new_partitions(log, backfill, "t", rule="set")


def test_remove_is_append_only(spark):
    path = _log(spark, [("d", "dt=1", "dt=2", "r"), ("d", "dt=2", "dt=2", "r")])
    wl.remove_partition(spark, path, "t", "dt=1")
    assert [r.partition for r in wl.done_partitions(wl.read_log(spark, path), "t").collect()] == ["dt=2"]
    wl.remove_table(spark, path, "t")
    assert wl.done_partitions(wl.read_log(spark, path), "t").count() == 0
    assert wl.read_log(spark, path).count() == 4


def test_log_is_partitioned_by_table_and_compacts(spark):
    path = _log(spark, [("d", "dt=1", "dt=3", "r1"), ("d", "dt=2", "dt=3", "r1")])
    wl.append_rows(spark, path, [("d", "u", "dt=9", "dt=9", "r1", "done", wl.now_stamp(), None, None)])
    for p in ("dt=2", "dt=3"):
        wl.mark_done(spark, path, "t", [p], "dt=3", "r2")
    assert wl.fs.list_dirs(spark, path) == ["table=t", "table=u"]
    # one table's rows come from its own folder only
    assert wl.read_log(spark, path, "u").select("partition").collect()[0][0] == "dt=9"

    def answers():
        log = wl.read_log(spark, path)
        return (sorted(tuple(r) for r in wl.done_partitions(log).collect()),
                sorted(tuple(r) for r in wl.latest_run(log).select("table", "partition").collect()),
                wl.was_interrupted(spark, path, "t"), wl.table_status(spark, path, "t").done)

    before = answers()
    n_rows = wl.read_log(spark, path, "t").count()
    folder = f"{path}/table=t"
    files = wl.fs.list_files(spark, folder)
    assert len(files) == 3
    assert wl.compact_log(spark, path, "t", min_files=4) == 0
    assert wl.compact_log(spark, path, "t", min_files=3) == 3
    assert len(wl.fs.list_files(spark, folder)) == 1
    assert wl.read_log(spark, path, "t").count() == n_rows
    assert answers() == before
    # a crash between writing the copy and deleting the old files leaves every row twice
    wl._write(wl.read_log(spark, path, "t").coalesce(1), path)
    assert wl.read_log(spark, path, "t").count() == 2 * n_rows
    assert answers() == before
    assert wl.compact_log(spark, path, "t", min_files=2) == 2
    assert wl.read_log(spark, path, "t").count() == n_rows


def test_health_check_judges_no_file_by_its_size(spark, tmp_path):
    """A table whose first, only, or every file is junk; large files without rows."""
    path = str(tmp_path / "tbl")
    spark.range(3).select("id", F.lit("20240103").alias("dt")).write.partitionBy("dt").parquet(path)
    for day, size in (("20240101", 7), ("20240105", 70 << 20)):       # the first day, and a large one
        os.makedirs(f"{path}/dt={day}")
        with open(f"{path}/dt={day}/part-junk.parquet", "wb") as fh:
            fh.truncate(size)
    spark.range(0).write.parquet(f"{path}/dt=20240106")
    want = {"20240101": "unreadable", "20240103": "ok", "20240105": "unreadable", "20240106": "empty"}
    for deep in (False, True):
        assert {r.dt: r.status for r in validate_partitions(spark, path, deep=deep).collect()} == want
    only = str(tmp_path / "only")
    os.makedirs(f"{only}/dt=20240101")
    with open(f"{only}/dt=20240101/part-junk.parquet", "w") as fh:
        fh.write("junk")
    for deep in (False, True):
        assert [(r.dt, r.status) for r in validate_partitions(spark, only, deep=deep).collect()] == [("20240101", "unreadable")]


def test_health_check(spark, tmp_path):
    path = str(tmp_path / "tbl")
    df = spark.range(30).select(F.col("id"), F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string")).alias("dt"))
    df.write.partitionBy("dt").parquet(path)
    os.makedirs(f"{path}/dt=20240105")
    with open(f"{path}/dt=20240105/junk.parquet", "w") as fh:
        fh.write("junk")
    spark.range(0).write.parquet(f"{path}/dt=20240106")
    out = {r.dt: r.status for r in validate_partitions(spark, path).collect()}
    assert out == {"20240101": "ok", "20240102": "ok", "20240103": "ok", "20240105": "unreadable",
                   "20240106": "empty"}
    deep = {r.dt: r.status for r in validate_partitions(spark, path, deep=True).collect()}
    assert deep == out
    # damaged data pages behind an intact footer: only the deep check reads them (the local
    # file system's checksum sidecar is removed, as object stores keep none)
    day = os.path.join(path, "dt=20240102")
    name = sorted(f for f in os.listdir(day) if f.endswith(".parquet"))[0]
    damaged = os.path.join(day, name)
    with open(damaged, "r+b") as fh:
        fh.seek(4)
        fh.write(b"\xff" * 40)
    os.remove(os.path.join(day, f".{name}.crc"))
    assert {r.dt: r.status for r in validate_partitions(spark, path).collect()}["20240102"] == "ok"
    deep = validate_partitions(spark, path, deep=True)
    assert {r.dt: r.status for r in deep.collect()}["20240102"] == "unreadable"
    assert "checksum" in deep.columns and "xxhash64" in deep._jdf.queryExecution().executedPlan().toString()


def test_health_check_and_path_names_with_escapes(spark, tmp_path):
    """Table folder, partition values and file names holding a space, ``%``,
    ``:``, ``=`` and ``+``: footers and listing must still meet."""
    import shutil
    from lakenorm.sources.partitions import partition_from_path
    path = str(tmp_path / "odd dir%x+y")
    spark.createDataFrame([(1, "2024 01:x"), (2, "a%b=c+d"), (3, "20240103")], "id int, dt string") \
        .write.partitionBy("dt").parquet(path)
    day = os.path.join(path, "dt=20240103")
    first = sorted(f for f in os.listdir(day) if f.endswith(".parquet"))[0]
    shutil.copy(os.path.join(day, first), os.path.join(day, "copy %20 +x.parquet"))
    out = {r.dt: r.status for r in validate_partitions(spark, path).collect()}
    assert out == {"2024 01:x": "ok", "a%b=c+d": "ok", "20240103": "ok"}
    dirs = {r.partition for r in partition_from_path(spark.read.parquet(path)).collect()}
    assert dirs == set(os.listdir(path)) - {"_SUCCESS", "._SUCCESS.crc"}


def test_drop_partition_exact(spark, tmp_path):
    path = str(tmp_path / "tbl")
    spark.createDataFrame([(1, "1"), (2, "11")], "id int, dt string").write.partitionBy("dt").parquet(path)
    drop_partition(spark, path, "dt=1")
    assert sorted(r.partition for r in list_partitions(spark, path).collect()) == ["dt=11"]
    assert file_inventory(spark, path).count() >= 1


def _source(tmp_path, days, extra=False):
    root = str(tmp_path / "src" / "clicks")
    for d in days:
        rows = [{"Id": i, "user": {"Name": f"u{i}"}, "Items": [{"A": i}, {"a": i}]} for i in range(3)]
        if extra:
            for r in rows:
                r["Extra"] = True
        write_day(root, d, rows + rows)
    return root


def _table(spark, tgt, log):
    df = read_converted(spark, tgt, log, "clicks")
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_incremental_equals_full(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log = str(tmp_path / "inc"), str(tmp_path / "inc_log")
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "full"
    _source(tmp_path, ["20240103"])
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.mode == "incremental" and res.partitions == ["dt=20240102", "dt=20240103"]
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"
    ftgt, flog = str(tmp_path / "full"), str(tmp_path / "full_log")
    full_import(spark, src, ftgt, flog, table="clicks")
    assert _table(spark, tgt, log) == _table(spark, ftgt, flog)
    assert len(_table(spark, tgt, log)) == 9
    # the schemas are stored once per run (two runs wrote data), not once per partition
    with_schema = wl.read_log(spark, log, "clicks").filter(F.col("table_schema").isNotNull())
    assert with_schema.count() == 2 and with_schema.filter(F.col("source_schema").isNull()).count() == 0


def test_root_column_added_without_rebuild_nested_with_rebuild(spark, tmp_path):
    src = _source(tmp_path, ["20240101"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    _source(tmp_path, ["20240102"], extra=True)
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "incremental"
    assert "extra" in read_converted(spark, tgt, log, "clicks").columns
    write_day(src, "20240103", [{"Id": 9, "user": {"Name": "x", "Age": 3}, "Items": []}])
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "rebuild"
    df = read_converted(spark, tgt, log, "clicks")
    assert df.schema["user"].dataType.simpleString() == "struct<age:bigint,name:string>"
    assert df.count() == 7


def test_bigint_to_double_rebuilds_even_with_numeric_widening(spark, tmp_path):
    """Old Parquet files hold ``id`` as INT64, which the reader cannot return
    as DOUBLE: the table stays readable only through a rebuild."""
    src = _source(tmp_path, ["20240101"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks", numeric_widening=True)
    write_day(src, "20240102", [{"Id": 1.5, "user": {"Name": "x"}, "Items": [{"A": 1}]}])
    assert incremental_import(spark, src, tgt, log, table="clicks", numeric_widening=True).mode == "rebuild"
    df = read_converted(spark, tgt, log, "clicks")
    assert df.schema["id"].dataType.simpleString() == "double"
    assert sorted(r.id for r in df.collect()) == [0.0, 1.0, 1.5, 2.0]


def test_crash_between_data_and_log_then_rerun(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    _source(tmp_path, ["20240103"])
    # crash: data of day 3 written, log not (simulate by writing it as a job would, then no log rows)
    from lakenorm.operators.normalize import normalize
    from lakenorm.sources.json_source import read_json_table
    from lakenorm.sources.parquet_sink import write_partitions
    write_partitions(normalize(read_json_table(spark, src, ["dt=20240103"])), tgt)
    # an interrupted log run: planned up to day 3, finished day 2 only
    wl.append_rows(spark, log, [(wl.today(), "clicks", "dt=20240102", "dt=20240103", "zz-crashed", "done",
                                 wl.now_stamp(), None, None)])
    # and a broken file in day 2
    with open(f"{tgt}/dt=20240102/part-broken.parquet", "w") as fh:
        fh.write("broken")
    res = incremental_import(spark, src, tgt, log, table="clicks")
    # day 2 is dropped and redone; day 1 is now the newest converted one, so it is redone too
    assert res.dropped == ["dt=20240102"] and res.partitions == ["dt=20240101", "dt=20240102", "dt=20240103"]
    ftgt, flog = str(tmp_path / "full"), str(tmp_path / "full_log")
    full_import(spark, src, ftgt, flog, table="clicks")
    assert _table(spark, tgt, log) == _table(spark, ftgt, flog)


def _same_as_full(spark, src, tgt, log, tmp_path, name="again"):
    ftgt, flog = str(tmp_path / f"{name}_t"), str(tmp_path / f"{name}_l")
    full_import(spark, src, ftgt, flog, table="clicks")
    a, b = read_converted(spark, tgt, log, "clicks"), read_converted(spark, ftgt, flog, "clicks")
    assert {f.name: f.dataType.simpleString() for f in a.schema} == {f.name: f.dataType.simpleString() for f in b.schema}
    assert _rows(a) == _rows(b)


def test_late_and_changed_files_of_old_days_are_imported(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102", "20240103"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    write_day(src, "20240101", [{"Id": 8, "user": {"Name": "late"}, "Items": [], "Late": 1}])
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.mode == "incremental" and res.partitions == ["dt=20240101", "dt=20240103"]
    _same_as_full(spark, src, tgt, log, tmp_path, "one")
    write_day(src, "20240103", [{"Id": 9, "user": {"Name": "newest"}, "Items": []}])
    assert incremental_import(spark, src, tgt, log, table="clicks").partitions == ["dt=20240103"]
    # a malformed line and a type change in a late file: the rebuild keeps both
    with open(os.path.join(src, "dt=20240102", "late.json"), "w") as fh:
        fh.write('not json\n{"Id": "text", "user": {"Name": 1.50}, "Items": []}')
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "rebuild"
    df = read_converted(spark, tgt, log, "clicks")
    assert df.filter("_corrupt_record = 'not json'").count() == 1 and df.filter("late = 1").count() == 1
    _same_as_full(spark, src, tgt, log, tmp_path, "two")
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"


def test_values_keep_the_text_a_full_import_gives(spark, tmp_path):
    src = str(tmp_path / "src" / "clicks")
    write_day(src, "20240101", [{"v": "text"}])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    os.makedirs(os.path.join(src, "dt=20240102"))
    with open(os.path.join(src, "dt=20240102", "p.json"), "w") as fh:
        fh.write('{"v": 1.50}\n{"v": 1e2}\n{"v": {"B":1,"a":null}}')
    incremental_import(spark, src, tgt, log, table="clicks")
    got = {r.v for r in read_converted(spark, tgt, log, "clicks").filter("dt = '20240102'").collect()}
    assert got == {"1.50", "1e2", '{"B":1,"a":null}'}
    _same_as_full(spark, src, tgt, log, tmp_path)


def test_crash_before_the_log_is_repaired_without_new_data(spark, tmp_path, monkeypatch):
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    write_day(src, "20240102", [{"Id": "a string now", "user": {"Name": "x"}, "Items": []}])

    def fails(*a, **k):
        raise RuntimeError("the log is out of reach")

    with monkeypatch.context() as m:
        m.setattr(wl, "mark_done", fails)
        try:
            full_import(spark, src, tgt, log, table="clicks")
            raise AssertionError("not reached")
        except RuntimeError:
            pass
    assert wl.was_interrupted(spark, log, "clicks")
    assert wl.table_status(spark, log, "clicks").open == ["dt=20240101", "dt=20240102"]
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "full"
    assert not wl.was_interrupted(spark, log, "clicks")
    _same_as_full(spark, src, tgt, log, tmp_path)
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"


def test_crash_in_an_increment_redoes_its_days(spark, tmp_path, monkeypatch):
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    _source(tmp_path, ["20240103"])
    import lakenorm.plans.convert as convert
    with monkeypatch.context() as m:
        m.setattr(convert, "write_partitions", lambda *a, **k: 1 / 0)
        try:
            incremental_import(spark, src, tgt, log, table="clicks")
        except ZeroDivisionError:
            pass
    assert wl.table_status(spark, log, "clicks").open == ["dt=20240102", "dt=20240103"]
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.mode == "incremental" and {"dt=20240102", "dt=20240103"} <= set(res.partitions)
    _same_as_full(spark, src, tgt, log, tmp_path)


def test_an_emptied_day_loses_its_rows(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102", "20240103"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    for f in os.listdir(os.path.join(src, "dt=20240102")):
        open(os.path.join(src, "dt=20240102", f), "w").close()
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.emptied == ["dt=20240102"]
    assert {r.dt for r in read_converted(spark, tgt, log, "clicks").collect()} == {"20240101", "20240103"}
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"
    assert full_import(spark, src, tgt, log, table="clicks").emptied == []


def test_a_rebuild_keeps_days_whose_source_has_expired(spark, tmp_path):
    import shutil
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    incremental_import(spark, src, tgt, log, table="clicks")
    shutil.rmtree(os.path.join(src, "dt=20240101"))
    write_day(src, "20240103", [{"Id": "text", "user": {"Name": "x"}, "Items": []}])
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.mode == "rebuild" and res.dropped == []
    df = read_converted(spark, tgt, log, "clicks")
    assert df.filter("dt = '20240101'").count() == 3 and {r.id for r in df.collect()} == {"0", "1", "2", "text"}


def test_many_folders_one_code_path(spark, tmp_path):
    """1, 33 and 100 new folders: without files none is imported, with files all are, escaped names too."""
    for n in (1, 33, 100):
        src = _source(tmp_path / str(n), ["20230101"])
        tgt, log = str(tmp_path / f"t{n}"), str(tmp_path / f"l{n}")
        incremental_import(spark, src, tgt, log, table="clicks")
        days = [f"2024%3A{i:03d}" for i in range(n - 1)] + ["__HIVE_DEFAULT_PARTITION__"]
        for d in days:
            os.makedirs(os.path.join(src, f"dt={d}"))
        assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"
        for d in days:
            write_day(src, d, [{"Id": 1, "user": {"Name": "x"}, "Items": []}])
        res = incremental_import(spark, src, tgt, log, table="clicks")
        assert res.mode == "incremental" and len(res.partitions) == n + 1 and res.emptied == []
        df = read_converted(spark, tgt, log, "clicks")
        assert df.count() == 3 + n and df.filter("dt is null").count() == 1
        assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"


def test_data_keys_named_like_the_partition_are_an_error(spark, tmp_path):
    import pytest
    from lakenorm.sources.json_source import read_json_table
    for key in ("dt", "DT"):
        src = str(tmp_path / key)
        write_day(src, "20240101", [{"a": 1, key: 5}])
        with pytest.raises(ValueError, match="partition column"):
            read_json_table(spark, src)


def test_legacy_format_is_reset_and_not_for_parallel_runs(spark, tmp_path):
    import pytest
    src = _source(tmp_path, ["20240101"])
    before = spark.conf.get("spark.sql.parquet.writeLegacyFormat")
    full_import(spark, src, str(tmp_path / "t"), legacy_format=True)
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == before
    with pytest.raises(ValueError, match="parallel"):
        convert_database(spark, str(tmp_path / "src"), str(tmp_path / "o"), str(tmp_path / "l"), parallel=2, legacy_format=True)


def test_storage_errors_are_raised_not_taken_for_missing_files(spark, tmp_path, monkeypatch):
    import pytest
    from lakenorm.sources import fs
    assert fs.has_files(spark, str(tmp_path / "nothing")) is False
    with pytest.raises(Exception, match="No FileSystem|nowhere|UnsupportedFileSystem"):
        fs.has_files(spark, "nowhere://x/y")
    with pytest.raises(Exception):
        fs.parquet_rows(spark, str(tmp_path / "nothing"))
    junk = tmp_path / "junk"
    junk.write_bytes(b"PAR1" + b"x" * 100 + b"PAR1")
    assert fs.parquet_rows(spark, str(junk)) is None


def test_full_import_removes_stale_and_keeps_on_empty(spark, tmp_path):
    src = _source(tmp_path, ["20240101"])
    tgt = str(tmp_path / "t")
    spark.createDataFrame([(1, "20231231")], "id bigint, dt string").write.partitionBy("dt").parquet(tgt)
    res = full_import(spark, src, tgt)
    assert res.dropped == ["dt=20231231"]
    empty = str(tmp_path / "empty_src")
    os.makedirs(empty)
    assert full_import(spark, empty, tgt).mode == "none"
    assert spark.read.parquet(tgt).count() == 3


def test_folders_that_are_not_partitions_are_left_alone(spark, tmp_path):
    src = _source(tmp_path, ["20240101"])
    write_day(os.path.join(src, "notes"), "x", [{"other": 1}])   # <src>/notes/dt=x/...: not a partition of src
    tgt = str(tmp_path / "t")
    os.makedirs(os.path.join(tgt, "keep_me"))
    with open(os.path.join(tgt, "keep_me", "readme.txt"), "w") as fh:
        fh.write("not a partition")
    res = full_import(spark, src, tgt)
    assert res.partitions == ["dt=20240101"] and res.dropped == []
    assert os.path.exists(os.path.join(tgt, "keep_me", "readme.txt"))
    assert "other" not in spark.read.parquet(os.path.join(tgt, "dt=20240101")).columns


def test_partition_folder_without_files_waits_for_its_data(spark, tmp_path):
    src = _source(tmp_path, ["20240101"])
    tgt, log = str(tmp_path / "t"), str(tmp_path / "l")
    empty = str(tmp_path / "empty" / "clicks")
    os.makedirs(os.path.join(empty, "dt=20240101"))
    assert full_import(spark, empty, tgt).mode == "none"
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "full"
    os.makedirs(os.path.join(src, "dt=20240102"))          # folder created, files not uploaded yet
    assert incremental_import(spark, src, tgt, log, table="clicks").mode == "none"
    assert "dt=20240102" not in wl.table_status(spark, log, "clicks").done
    write_day(src, "20240102", [{"Id": 7, "user": {"Name": "late"}, "Items": []}])
    res = incremental_import(spark, src, tgt, log, table="clicks")
    assert res.mode == "incremental" and res.partitions == ["dt=20240101", "dt=20240102"]
    assert read_converted(spark, tgt, log, "clicks").filter(F.col("dt") == "20240102").count() == 1


def test_convert_database(spark, tmp_path):
    root = tmp_path / "db"
    for t in ("a", "b"):
        write_day(str(root / t), "20240101", [{"X": 1, "x": None, "y": t}])
    res = convert_database(spark, str(root), str(tmp_path / "pq"), str(tmp_path / "log"))
    assert [r.mode for r in res] == ["full", "full"]
    assert spark.read.parquet(str(tmp_path / "pq" / "a")).columns == ["x", "y", "dt"]


def test_convert_database_in_parallel_equals_sequential(spark, tmp_path):
    root = tmp_path / "db"
    for i, t in enumerate(("a", "b", "c", "d")):
        for d in ("20240101", "20240102"):
            write_day(str(root / t), d, [{"X": i, "Nested": {"V": d}, "Items": [{"K": i}, {"K": i}]}] * 2)
    runs = {}
    for parallel in (1, 3):
        out, log = tmp_path / f"pq{parallel}", tmp_path / f"log{parallel}"
        res = convert_database(spark, str(root), str(out), str(log), parallel=parallel)
        assert [r.mode for r in res] == ["full"] * 4 and [r.table for r in res] == ["a", "b", "c", "d"]
        assert wl.fs.list_dirs(spark, str(log)) == ["table=a", "table=b", "table=c", "table=d", "table=example"]
        runs[parallel] = {t: _rows(read_converted(spark, str(out / t), str(log), t)) for t in "abcd"}
        assert all(wl.table_status(spark, str(log), t).done == ["dt=20240101", "dt=20240102"] for t in "abcd")
    assert runs[1] == runs[3]


def _rows(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_scratch_needs_shared_dir_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from lakenorm.session import shared_dir

    def session(master, ckpt=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: ckpt, set=lambda k, v: None),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                                                            setCheckpointDir=lambda d: None))

    for master in ("spark://head:7077", "local[8]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("yarn", "hdfs://nn/ckpt/")) == "hdfs://nn/ckpt"
