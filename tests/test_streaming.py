"""Streaming form of the incremental import: late files in old partitions."""

from lakenorm.plans.convert import read_converted
from lakenorm.streaming.ingest import stream_import
from tests.test_jobs import _source, write_day


def test_stream_notices_late_file_in_old_partition(spark, tmp_path):
    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log, ck = (str(tmp_path / x) for x in ("t", "l", "ck"))
    first = stream_import(spark, src, tgt, log, ck, table="clicks")
    assert [(r.mode, len(r.partitions)) for r in first] == [("incremental", 2)]
    assert stream_import(spark, src, tgt, log, ck, table="clicks") == []     # nothing new: no batch
    write_day(src, "20240101", [{"Id": 7, "user": {"Name": "late"}, "Items": []}])
    late = stream_import(spark, src, tgt, log, ck, table="clicks")
    assert [(r.mode, r.partitions) for r in late] == [("incremental", ["dt=20240101"])]
    df = read_converted(spark, tgt, log, "clicks")
    assert df.filter("dt = '20240101'").count() == 4 and df.count() == 7


def test_replayed_batch_leaves_the_same_table(spark, tmp_path):
    # A crash after foreachBatch wrote but before Spark recorded the commit:
    # the restart replays the batch from its recorded offsets.
    import os

    src = _source(tmp_path, ["20240101", "20240102"])
    tgt, log, ck = (str(tmp_path / x) for x in ("t", "l", "ck"))
    stream_import(spark, src, tgt, log, ck, table="clicks")
    write_day(src, "20240101", [{"Id": 7, "user": {"Name": "late"}, "Items": []}])
    stream_import(spark, src, tgt, log, ck, table="clicks")

    def rows():
        return sorted(tuple(r) for r in read_converted(spark, tgt, log, "clicks").collect())

    before = rows()
    commits = os.path.join(ck, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(os.path.join(commits, last))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    replay = stream_import(spark, src, tgt, log, ck, table="clicks")
    assert replay == []         # the day's files are those logged
    assert rows() == before and len(before) == 7


def test_every_day_is_converted_once(spark, tmp_path):
    src = _source(tmp_path, [])
    for day in ("20240101", "20240102", "20240103"):
        for i in range(3):
            write_day(src, day, [{"Id": i, "user": {"Name": day}, "Items": []}])
    tgt, log, ck = (str(tmp_path / x) for x in ("t", "l", "ck"))
    done = stream_import(spark, src, tgt, log, ck, table="clicks", max_files_per_trigger=2)
    assert sorted(p for r in done for p in r.partitions) == ["dt=20240101", "dt=20240102", "dt=20240103"]
    assert read_converted(spark, tgt, log, "clicks").count() == 9
