"""Two runs of one table: one waits or fails clearly."""

import json
import os
import threading
import time

import pytest

from lakenorm.plans import convert
from lakenorm.plans.convert import full_import, incremental_import, read_converted
from lakenorm.sources import claims, fs
from lakenorm.sources import worklog as wl
from lakenorm.sources.claims import TableBusy, claim


def source(tmp_path, days=3, rows=5):
    root = str(tmp_path / "src" / "clicks")
    for d in range(1, days + 1):
        os.makedirs(f"{root}/dt=2024010{d}", exist_ok=True)
        with open(f"{root}/dt=2024010{d}/part-0.json", "w") as fh:
            fh.write("\n".join(json.dumps({"Id": i, "Day": d}) for i in range(rows)))
    return root


def files(log, table="clicks"):
    folder = f"{log}/_claims/{table}"
    return sorted(f for f in os.listdir(folder) if not f.startswith(".")) if os.path.isdir(folder) else []


def test_a_claim_excludes_others_and_ends(spark, tmp_path):
    log = str(tmp_path / "log")
    with claim(spark, log, "clicks"):
        assert [f.rpartition(".")[2] for f in files(log)] == ["held"]
        with claim(spark, log, "clicks"):           # a job within a job
            pass
        assert len(files(log)) == 1
        with claim(spark, log, "other/table"), claim(spark, None, "clicks"):
            pass
        failed = []

        def other():
            try:
                with claim(spark, log, "clicks", wait=0.3):
                    failed.append("both")
            except TableBusy as e:
                failed.append(str(e))
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert len(failed) == 1 and "another run" in failed[0]
    assert files(log) == []
    with pytest.raises(ZeroDivisionError), claim(spark, log, "clicks"):
        1 / 0
    assert files(log) == []


def test_only_one_of_many_holds_at_any_time(spark, tmp_path):
    log, inside, most, done = str(tmp_path / "log"), [0], [0], []
    lock = threading.Lock()

    def run():
        with claim(spark, log, "t", wait=60):
            with lock:
                inside[0] += 1
                most[0] = max(most[0], inside[0])
            time.sleep(0.02)
            with lock:
                inside[0] -= 1
                done.append(1)
    threads = [threading.Thread(target=run) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert most == [1] and len(done) == 8 and files(log, "t") == []


def test_a_later_smaller_candidate_sees_what_is_held(spark, tmp_path):
    """Clocks that differ: the name says earlier, the file comes later."""
    folder = str(tmp_path / "f")
    assert claims._try(spark, folder, "b", 60) is None
    assert claims._try(spark, folder, "a", 60) == "b" and claims._try(spark, folder, "c", 60) == "b"
    assert os.listdir(folder) and [f for f in sorted(os.listdir(folder)) if not f.startswith(".")] == ["b.held"]


def test_the_claim_of_a_dead_run_expires(spark, tmp_path):
    log = str(tmp_path / "log")
    dead = f"{log}/_claims/clicks/00000000000000000001-dead.held"
    fs.write_text(spark, dead, "")
    with pytest.raises(TableBusy), claim(spark, log, "clicks"):
        pass
    os.utime(dead, (time.time() - 100,) * 2)
    with claim(spark, log, "clicks", expiry=60):
        assert len(files(log)) == 1 and "dead" not in files(log)[0]


def test_simultaneous_imports(spark, tmp_path, monkeypatch):
    src, tgt, log = source(tmp_path), str(tmp_path / "tgt"), str(tmp_path / "log")
    entered, go = threading.Event(), threading.Event()
    inner = convert.write_partitions

    def slow(*a, **k):
        entered.set()
        go.wait(30)
        return inner(*a, **k)
    monkeypatch.setattr(convert, "write_partitions", slow)
    out = []
    first = threading.Thread(target=lambda: out.append(incremental_import(spark, src, tgt, log).mode))
    first.start()
    assert entered.wait(60)
    with pytest.raises(TableBusy):
        full_import(spark, src, tgt, log)
    with pytest.raises(TableBusy):
        incremental_import(spark, src, tgt, log)
    second = threading.Thread(target=lambda: out.append(incremental_import(spark, src, tgt, log, wait=60).mode))
    second.start()
    go.set()
    first.join()
    second.join()
    assert out == ["full", "none"]                  # the second found nothing left to do
    assert read_converted(spark, tgt, log, "clicks").count() == 15 and files(log) == []
    assert wl.read_log(spark, log).where("status = 'seed'").count() == 1      # claims do not make a log
    assert len(wl.table_status(spark, log, "clicks").done) == 3 and not wl.was_interrupted(spark, log, "clicks")


def test_a_log_is_compacted_while_it_is_read(spark, tmp_path):
    log = str(tmp_path / "log")
    for d in range(4):
        wl.append_rows(spark, log, [("d", "clicks", f"dt={d}", "dt=3", "r", "done", wl.now_stamp())])
    folder = f"{log}/table=clicks"
    reading = wl.read_log(spark, log, "clicks")                 # has listed its files
    assert reading.limit(1).count() == 1
    assert wl.compact_log(spark, log, "clicks", min_files=4, grace=3600) == 4
    assert sorted(r.partition for r in reading.collect()) == [f"dt={d}" for d in range(4)]
    # both generations are there, and no answer depends on it
    assert len(wl.fs.list_files(spark, folder)) == 5
    assert wl.table_status(spark, log, "clicks").done == [f"dt={d}" for d in range(4)]
    assert wl.latest_run(wl.read_log(spark, log)).where("table = 'clicks'").count() == 4
    # the old generation is no input of the next compaction, and goes when its time is over
    assert wl.compact_log(spark, log, "clicks", min_files=2, grace=3600) == 0
    wl.append_rows(spark, log, [("d", "clicks", "dt=4", "dt=4", "s", "done", wl.now_stamp())])
    assert wl.compact_log(spark, log, "clicks", min_files=2, grace=3600) == 2
    assert len(wl.fs.list_files(spark, folder)) == 7
    assert wl.compact_log(spark, log, "clicks", min_files=2, grace=0) == 0
    assert len(wl.fs.list_files(spark, folder)) == 1
    assert wl.read_log(spark, log, "clicks").count() == 5
