"""A registered query turns red when its operator does nothing."""

import pytest

from lakenorm.plans import registry
from lakenorm.sources import worklog as wl
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


def lower_only(df, **kw):
    """The normaliser without its work: names in lower case, nothing else."""
    return df.toDF(*[c.lower() for c in df.columns])


@pytest.mark.parametrize("query", ["sort_columns", "normalize_schema", "fuse_arrays", "fuse_arrays_single", "fuse_arrays_two", "fuse_nested"])
def test_without_the_normaliser(spark, monkeypatch, query):
    monkeypatch.setattr(registry, "normalize", lower_only)
    assert not compare(spark, SF, [query], verbose=False)[query].startswith("ok")


def test_without_the_log(spark, monkeypatch):
    monkeypatch.setattr(wl, "mark_done", lambda *a, **k: None)
    assert not compare(spark, SF, ["worklog_append"], verbose=False)["worklog_append"].startswith("ok")
    monkeypatch.setattr(wl, "done_listings", lambda log, table=None: log.select("table", "partition", "listing").limit(0))
    for query in ("max_done_partition", "has_new_partitions"):
        assert not compare(spark, SF, [query], verbose=False)[query].startswith("ok")


def test_without_the_repair(spark, monkeypatch):
    monkeypatch.setattr(wl, "mark_started", lambda *a, **k: None)
    assert not compare(spark, SF, ["import_after_crash"], verbose=False)["import_after_crash"].startswith("ok")
