"""Claims on a table: of two runs that convert the same table into the same log,
one waits or fails clearly.

A claim is a small file below ``<log>/_claims/<table>/`` (hidden from Spark's
readers). Nothing is asked of the storage but that a file is listed once it is
written: a run writes a file of its own as a candidate and then looks around.
It withdraws if a claim is held or a smaller candidate is there; otherwise it
marks its claim as held and looks again, and withdraws if there is a smaller one.
Of any two runs, the one that writes later sees the other, so never both go on.
A claim that has not been renewed for ``EXPIRY`` belongs to a run that died.
"""

from __future__ import annotations

import threading
import time
import uuid
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import SparkSession

from . import fs

EXPIRY = 6 * 3600.0             # seconds; a run renews its claim before and after it writes
POLL = 0.2
HELD, CANDIDATE = ".held", ".candidate"

_mine = threading.local()


class TableBusy(RuntimeError):
    """Another run converts this table."""


def _folder(log_path: str, table: str) -> str:
    return f"{log_path.rstrip('/')}/_claims/{quote(table, safe='')}"


def _others(spark: SparkSession, folder: str, name: str, expiry: float) -> dict[str, bool]:
    """Names of the living claims of other runs -> held?"""
    now, out = time.time(), {}
    for path, written in fs.file_times(spark, folder).items():
        own, _, kind = path.rpartition(".")
        if own == name:
            continue
        if now - written / 1000 > expiry:
            fs.delete_file(spark, f"{folder}/{path}")
        else:
            out[own] = out.get(own, False) or f".{kind}" == HELD
    return out


def _try(spark: SparkSession, folder: str, name: str, expiry: float) -> str | None:
    """None: held by this run now; otherwise the name of a claim in the way."""
    candidate, held = f"{folder}/{name}{CANDIDATE}", f"{folder}/{name}{HELD}"
    fs.write_text(spark, candidate, "")
    others = _others(spark, folder, name, expiry)
    blocked = next((o for o, is_held in sorted(others.items()) if is_held or o < name), None)
    if blocked is None:
        fs.write_text(spark, held, "")          # the candidate stays until then, so the claim is never out of sight
        others = _others(spark, folder, name, expiry)
        blocked = next((o for o in sorted(others) if o < name), None)
        if blocked is not None:
            fs.delete_file(spark, held)
    fs.delete_file(spark, candidate)
    return blocked


def renew(spark: SparkSession, log_path: str | None, table: str) -> None:
    """The claim of this thread on the table is alive."""
    held = getattr(_mine, "held", {}).get((log_path, table))
    if held:
        fs.write_text(spark, held, "")


@contextmanager
def claim(spark: SparkSession, log_path: str | None, table: str, wait: float = 0.0, expiry: float = EXPIRY):
    """Hold the table for the block; waits up to ``wait`` seconds for another run,
    then raises :class:`TableBusy`. Within a claim of the same thread (a job that
    calls another), and without a log, it does nothing."""
    held = _mine.__dict__.setdefault("held", {})
    if log_path is None or (log_path, table) in held:
        yield
        return
    folder, until = _folder(log_path, table), time.monotonic() + wait
    while True:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        blocked = _try(spark, folder, name, expiry)
        if blocked is None:
            break
        if time.monotonic() >= until:
            raise TableBusy(f"table {table!r} is being converted by another run (claim {blocked} in {folder})")
        time.sleep(POLL)
    held[log_path, table] = f"{folder}/{name}{HELD}"
    try:
        yield
    finally:
        fs.delete_file(spark, held.pop((log_path, table)))
