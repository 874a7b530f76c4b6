"""Import jobs: full import (O1), incremental import (O2), a whole database.

Each table import is one Spark job over all the partitions it touches:
read JSON (inference over exactly those files) -> normalise (one select and
one distinct) -> align to the table schema -> ``rebalance(dt)`` -> dynamic
partition overwrite. Partitions are never processed in a driver loop.

Crash safety: a run logs the partitions it is going to write as ``started``,
writes them, and logs them as ``done`` with a summary of the source files it
read. A partition left ``started`` is redone by the next run, whether or not
there is new data (a rewrite gives the same rows); the health check then also
finds broken partitions, which are redone from their source and never deleted
for being broken. A source partition whose files have changed since its
conversion (late, replaced or removed files) is work like a new one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import (may_be_void, needs_recalc, quote, readable, string_leaves, unify_schemas, void_leaves,
                                void_resolved, void_where_missing)
from ..operators.align import align
from ..operators.normalize import NormalizeOptions, normalize, normalized_schema
from ..session import configure
from ..sources import fs
from ..sources import worklog as wl
from ..sources.claims import claim, renew
from ..sources.json_source import PARTITION_COL, infer_json_schema, read_json_table
from ..sources.parquet_sink import observed, read_table, write_partitions
from ..sources.partitions import LOOK_BACK, Days, drop_partition, list_days, partition_names, validate_partitions, value_of, work_list


@dataclass
class ImportResult:
    table: str
    mode: str                      # "full", "incremental", "rebuild", "none"
    partitions: list[str] = field(default_factory=list)
    schema: T.StructType | None = None
    dropped: list[str] = field(default_factory=list)     # stale days removed, broken days replaced
    emptied: list[str] = field(default_factory=list)     # days whose source holds no row any more
    broken: list[str] = field(default_factory=list)      # broken days without a source, left as they are


def _data_schema(schema: T.StructType, partition_col: str = PARTITION_COL) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != partition_col])


def _table_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _options(depth, rows, **kw) -> NormalizeOptions:
    return NormalizeOptions(depth=depth, rows=rows, **kw)


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PARTITION_COL, T.StringType())])


def _read_source(spark: SparkSession, table_path: str, parts: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The given partitions; files without a byte have no schema and no row."""
    try:
        return read_json_table(spark, table_path, partitions=parts, schema=schema)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return read_json_table(spark, table_path, partitions=[])


class Watched:
    """A source frame that notes, while it is written, which of its string leaves
    ever hold a value."""

    def __init__(self, src: DataFrame):
        self.schema, self.paths = _data_schema(src.schema), string_leaves(_data_schema(src.schema))
        self.seen = Observation(f"leaves-{uuid.uuid4().hex}") if self.paths else None
        self.frame = src.observe(self.seen, *[F.max(_has_value(F.col(quote(p[0])), p[1:])).alias(f"l{i}")
                                              for i, p in enumerate(self.paths)]) if self.paths else src

    def source_schema(self) -> T.StructType:
        """The schema that was read, with leaves that were always null as void; after the write."""
        got = observed(self.seen) if self.seen else {}
        return void_leaves(self.schema, {p for i, p in enumerate(self.paths) if not got.get(f"l{i}")})


def _has_value(col: Column, path: tuple[str, ...]) -> Column:
    if not path:
        return col.isNotNull()
    if path[0] == "[]":
        return F.coalesce(F.exists(col, lambda e: _has_value(e, path[1:])), F.lit(False))
    return _has_value(col.getField(path[0]), path[1:])


def _drop_emptied(spark: SparkSession, target_table: str, parts: list[str], written: set) -> list[str]:
    """Remove the target days among ``parts`` that the run has left without rows."""
    return [p for p in parts if value_of(p) not in written and drop_partition(spark, target_table, p)]


def full_import(spark: SparkSession, source_table: str, target_table: str, log_path: str | None = None,
                table: str | None = None, depth: int | None = None, rows: str = "keep",
                legacy_format: bool | None = None, source_schema: T.StructType | None = None,
                remove_stale: bool = True, carry_schema: T.StructType | None = None, days: Days | None = None,
                wait: float = 0.0, **norm_kw) -> ImportResult:
    """Convert every partition of a JSON table into the Parquet table.

    The source is read and normalised before anything is replaced; an empty
    source changes nothing. A day whose files hold no row any more loses its
    target rows. Target partitions without a source partition are removed at
    the end (``remove_stale``), or, in a rebuild, rewritten from their own rows
    in the new schema (``carry_schema``, the schema they have). ``source_schema``
    (the raw JSON schema, as kept in the log) skips the inference pass, ``days``
    (the source's listing, just made) another listing. Runs of one table that
    share a log never overlap: another one's end is awaited for ``wait`` seconds,
    then ``TableBusy`` is raised (see ``sources.claims``).
    """
    configure(spark)
    table = table or _table_name(source_table)
    with claim(spark, log_path, table, wait):
        return _full_import(spark, source_table, target_table, log_path, table, depth, rows, legacy_format,
                            source_schema, remove_stale, carry_schema, days, **norm_kw)


def _full_import(spark, source_table, target_table, log_path, table, depth, rows, legacy_format, source_schema,
                 remove_stale, carry_schema, days, **norm_kw) -> ImportResult:
    days = days if days is not None else list_days(spark, source_table)
    listings = days.listings
    parts = sorted(listings)
    if not parts:
        return ImportResult(table, "none")
    src = _read_source(spark, source_table, parts, None if source_schema is None else readable(source_schema))
    if not [c for c in src.columns if c != PARTITION_COL]:
        return ImportResult(table, "none")
    opts = _options(depth, rows, **norm_kw)
    watched = Watched(src)
    norm = normalize(watched.frame, options=opts)
    stale = [p for p in partition_names(spark, target_table) if p not in listings]
    if carry_schema is not None and stale:
        kept = read_table(spark, target_table, schema=_with_day(carry_schema)).filter(
            F.col(PARTITION_COL).isin([value_of(p) for p in stale]))
        both = _with_day(normalized_schema(unify_schemas(carry_schema, _data_schema(norm.schema)), opts))
        norm = align(norm, both).unionByName(align(kept, both))
    run_id = wl.new_run_id()
    if log_path:
        wl.mark_started(spark, log_path, table, parts, run_id)
    renew(spark, log_path, table)
    written = write_partitions(norm, target_table, legacy_format=legacy_format)
    renew(spark, log_path, table)
    emptied = _drop_emptied(spark, target_table, parts, written)
    dropped = [p for p in stale if remove_stale and drop_partition(spark, target_table, p)]
    schema = _data_schema(norm.schema)
    if log_path:
        wl.remove_partitions(spark, log_path, table, dropped)
        wl.mark_done(spark, log_path, table, parts, parts[-1], run_id, schema, watched.source_schema(), listings, days.times)
    return ImportResult(table, "full", parts, schema, dropped, emptied)


def table_schema(spark: SparkSession, target_table: str, log_path: str | None, table: str) -> T.StructType:
    """Stored schema of a converted table (log), else the Parquet footer's."""
    if log_path:
        s = wl.stored_schema(wl.read_log(spark, log_path, table), table)
        if s is not None:
            return s
    return _data_schema(read_table(spark, target_table).schema)


def read_converted(spark: SparkSession, target_table: str, log_path: str | None = None,
                   table: str | None = None) -> DataFrame:
    """Read a converted table with its full schema (columns added by later
    runs are visible although old files lack them)."""
    table = table or _table_name(target_table)
    schema = table_schema(spark, target_table, log_path, table)
    full = T.StructType(list(schema.fields) + [T.StructField(PARTITION_COL, T.StringType())])
    return read_table(spark, target_table, schema=full)


def incremental_import(spark: SparkSession, source_table: str, target_table: str, log_path: str,
                       table: str | None = None, depth: int | None = None, rows: str = "keep",
                       new_rule: str = "set", numeric_widening: bool = False, strict: str = "symmetric",
                       legacy_format: bool | None = None, look_back: int | None = LOOK_BACK, wait: float = 0.0,
                       **norm_kw) -> ImportResult:
    """Convert the partitions that are new, left open by a run that broke off,
    or changed in their files since (plus the newest converted one).

    Old days whose folder has not changed since they were listed are not listed
    again, but for the ``look_back`` newest; ``look_back=None`` lists every file
    of every day (see :func:`list_days`).

    Falls back to :func:`full_import` when nothing was converted yet, or when
    the new data changes the table schema in a way old partitions cannot be
    read with (``needs_recalc`` of the stored and the unified schema). ``wait`` as
    in :func:`full_import`.
    """
    configure(spark)
    table = table or _table_name(source_table)
    with claim(spark, log_path, table, wait):
        return _incremental_import(spark, source_table, target_table, log_path, table, depth, rows, new_rule,
                                   numeric_widening, strict, legacy_format, look_back, **norm_kw)


def _incremental_import(spark, source_table, target_table, log_path, table, depth, rows, new_rule, numeric_widening,
                        strict, legacy_format, look_back, **norm_kw) -> ImportResult:
    status = wl.table_status(spark, log_path, table)
    days = list_days(spark, source_table, None, status.listings, status.times, look_back)
    listings = days.listings
    if not listings:
        return ImportResult(table, "none")
    if not status.done or not fs.exists(spark, target_table):
        return full_import(spark, source_table, target_table, log_path, table, depth, rows,
                           legacy_format, days=days, **norm_kw)

    broken: list[str] = []
    if status.interrupted:
        names = {value_of(p): p for p in partition_names(spark, target_table)}
        health = validate_partitions(spark, target_table).filter(F.col("status") != "ok").collect()
        broken = sorted(names[r[PARTITION_COL]] for r in health if names[r[PARTITION_COL]] in status.done)
    lost = [p for p in broken if p not in listings]
    # one row per partition on either side
    source = spark.createDataFrame(sorted(listings.items()), "partition string, listing string")
    done = spark.createDataFrame([(p, status.listings.get(p)) for p in status.done if p not in broken],
                                 "partition string, listing string")
    redo = [p for p in broken + status.open if p in listings]
    work = work_list(source, done).collect()
    if new_rule == "max":
        news = max(listings) != max((p for p in status.done if p not in broken), default=None)
    else:
        news = any(r.is_new for r in work)
    if not redo and not news:
        return ImportResult(table, "none", broken=lost)
    todo = sorted({r.partition for r in work if r.redo} | set(redo))
    res = import_partitions(spark, source_table, target_table, log_path, table, todo, status, depth=depth,
                            rows=rows, numeric_widening=numeric_widening, strict=strict,
                            legacy_format=legacy_format, days=days, **norm_kw)
    res.dropped = sorted({*res.dropped, *(p for p in broken if p in listings)})
    res.broken = lost
    return res


def import_partitions(spark: SparkSession, source_table: str, target_table: str, log_path: str, table: str,
                      todo: list[str], status: wl.TableStatus | None = None, depth: int | None = None,
                      rows: str = "keep", numeric_widening: bool = False, strict: str = "symmetric",
                      legacy_format: bool | None = None, days: Days | None = None, wait: float = 0.0,
                      **norm_kw) -> ImportResult:
    """Convert exactly the partitions ``todo``.

    Infer over ``todo`` only and unify with the stored source schema; read
    ``todo`` with that, so that a value gets the text and type a full import
    would give it. Then either align and overwrite those partitions, or - if
    the unified schema breaks old partitions - rebuild the whole table with the
    unified source schema, which covers every file converted or to be converted.
    """
    with claim(spark, log_path, table, wait):
        return _import_partitions(spark, source_table, target_table, log_path, table, todo, status, depth, rows,
                                  numeric_widening, strict, legacy_format, days, **norm_kw)


def _import_partitions(spark, source_table, target_table, log_path, table, todo, status, depth, rows, numeric_widening,
                       strict, legacy_format, days, **norm_kw) -> ImportResult:
    status = status or wl.table_status(spark, log_path, table)
    days = days if days is not None else list_days(spark, source_table, todo)
    opts = _options(depth, rows, **norm_kw)
    raw = _read_source(spark, source_table, todo)   # inference over ``todo`` only
    source_schema = _data_schema(raw.schema)
    known = status.source_schema
    if known is not None:
        if may_be_void(known, source_schema):       # a string, or no value at all in these days?
            paths = [f"{source_table.rstrip('/')}/{p}" for p in todo]
            source_schema = void_where_missing(source_schema, infer_json_schema(spark, paths, with_values=True))
        source_schema = unify_schemas(known, source_schema)
        raw = read_json_table(spark, source_table, partitions=todo, schema=readable(source_schema))
    watched = Watched(raw)
    new = normalize(watched.frame, options=opts)
    unified = _data_schema(new.schema)
    if fs.exists(spark, target_table):
        old_schema = status.table_schema or _data_schema(read_table(spark, target_table).schema)
        unified = normalized_schema(unify_schemas(old_schema, unified), opts)
        resolved = known is not None and void_resolved(known, source_schema)
        if resolved or needs_recalc(old_schema, unified, numeric_widening=numeric_widening, strict=strict):
            res = full_import(spark, source_table, target_table, log_path, table, depth, rows, legacy_format,
                              source_schema=source_schema, remove_stale=False, carry_schema=old_schema, **norm_kw)
            res.mode = "rebuild"
            return res

    run_id = wl.new_run_id()
    wl.mark_started(spark, log_path, table, todo, run_id)
    renew(spark, log_path, table)
    written = write_partitions(align(new, _with_day(unified)), target_table, legacy_format=legacy_format)
    renew(spark, log_path, table)
    emptied = _drop_emptied(spark, target_table, todo, written)
    seen = watched.source_schema()
    if known is not None:           # what these days leave open, others may have settled
        seen = unify_schemas(known, seen)
    wl.mark_done(spark, log_path, table, todo, todo[-1], run_id, unified, seen, days.listings, days.times)
    return ImportResult(table, "incremental", todo, unified, emptied=emptied)


def convert_database(spark: SparkSession, source_root: str, target_root: str, log_path: str,
                     tables: list[str] | None = None, parallel: int = 1, **kw) -> list[ImportResult]:
    """Incremental import of every table folder below ``source_root``.

    ``parallel > 1`` submits that many table imports at a time from driver
    threads, as concurrent Spark jobs: a database of many small tables then
    keeps a large cluster busy instead of running one small job after
    another. Tables share nothing but the log, whose folders are per table.
    Results are in table order; the first failure is raised.
    """
    configure(spark)
    if parallel > 1 and kw.get("legacy_format") is not None:
        raise ValueError("legacy_format is a session setting: not with parallel > 1")
    names = tables if tables is not None else fs.list_dirs(spark, source_root)
    wl.init_log(spark, log_path)   # before any thread: the seed row is written once

    def one(name: str) -> ImportResult:
        return incremental_import(spark, f"{source_root.rstrip('/')}/{name}", f"{target_root.rstrip('/')}/{name}",
                                  log_path, table=name, **kw)

    if parallel <= 1 or len(names) <= 1:
        return [one(n) for n in names]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, names))
