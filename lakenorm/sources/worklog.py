"""Append-only work log of converted partitions.

The log is a small Parquet table. The reference's four columns come first
(``date, table, partition, maxPartition``); ``run_id`` names the run,
``status`` is ``started`` / ``done`` / ``removed`` / ``seed`` and ``written_at``
orders rows. A run appends a ``started`` row per planned partition before it
writes any data and a ``done`` row after; a partition whose newest row is
``started`` belongs to a run that broke off, and is redone first. ``listing`` of
a ``done`` row sums up the source files that were converted, so late and
replaced files are noticed; ``folder_time`` is the folder's modification time
before that listing, where it vouches for the files (see ``partitions.list_days``).
Nothing is ever rewritten: removing a table or a partition appends
``removed`` rows, so an aborted run cannot lose the log. The current state of
a key is its newest row (``max_by`` over ``written_at``). ``table_schema``
holds the target table's schema and ``source_schema`` the union of the
inferred JSON schemas of all converted partitions (so that a rebuild reads old
partitions with an explicit schema instead of inferring over them again).

Layout: the log is partitioned by ``table`` (``<log>/table=<name>/``), so the
status of one table lists and reads only that table's folder, however many
tables a database holds. Every append adds a file; :func:`compact_log`, an
explicit call, writes one copy of a table's rows and then deletes exactly the old
files, at once or, for readers at work, after a time of grace. Every reader takes the newest row per
key or a maximum, so a crash between the two steps (rows present twice) does
not change any answer, and the next compaction removes the copies.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import json
import re
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure
from . import fs

LOG_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("maxPartition", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("written_at", T.StringType()),
    T.StructField("table_schema", T.StringType()),
    T.StructField("source_schema", T.StringType()),
    T.StructField("listing", T.StringType()),
    T.StructField("folder_time", T.StringType()),
])
# Seed row of a new log (fixed values): date, table, partition, maxPartition.
SEED_ROW = ("0001-01-01", "example", "00010101", "00010101")
LOG_PARTITION = "table"
# Table names that appear unescaped in a partition folder name; other names
# are found through a partition filter over the whole log instead.
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_.\-]*")

_counter = itertools.count()


def now_stamp() -> str:
    """Sortable, strictly increasing (within the process) write stamp."""
    t = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{t}-{next(_counter):08d}"


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def today() -> str:
    return _dt.date.today().strftime("%Y-%m-%d")


def _frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Log rows (tuples in ``LOG_SCHEMA`` order) as a frame. They travel to the
    JVM as one Arrow table instead of pickled Python rows, which halves the
    cost of a log append."""
    import pyarrow as pa
    names = LOG_SCHEMA.fieldNames()
    columns = list(zip(*[r + (None,) * (len(names) - len(r)) for r in rows]))
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns)}), LOG_SCHEMA)


def _write(df: DataFrame, log_path: str) -> None:
    df.write.mode("append").partitionBy(LOG_PARTITION).parquet(log_path)


def _write_table(df: DataFrame, log_path: str, table: str) -> None:
    """Append one table's rows. A plain name is written straight into its
    folder (the folder name supplies ``table``), so imports of different
    tables running at the same time never share a job's staging folder."""
    folder = _table_dir(log_path, table)
    if folder is None:
        _write(df, log_path)
    else:
        df.drop(LOG_PARTITION).write.mode("append").parquet(folder)


def _table_dir(log_path: str, table: str) -> str | None:
    """Folder of one table's log rows, when its name is written unescaped."""
    if not _PLAIN_NAME.fullmatch(table):
        return None
    return f"{log_path.rstrip('/')}/{LOG_PARTITION}={table}"


def log_exists(spark: SparkSession, log_path: str) -> bool:
    """Has the log any table yet? (Its folder may hold claims only.)"""
    return bool(fs.list_dirs(spark, log_path))


def init_log(spark: SparkSession, log_path: str) -> None:
    """Create the log with its seed row if it does not exist."""
    if log_exists(spark, log_path):
        return
    row = SEED_ROW + ("seed", "seed", now_stamp())
    _write_table(_frame(spark, [row]).coalesce(1), log_path, SEED_ROW[1])


def _read(spark: SparkSession, log_path: str, paths: list[str]) -> DataFrame:
    r = spark.read.schema(LOG_SCHEMA).option("basePath", log_path)
    return r.parquet(*paths).select(*LOG_SCHEMA.fieldNames())


def read_log(spark: SparkSession, log_path: str, table: str | None = None) -> DataFrame:
    """The log, or the rows of one table (only that table's folder is listed)."""
    configure(spark)
    empty = spark.createDataFrame([], LOG_SCHEMA)
    if not log_exists(spark, log_path):
        return empty
    if table is None:
        return _read(spark, log_path, [log_path])
    folder = _table_dir(log_path, table)
    if folder is None:
        return _read(spark, log_path, [log_path]).filter(F.col(LOG_PARTITION) == table)
    return _read(spark, log_path, [folder]) if fs.exists(spark, folder) else empty


def append_rows(spark: SparkSession, log_path: str, rows: list[tuple]) -> None:
    """Append log rows given as tuples in ``LOG_SCHEMA`` order (missing ends are
    null), one file per table."""
    if not rows:
        return
    for table in sorted({r[1] for r in rows}):
        _write_table(_frame(spark, [r for r in rows if r[1] == table]).coalesce(1), log_path, table)


def append_frame(log_path: str, df: DataFrame) -> None:
    """Append rows computed by Spark (columns of ``LOG_SCHEMA``, missing ones are null): one file per
    table, without funnelling the upstream work into one task."""
    columns = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in LOG_SCHEMA.fieldNames()]
    _write(df.select(*columns).repartition(LOG_PARTITION), log_path)


RETIRED = "_retired"            # hidden from Spark's readers


def _retired(spark: SparkSession, folder: str) -> dict[str, tuple[int, list[str]]]:
    """Lists of files that a compaction has replaced -> (its time in ms, the files' names)."""
    return {name: (written, fs.read_text(spark, f"{folder}/{RETIRED}/{name}").split("\n"))
            for name, written in fs.file_times(spark, f"{folder}/{RETIRED}").items()}


def compact_log(spark: SparkSession, log_path: str, table: str, min_files: int = 64, grace: float = 0.0) -> int:
    """Rewrite one table's log folder as a single file once it holds
    ``min_files`` files; returns the number of files replaced (0: none).

    The copy is written first and only the files read for it are deleted
    afterwards, so rows are never lost; see the module doc for a crash in
    between. With ``grace`` the replaced files stay for that many seconds, for
    readers that have listed them already: they are put on a list, and a later
    call (whether it compacts or not) deletes what has been on it long enough.
    """
    folder = _table_dir(log_path, table)
    if folder is None:
        return 0
    old: set[str] = set()
    for name, (written, files) in _retired(spark, folder).items():
        if time.time() - written / 1000 >= grace:
            for f in files:
                fs.delete_file(spark, f"{folder}/{f}")
            fs.delete_file(spark, f"{folder}/{RETIRED}/{name}")
        else:
            old.update(files)
    if fs.count_files(spark, folder) < min_files:   # cheap upper bound first
        return 0
    files = [f for f in fs.list_files(spark, folder) if f.rsplit("/", 1)[-1] not in old]
    if len(files) < min_files:
        return 0
    rows = _read(spark, log_path, files).distinct()
    _write_table(rows.coalesce(1), log_path, table)
    if grace > 0:
        fs.write_text(spark, f"{folder}/{RETIRED}/{now_stamp()}", "\n".join(f.rsplit("/", 1)[-1] for f in files))
    else:
        for f in files:
            fs.delete_file(spark, f)
    return len(files)


def mark_started(spark: SparkSession, log_path: str, table: str, partitions: list[str], run_id: str) -> None:
    """One ``started`` row per partition that a run is going to write."""
    rows = [(today(), table, p, max(partitions), run_id, "started", now_stamp()) for p in partitions]
    if not log_exists(spark, log_path):   # a new log gets its seed row in the same write
        rows.insert(0, SEED_ROW + ("seed", "seed", now_stamp()))
    append_rows(spark, log_path, rows)


def mark_done(spark: SparkSession, log_path: str, table: str, partitions: list[str], max_partition: str,
              run_id: str, table_schema: T.StructType | None = None,
              source_schema: T.StructType | None = None, listings: dict[str, str] | None = None,
              times: dict[str, str | None] | None = None) -> None:
    """One ``done`` row per partition. The schemas (JSON text that grows with
    the column count) go into the run's last row only: readers take the
    newest ``done`` row that has them, so a run of thousands of partitions
    ships them once, not once per partition."""
    schema_json = table_schema.json() if table_schema is not None else None
    source_json = source_schema.json() if source_schema is not None else None
    last = len(partitions) - 1
    rows = [(today(), table, p, max_partition, run_id, "done", now_stamp(),
             schema_json if i == last else None, source_json if i == last else None, (listings or {}).get(p),
             (times or {}).get(p))
            for i, p in enumerate(partitions)]
    if not log_exists(spark, log_path):   # a new log gets its seed row in the same write
        rows.insert(0, SEED_ROW + ("seed", "seed", now_stamp()))
    append_rows(spark, log_path, rows)


def current_state(log: DataFrame) -> DataFrame:
    """Newest row per (table, partition): ``table, partition, status, ...``."""
    newest = F.max_by(F.struct(*[F.col(c) for c in LOG_SCHEMA.fieldNames()]), F.col("written_at"))
    return (log.filter(F.col("status") != "seed")
            .groupBy("table", "partition").agg(newest.alias("r"))
            .select("r.*"))


def done_partitions(log: DataFrame, table: str | None = None) -> DataFrame:
    """``table, partition`` pairs whose newest row is ``done``."""
    return done_listings(log, table).select("table", "partition")


def done_listings(log: DataFrame, table: str | None = None) -> DataFrame:
    """As :func:`done_partitions`, with the ``listing`` of the converted files."""
    st = current_state(log).filter(F.col("status") == "done")
    if table is not None:
        st = st.filter(F.col("table") == table)
    return st.select("table", "partition", "listing")


def max_done_partition(log: DataFrame, table: str) -> DataFrame:
    """Newest converted partition of a table (A4)."""
    return done_partitions(log, table).agg(F.max("partition").alias("max_done_partition"))


def stored_schema(log: DataFrame, table: str, column: str = "table_schema") -> T.StructType | None:
    """Schema recorded by the newest ``done`` row of a table (``table_schema``
    or ``source_schema``)."""
    rows = (log.filter((F.col("table") == table) & (F.col("status") == "done") & F.col(column).isNotNull())
            .agg(F.max_by(column, "written_at").alias("s")).collect())
    if not rows or rows[0]["s"] is None:
        return None
    return T.StructType.fromJson(json.loads(rows[0]["s"]))


def remove_partition(spark: SparkSession, log_path: str, table: str, partition: str) -> None:
    """Forget one converted partition of a table."""
    remove_partitions(spark, log_path, table, [partition])


def remove_partitions(spark: SparkSession, log_path: str, table: str, partitions: list[str]) -> None:
    """Forget some converted partitions of a table, in one append."""
    stamp = now_stamp()
    append_rows(spark, log_path, [(today(), table, p, None, "remove", "removed", stamp) for p in partitions])


def remove_table(spark: SparkSession, log_path: str, table: str) -> None:
    """Forget every converted partition of a table (O5), one ``removed`` row each.

    The log holds one row per partition and run, so the names fit the driver;
    they are collected before the append so that the job never reads files it
    is writing.
    """
    parts = [r.partition for r in done_partitions(read_log(spark, log_path, table), table).collect()]
    remove_partitions(spark, log_path, table, parts)


def latest_run(log: DataFrame) -> DataFrame:
    """``done`` rows of the newest run of every table (J3: join with own max)."""
    done = log.filter(F.col("status") == "done")
    newest = done.groupBy("table").agg(F.max("run_id").alias("run_id"))
    # distinct: rows present twice after an interrupted compaction count once
    return done.join(newest, ["table", "run_id"], "inner").distinct()


def run_summary(log: DataFrame) -> DataFrame:
    """Per table: newest run, last finished partition, its planned maximum,
    and whether the run was interrupted (A5, O4): its last partition is not the
    planned one, or one that it started has no end."""
    runs = log.filter(F.col("status").isin("started", "done"))
    newest = runs.groupBy("table").agg(F.max("run_id").alias("run_id"))
    finished = F.when(F.col("status") == "done", F.col("partition"))
    planned = F.when(F.col("status") == "started", F.col("partition"))
    return (runs.join(newest, ["table", "run_id"]).groupBy("table", "run_id")
            .agg(F.max(finished).alias("last_finished"), F.max("maxPartition").alias("max_partition"),
                 F.count_distinct(finished).alias("_done"), F.count_distinct(planned).alias("_planned"))
            .withColumn("interrupted", ~F.col("last_finished").eqNullSafe(F.col("max_partition")) | (F.col("_planned") > F.col("_done")))
            .drop("_done", "_planned"))


def was_interrupted(spark: SparkSession, log_path: str, table: str) -> bool:
    """True when the newest run of ``table`` did not reach its planned last
    partition; no rows at all count as interrupted (R28)."""
    rows = run_summary(read_log(spark, log_path, table)).collect()
    return not rows or bool(rows[0]["interrupted"])


def has_new_partitions(log: DataFrame, source_partitions: DataFrame, table: str, rule: str = "set") -> bool:
    """Are there source partitions to convert (O3)?

    ``rule="max"``: the reference test, newest done != newest in the source.
    ``rule="set"`` (default): some source partition is not done, so a
    back-filled older day is noticed as well (R14); where the source carries
    ``listing``, also one whose files differ from those converted.
    """
    return not unsettled(source_partitions, done_listings(log, table), rule).isEmpty()


def unsettled(source: DataFrame, done: DataFrame, rule: str = "set", keys: tuple[str, ...] = ()) -> DataFrame:
    """The source partitions that make a run necessary, per key of ``done``
    (``keys``, which ``source`` then has too)."""
    if rule == "max":
        s = source.groupBy(*keys).agg(F.max("partition").alias("partition"))
        d = done.groupBy(*keys).agg(F.max("partition").alias("_p"))
        same = F.col("partition") == F.col("_p")
    else:
        s, d = source, done.withColumnRenamed("partition", "_p")
        same = F.col("partition") == F.col("_p")
        if "listing" in source.columns:
            d = d.withColumnRenamed("listing", "_l")
            same = same & (F.col("_l").isNull() | (F.col("_l") == F.col("listing")))
    for k in keys:
        d = d.withColumnRenamed(k, f"_{k}")
        same = same & (F.col(k) == F.col(f"_{k}"))
    return s.join(d, same, "left_anti")


@dataclass
class TableStatus:
    done: list[str]                      # partitions whose newest row is ``done``
    interrupted: bool                    # a run broke off: see ``open``, or it missed its planned last partition
    table_schema: T.StructType | None
    source_schema: T.StructType | None
    open: list[str] = field(default_factory=list)        # started, never finished
    listings: dict[str, str] = field(default_factory=dict)
    times: dict[str, str] = field(default_factory=dict)  # folder times that vouch for the listings


def _schema(text: str | None) -> T.StructType | None:
    return T.StructType.fromJson(json.loads(text)) if text else None


def table_status(spark: SparkSession, log_path: str, table: str) -> TableStatus:
    """Everything a run needs from the log, in one job over the table's rows.

    Level 1 (per partition): newest status, newest run that finished it and
    that run's planned maximum, newest recorded schemas. Level 2 (whole
    table): the done list (one name per day, so it fits the driver), the
    newest run's last finished partition versus its plan, the newest schemas.
    """
    rows = read_log(spark, log_path, table).filter(F.col("status") != "seed")
    is_done = F.col("status") == "done"
    ts_of = lambda c: F.when(is_done & F.col(c).isNotNull(), F.col("written_at"))
    per_part = rows.groupBy("partition").agg(
        F.max_by("status", "written_at").alias("status"),
        F.max(F.when(is_done, F.col("run_id"))).alias("run"),
        F.max_by("maxPartition", F.when(is_done, F.struct("run_id", "written_at"))).alias("planned"),
        F.max(ts_of("table_schema")).alias("ts_t"),
        F.max_by("table_schema", ts_of("table_schema")).alias("table_schema"),
        F.max(ts_of("source_schema")).alias("ts_s"),
        F.max_by("source_schema", ts_of("source_schema")).alias("source_schema"),
        F.max_by(F.struct("listing", "folder_time"), F.when(is_done, F.col("written_at"))).alias("files"),
    )
    newest_run = F.struct("run", "partition")
    summary = per_part.agg(
        F.sort_array(F.collect_list(F.when(F.col("status") == "done", F.struct("partition", "files.listing", "files.folder_time")))).alias("done"),
        F.sort_array(F.collect_list(F.when(F.col("status") == "started", F.col("partition")))).alias("open"),
        F.max_by("partition", F.when(F.col("run").isNotNull(), newest_run)).alias("last_finished"),
        F.max_by("planned", F.when(F.col("run").isNotNull(), F.struct("run", "planned"))).alias("planned"),
        F.max_by("table_schema", "ts_t").alias("table_schema"),
        F.max_by("source_schema", "ts_s").alias("source_schema"),
    ).collect()[0]
    interrupted = (summary["last_finished"] is None or summary["last_finished"] != summary["planned"]
                   or bool(summary["open"]))
    done = list(summary["done"] or [])
    return TableStatus([r.partition for r in done], interrupted, _schema(summary["table_schema"]),
                       _schema(summary["source_schema"]), list(summary["open"] or []),
                       {r.partition: r.listing for r in done if r.listing is not None},
                       {r.partition: r.folder_time for r in done if r.folder_time is not None})
