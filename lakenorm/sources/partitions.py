"""Partition listing, file inventory, work list, removal and health check.

Listing uses Spark's own file index through the ``binaryFile`` source with
only metadata columns selected (``path``, ``length``, ``modificationTime``
and the discovered ``dt``), so no file content is read and listing is done
by Spark (in parallel for large trees) rather than one storage page at a time.
What an import needs to know about its source is kept in the work log, a row per
day, and only days whose folder may have changed are listed again
(:func:`list_days`).
"""

from __future__ import annotations

import re
import time
from collections import Counter
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quote
from ..session import configure
from . import fs

PARTITION_COL = "dt"
# Regex for the directory that holds a file (fixed pattern): the last
# directory name before the file name.
PARENT_DIR_PATTERN = r".*/([^/]+)/[^/]+$"
# Folder value of null (fixed by the file format).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_name(value: str, partition_col: str = PARTITION_COL) -> str:
    return value if "=" in value else f"{partition_col}={value}"


def file_inventory(spark: SparkSession, table_path: str) -> DataFrame:
    """One row per data file: ``path, dt, length, modificationTime``."""
    configure(spark)
    return (spark.read.format("binaryFile").load(table_path)
            .select("path", PARTITION_COL, "length", "modificationTime"))


def file_path(uri: Column | None = None) -> Column:
    """Path of the file a row was read from, in the plain form of Hadoop paths
    and of the ``binaryFile`` source's ``path``.

    ``_metadata.file_path`` is a URI: a space is ``%20``, a ``%`` is ``%25``
    (so an escaped partition value ``a%3Ab`` appears as ``a%253Ab``). Decoding
    the escapes gives the plain path; ``+`` is literal in a URI, so it is
    protected from ``url_decode``'s form decoding first.
    """
    uri = F.col("_metadata.file_path") if uri is None else uri
    return F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def partition_from_path(df: DataFrame, out: str = "partition") -> DataFrame:
    """Add the name of the directory holding each row's file (S13), as it is
    named in storage."""
    return df.withColumn(out, F.regexp_extract(file_path(), PARENT_DIR_PATTERN, 1))


def list_partitions(spark: SparkSession, table_path: str) -> DataFrame:
    """Partition directory names (``dt=YYYYMMDD``) holding files, as they are
    named in storage (S8): one directory level, and per directory a listing
    that stops at its first file. No file index is built."""
    names = non_empty_partitions(spark, table_path, partition_names(spark, table_path))
    return spark.createDataFrame([(n,) for n in names], "partition string")


def partition_files(spark: SparkSession, table_path: str, names: list[str] | None = None) -> DataFrame:
    """``partition, listing`` of every partition (or of ``names``) that holds files: ``listing``
    sums up its files (number, bytes, newest modification time), so a late or
    replaced file shows as a different value. Listed by Spark; folder names are
    taken from the path, never decoded. A table without files gives no rows."""
    configure(spark)
    root = fs.qualified(spark, table_path).rstrip("/")
    paths = table_path if names is None else [f"{table_path.rstrip('/')}/{n}" for n in names]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
             .select(F.split(F.col("path").substr(len(root) + 2, 1 << 30), "/")[0].alias("partition"), "length", "modificationTime"))
    newest = F.unix_micros(F.max("modificationTime"))
    return (files.where(F.col("partition").startswith(f"{PARTITION_COL}=")).groupBy("partition")
            .agg(F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), newest).alias("listing")))


# Listing of a partition whose files hold no byte.
NO_BYTES = "0:0:0"
# Days whose files are listed at a time: the driver's file index is never larger.
LIST_CHUNK = 64
# Newest days that are always listed, whatever their folder's time.
LOOK_BACK = 3
# A folder time vouches for a listing made at least this much later (ms): clocks
# of storage and driver may differ by that, and times may be coarse.
SETTLED_MS = 10_000


@dataclass
class Days:
    """The source days that hold files, a row per day."""
    listings: dict[str, str] = field(default_factory=dict)
    times: dict[str, str | None] = field(default_factory=dict)     # None: the folder's time does not vouch for its files
    listed: list[str] = field(default_factory=list)                # days whose files were looked at


def list_days(spark: SparkSession, table_path: str, names: list[str] | None = None, known: dict[str, str] | None = None,
              known_times: dict[str, str] | None = None, look_back: int | None = LOOK_BACK) -> Days:
    """Files of the source days (all, or ``names``), summed up per day.

    The table's folder is listed once, which gives every day's modification
    time. A day keeps its ``known`` listing when that time is the known one: a
    file that is added, removed or replaced by a new one changes the time of
    its folder. All others are listed by Spark, ``LIST_CHUNK`` days at a time and
    reduced to a row per day, so neither an index of the whole tree nor a list
    of files is ever on the driver.

    Listed in any case: days without a known time, the ``look_back`` newest, and
    all of them with ``look_back=None`` - the exact listing, which also sees a
    file of an old day that was overwritten in place, the one change that leaves
    a folder's time as it is. A time is only kept where it can vouch for the
    files: the folder has been at rest for ``SETTLED_MS``, holds no folders, and
    the storage has folder times at all.
    """
    known, known_times = known or {}, known_times or {}
    now = int(time.time() * 1000)
    times = fs.dir_times(spark, table_path)
    wanted = None if names is None else set(names)
    days = sorted(d for d in times if d.startswith(f"{PARTITION_COL}=") and (wanted is None or d in wanted))
    newest = set(days if look_back is None else days[len(days) - look_back:] if look_back else [])
    trusted = [d for d in days if d in known and d not in newest and known_times.get(d) == str(times[d])]
    out = Days({d: known[d] for d in trusted}, {d: known_times[d] for d in trusted})
    rest = [d for d in days if d not in out.listings]
    root = table_path.rstrip("/")
    for i in range(0, len(rest), LIST_CHUNK):
        chunk = rest[i:i + LIST_CHUNK]
        found = {r.partition: r.listing for r in partition_files(spark, table_path, chunk).collect()}
        # Spark's listing leaves files of no bytes out: a folder that holds nothing else counts as emptied
        found |= dict.fromkeys(non_empty_partitions(spark, table_path, [d for d in chunk if d not in found]), NO_BYTES)
        for d in found:
            at_rest = 0 < times[d] <= now - SETTLED_MS and not fs.has_subfolders(spark, f"{root}/{d}")
            out.times[d] = str(times[d]) if at_rest else None
        out.listings |= found
        out.listed += chunk
    return out


def partition_names(spark: SparkSession, table_path: str, partition_col: str = PARTITION_COL) -> list[str]:
    """Partition directory names (``dt=...``) on the driver (metadata only, one
    per day). Other folders are not partitions: they are never read, listed
    as work or removed as stale."""
    return [d for d in fs.list_dirs(spark, table_path) if d.startswith(f"{partition_col}=")]


def non_empty_partitions(spark: SparkSession, table_path: str, names: list[str]) -> list[str]:
    """The partitions among ``names`` whose folder holds at least one file.

    A folder without files (created before its data was uploaded) is not a
    partition yet: it must neither be read nor be marked as converted. One
    lazy listing per folder, for any number of folders.
    """
    return [n for n in names if fs.has_files(spark, f"{table_path.rstrip('/')}/{n}")]


def max_partition(spark: SparkSession, table_path: str) -> DataFrame:
    """Newest partition name of a table (A8): folders are looked into from the
    newest on, until one holds a file."""
    names = reversed(partition_names(spark, table_path))
    newest = next((n for n in names if fs.has_files(spark, f"{table_path.rstrip('/')}/{n}")), None)
    return spark.createDataFrame([(newest,)], "max_partition string")


def value_of(name: str) -> str | None:
    """The value of a partition folder name: ``%XX`` escapes decoded, null for
    the folder of null values."""
    raw = name.split("=", 1)[1]
    if raw == NULL_PARTITION:
        return None
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), raw)


def latest_file_date(spark: SparkSession, table_path: str) -> DataFrame:
    """``yyyy-MM-dd`` of the newest file modification below a path."""
    inv = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_path)
    return inv.agg(F.date_format(F.max("modificationTime"), "yyyy-MM-dd").alias("latest_file_date"))


def partition_counts(df: DataFrame, partition_col: str = PARTITION_COL) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"))


def work_list(source: DataFrame, done: DataFrame) -> DataFrame:
    """Every source partition with ``is_new`` (never converted, or its files have
    changed since; a log without listings settles by name alone) and ``redo``
    (new, or the newest converted one and what follows it).

    Both frames hold a column ``partition``, and ``listing`` where files are to
    be compared; ``done`` has a row per partition.
    """
    newest = done.agg(F.max("partition")).scalar()
    compare = "listing" in source.columns and "listing" in done.columns
    d = done.select(F.col("partition").alias("_p"), *([F.col("listing").alias("_l")] if compare else []))
    settled = F.col("_p").isNotNull()
    if compare:
        settled = settled & (F.col("_l").isNull() | (F.col("_l") == F.col("listing")))
    settled = F.coalesce(settled, F.lit(False))
    return (source.join(d, F.col("partition") == F.col("_p"), "left").withColumn("is_new", ~settled)
            .withColumn("redo", F.col("is_new") | F.coalesce(F.col("partition") >= newest, F.lit(True)))
            .select(*source.columns, "is_new", "redo"))


def partitions_to_recalc(source: DataFrame, done: DataFrame) -> DataFrame:
    """Source partitions still to convert (F6): see :func:`work_list`."""
    return work_list(source, done).where("redo").select(*source.columns)


def drop_partition(spark: SparkSession, table_path: str, partition: str) -> bool:
    """Delete exactly one partition directory."""
    return fs.delete_dir(spark, f"{table_path.rstrip('/')}/{partition_name(partition)}")


def footer_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """``dt, rows`` from the footers alone: the count is pushed into the Parquet
    scan, whose tasks open the footers; no row is made. Partitions without rows
    are missing; a file that is not Parquet fails the query. The frame belongs
    to a session of its own, with the settings this takes."""
    own = configure(spark.newSession())
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")     # Parquet through the V2 reader
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    only_day = T.StructType([T.StructField(PARTITION_COL, T.StringType())])
    return own.read.schema(only_day).parquet(table_path).groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("rows"))


# Files up to this size are looked into by tasks (a file without rows is a few
# kilobytes); footers of larger ones that give no rows are read one at a time.
WHOLE = 16 << 20
SILENT_CHUNK = 1000


def broken_files(spark: SparkSession, silent: DataFrame) -> Counter:
    """Number of broken files per partition among ``silent(path, dt, length)``, the
    files that gave no rows: a valid file without rows is not broken. Tasks read
    the footers of files up to ``WHOLE``, a chunk of paths at a time."""
    def footers(it):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for b in it:
            bad = []
            for raw in b.column("content"):
                try:
                    bad.append(pq.read_metadata(pa.BufferReader(raw.as_buffer())) is None)
                except (pa.ArrowInvalid, OSError):      # OSError: bytes that break the footer's encoding
                    bad.append(True)
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(bad)], ["path", "bad"])

    found: Counter = Counter()
    chunk: dict[str, str | None] = {}

    def look():
        paths = list(chunk)
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "content")
        bad = content.mapInArrow(footers, "path string, bad boolean").where("bad").select("path").collect()
        plain = {_plain(p): day for p, day in chunk.items()}
        found.update(plain[_plain(r.path)] for r in bad)
        chunk.clear()

    for r in silent.toLocalIterator():
        if r.length > WHOLE or r.length == 0:
            if fs.parquet_rows(spark, r.path) is None:
                found[r[PARTITION_COL]] += 1
            continue
        chunk[r.path] = r[PARTITION_COL]
        if len(chunk) == SILENT_CHUNK:
            look()
    if chunk:
        look()
    return found


def _plain(path: str) -> str:
    """One form of a path: the scheme's empty authority may be written or not."""
    return re.sub(r"^(\w+:)/+", r"\1/", path)


def validate_partitions(spark: SparkSession, table_path: str, deep: bool = False,
                        schema: T.StructType | None = None) -> DataFrame:
    """Health of every partition of a Parquet table: ``dt, status`` with
    status ``ok``, ``empty`` (readable, no rows) or ``unreadable``.

    Rows per partition come from the footers, read by tasks without making a
    row (:func:`footer_counts`). Only where that meets a file it cannot read,
    rows are counted per file by a scan without data columns, and files that
    yield none are told apart by their footers (:func:`broken_files`): a valid
    file without rows, a broken one, or a storage that fails - which is raised,
    since it says nothing about the file.

    ``deep=True`` also reads every value (with ``schema``, or the schema merged
    from all readable footers): a file whose pages cannot all be read yields
    fewer rows than its footer promises, which marks it unreadable; the hash
    over all columns is returned as ``checksum`` (XOR per partition), so the
    full read is not pruned away.
    """
    configure(spark)
    uri = F.col("_metadata.file_path").alias("uri")
    inv = spark.read.format("binaryFile").load(table_path).select(uri, PARTITION_COL, "length")
    if not deep:
        try:
            counts = [(r[0], r[1]) for r in footer_counts(spark, table_path).collect()]      # a row per day
        except (Py4JJavaError, PySparkException) as e:
            if "FAILED_READ_FILE" not in str(e):
                raise
        else:
            rows = spark.createDataFrame(counts, "_day string, rows long")
            status = F.when(F.coalesce("rows", F.lit(0)) > 0, "ok").otherwise("empty").alias("status")
            return (inv.select(PARTITION_COL).distinct()
                    .join(rows, F.col(PARTITION_COL).eqNullSafe(F.col("_day")), "left").select(PARTITION_COL, status))
    reader = lambda: spark.read.option("ignoreCorruptFiles", "true")
    counted = (reader().schema(T.StructType([T.StructField(PARTITION_COL, T.StringType())])).parquet(table_path)
               .select(uri).groupBy("uri").agg(F.count(F.lit(1)).alias("rows")))
    extra = []
    if deep:
        if schema is None:
            try:
                schema = reader().option("mergeSchema", "true").parquet(table_path).schema
            except AnalysisException as e:
                if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                    raise
                schema = T.StructType([])           # not one readable footer
        names = [f.name for f in schema.fields if f.name != PARTITION_COL]
        data = reader().schema(T.StructType([*[schema[n] for n in names], T.StructField(PARTITION_COL, T.StringType())])).parquet(table_path)
        values = (data.select(uri, F.xxhash64(F.lit(0), *[F.col(quote(c)) for c in data.columns]).alias("h"))
                  .groupBy("uri").agg(F.count(F.lit(1)).alias("rows_read"), F.bit_xor("h").alias("h")))
        counted = counted.join(values, "uri", "left")
        extra = ["rows_read", "h"]
    per_file = inv.join(counted, "uri", "left").select("uri", PARTITION_COL, "length", "rows", *extra)
    silent = (per_file.filter(F.col("rows").isNull())
              .select(file_path(F.col("uri")).alias("path"), PARTITION_COL, "length"))
    broken = broken_files(spark, silent)
    aggs = [F.sum(F.coalesce(F.col("rows"), F.lit(0))).alias("rows")]
    if deep:
        short = F.col("rows").isNotNull() & (F.coalesce(F.col("rows_read"), F.lit(0)) != F.col("rows"))
        aggs += [F.count(F.when(short, 1)).alias("short"), F.bit_xor("h").alias("checksum")]
    days = per_file.groupBy(PARTITION_COL).agg(*aggs)
    bad = spark.createDataFrame(sorted(broken.items(), key=str), "_day string, broken long")
    days = days.join(bad, F.col(PARTITION_COL).eqNullSafe(F.col("_day")), "left")
    unreadable = F.coalesce(F.col("broken"), F.lit(0)) > 0
    if deep:
        unreadable = unreadable | (F.col("short") > 0)
    status = F.when(unreadable, "unreadable").when(F.col("rows") == 0, "empty").otherwise("ok").alias("status")
    return days.select(PARTITION_COL, status, *(["checksum"] if deep else []))
