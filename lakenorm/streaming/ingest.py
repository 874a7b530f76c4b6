"""Incremental import as a Structured Streaming job (the log as a checkpoint).

The stream only detects change: a ``binaryFile`` file stream over the JSON
table with just ``path`` and ``dt`` selected (file contents are not read),
so the checkpoint records which files were seen - including files that
arrive late in an old ``dt`` partition, which a "newest partition" rule
misses. Each micro-batch names the touched partitions; ``foreachBatch``
converts exactly those partitions in one batch job (``import_partitions``:
inference over them only, normalise, unify, dynamic overwrite, or a rebuild
when the schema change requires it). Touched partitions are re-read whole,
because duplicates are removed per partition and a late file may repeat
rows of earlier files. A replayed batch rewrites the same partitions from
the same files, so the sink is idempotent.

``trigger(availableNow=True)`` processes what is there and stops, which
matches a daily job; any other trigger keeps the conversion running.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.convert import ImportResult, import_partitions
from ..session import configure
from ..sources import fs
from ..sources import worklog as wl
from ..sources.json_source import PARTITION_COL
from ..sources.partitions import list_days

_FILE_SCHEMA = ("path string not null, modificationTime timestamp not null, length bigint not null, "
                f"content binary, {PARTITION_COL} string")


def changed_partitions(spark: SparkSession, source_table: str, max_files_per_trigger: int | None = None
                       ) -> DataFrame:
    """Streaming frame of ``(path, dt)`` for every new file of the table."""
    configure(spark)
    r = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_table).select("path", PARTITION_COL)


KEEP_RESULTS = 1000


def stream_import(spark: SparkSession, source_table: str, target_table: str, log_path: str, checkpoint: str,
                  table: str | None = None, trigger: dict | None = None, max_files_per_trigger: int | None = None,
                  **import_kw) -> list[ImportResult]:
    """Run the streaming conversion until the available files are converted
    (or forever with a processing-time ``trigger``); returns the results of the
    micro-batches that converted data, the last ``KEEP_RESULTS`` at most.

    A batch converts the days it touches, the first batch like any other. A day
    is converted whole, so the files of it that later batches name are already
    in: a day whose files are those logged is skipped.
    """
    configure(spark)
    table = table or source_table.rstrip("/").rsplit("/", 1)[-1]
    results: deque[ImportResult] = deque(maxlen=KEEP_RESULTS)

    def convert_batch(batch: DataFrame, batch_id: int) -> None:
        root = fs.qualified(spark, source_table).rstrip("/")
        folder = F.split(F.col("path").substr(len(root) + 2, 1 << 30), "/")[0]
        # one name per touched day: small enough for the driver
        touched = sorted(r[0] for r in batch.select(folder).distinct().collect() if r[0].startswith(f"{PARTITION_COL}="))
        status = wl.table_status(spark, log_path, table)
        # A file without a byte gives no row, so its day is not among the touched ones: days
        # already converted are checked by their folders as well, touched ones always listed.
        known = {p: l for p, l in status.listings.items() if p not in touched}
        days = list_days(spark, source_table, sorted({*touched, *status.done}), known, status.times, look_back=0)
        todo = [p for p in sorted(days.listings) if status.listings.get(p) != days.listings[p]]
        if todo:
            results.append(import_partitions(spark, source_table, target_table, log_path, table, todo,
                                             status, days=days, **import_kw))

    stream = changed_partitions(spark, source_table, max_files_per_trigger)
    writer = (stream.writeStream.foreachBatch(convert_batch)
              .option("checkpointLocation", checkpoint)
              .queryName(f"lakenorm_{table}_{abs(hash(checkpoint)) % 10**8}"))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    query = writer.start()
    query.awaitTermination()
    return list(results)
