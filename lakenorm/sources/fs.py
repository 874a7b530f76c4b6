"""Small file-system helpers over Hadoop's FileSystem (any scheme Spark reads).

Only directory-level metadata goes through here (exists, list one level,
delete exactly one directory). File contents are always read by Spark.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (hidden ``_``/``.`` ones skipped)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            out.append(name)
    return sorted(out)


def dir_times(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and modification times (ms) of the sub-directories of ``path``, from
    one listing (hidden ``_``/``.`` ones skipped); 0 where the storage has none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return {}
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            out[name] = int(st.getModificationTime())
    return out


def has_subfolders(spark: SparkSession, path: str) -> bool:
    """Does ``path`` hold a folder (hidden ones included)? One metadata call."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getDirectoryCount()) > 1


def has_files(spark: SparkSession, path: str) -> bool:
    """Does ``path`` hold at least one data file (at any depth, hidden ``_``/``.``
    entries skipped)? Lists lazily and stops at the first file."""
    fs, p = _fs_path(spark, path)
    pending = [p]
    while pending:
        folder = pending.pop()
        try:
            entries = fs.listStatusIterator(folder)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getName() != "java.io.FileNotFoundException":
                raise               # a listing that fails says nothing about the folder
            continue
        while entries.hasNext():
            st = entries.next()
            if st.getPath().getName().startswith(("_", ".")):
                continue
            if st.isFile():
                return True
            pending.append(st.getPath())
    return False


def count_files(spark: SparkSession, path: str) -> int:
    """Number of files below ``path``, hidden ones included (an upper bound
    for :func:`list_files`), from one metadata call."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getFileCount())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the data files directly below ``path`` (hidden ``_``/``.`` skipped)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


def file_times(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and modification times (ms) of the files directly below ``path``."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return {}
    files = [st for st in fs.listStatus(p) if st.isFile()]
    return {st.getPath().getName(): int(st.getModificationTime()) for st in files if not st.getPath().getName().startswith(("_", "."))}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark's file sources report it (scheme and authority included)."""
    fs, p = _fs_path(spark, path)
    return fs.makeQualified(p).toString()


# What the footer reader says of bytes that are not a Parquet file (fixed texts).
# Nothing else counts: an interrupt, an exhausted heap or a storage error says
# nothing about the file.
NOT_PARQUET = ("is not a Parquet file", "corrupted file", "can not read class org.apache.parquet")


def _not_parquet(kind: str, message: str) -> bool:
    return kind.startswith("org.apache.parquet.") or any(m in message for m in NOT_PARQUET)


def parquet_rows(spark: SparkSession, path: str) -> int | None:
    """Rows that a Parquet file's footer promises; None if it is not a readable
    Parquet file. Any other failure (the storage is out of reach, access is
    denied) is raised: it says nothing about the file."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs_path(spark, path)
    fs.open(p).close()                               # reaches the storage, or raises
    try:
        footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark.sparkContext._jsc.hadoopConfiguration(), p)
    except Py4JJavaError as e:
        cause = e.java_exception
        while cause is not None:
            if _not_parquet(cause.getClass().getName(), cause.getMessage() or ""):
                return None
            cause = cause.getCause()
        raise
    return sum(b.getRowCount() for b in footer.getBlocks())


def delete_file(spark: SparkSession, path: str) -> bool:
    """Delete one file (not a directory)."""
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, False))


def delete_dir(spark: SparkSession, path: str) -> bool:
    """Delete exactly ``path`` (recursively); a sibling sharing a name prefix
    (``user`` vs ``users``) is never touched."""
    fs, p = _fs_path(spark, path.rstrip("/"))
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file of the engine's own."""
    fs, p = _fs_path(spark, path)
    size, stream = int(fs.getFileStatus(p).getLen()), fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode("utf-8") if size else ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
