"""Shared pieces: table access, scratch tables, word hashing, components."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakenorm.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a bare local session
    (as in tests) gets a folder of its own first."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return scratch_path(spark, label)


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under internal names. Columns are taken by
    position of the exact name, so other columns of the input, also those whose
    names differ by case alone, cannot clash with them or with those made here."""
    missing = [c for c in columns.values() if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{df.columns.index(c)}").alias(k) for k, c in columns.items()])


def bounded_batches(spark: SparkSession) -> None:
    """Batches of at most 4 MB to Python workers, unless the session says otherwise."""
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, str(4 << 20))


def slices(it, column: str, limit: int = 2 << 20):
    """The rows of Arrow batches in runs of about ``limit`` bytes of one column."""
    for b in it:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(size, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), b.num_rows]
        for x, y in zip(edges[:-1], edges[1:]):
            if y > x:
                yield b.slice(x, y - x)


# ------------------------------------------------------------- word hashing

STEP = 1 << 19
_MULT = 0x9E3779B97F4A7C13          # odd, = 3 (mod 8)
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def word_sums(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial modulo 2**64 over the bytes, and the factors
    that shift a difference of them back: ``(s[j] - s[i]) * f[i]`` depends on the
    bytes i to j alone. The tables of powers grow to the longest array seen."""
    n = len(a)
    with np.errstate(over="ignore"):
        if len(_POWERS.get("up", ())) < n:
            step = np.full(max(n, 2 * STEP + 4096), _MULT, np.uint64)
            step[0] = 1
            _POWERS["up"] = np.cumprod(step)
            step[1:] = pow(_MULT, -1, 2**64)
            _POWERS["down"] = np.cumprod(step)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[a] * _POWERS["up"][:n], out=sums[1:])
    return sums, _POWERS["down"]


class WordHasher:
    """64-bit hashes of all words of a byte buffer, without a Python loop.

    ``separators`` is a 256-entry boolean table. The hash of a word is a
    difference of prefix sums of a polynomial modulo 2**64, mixed at the end.
    """

    def __init__(self, separators: np.ndarray):
        self.sep = separators

    def __call__(self, buf: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes, byte position of each word's start) in text order.
        Worked off in steps of about ``STEP`` bytes, cut between words."""
        a = np.frombuffer(buf, np.uint8)
        hashes, starts, at = [], [], 0
        while at < len(a):
            to = min(at + STEP, len(a))
            while to < len(a) and not self.sep[a[to]]:      # on to the end of the word
                gap = np.flatnonzero(self.sep[a[to:to + 4096]])
                to = to + int(gap[0]) if len(gap) else min(to + 4096, len(a))
            h, start = self._words(a[at:to])
            hashes.append(h)
            starts.append(start + at)
            at = to
        return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
                np.concatenate(starts) if starts else np.zeros(0, np.int64))

    def _words(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(a)
        sep = self.sep[a]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        if not sep[0]:
            edge = np.concatenate(([0], edge))
        if not sep[-1]:
            edge = np.concatenate((edge, [n]))
        start, end = edge[0::2], edge[1::2]
        sums, shift = word_sums(a)
        with np.errstate(over="ignore"):
            h = (sums[end] - sums[start]) * shift[start]
            return mix64(h + (end - start).astype(np.uint64)), start


def pieces(texts: list, limit: int = 1 << 20):
    """Consecutive runs of rows of about ``limit`` bytes (a longer row is a
    run of its own): (first row, rows)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


# --------------------------------------------------------------- components

def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(h), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 20)))).first())


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` of the undirected graph ``edges(a long, b long)``;
    component is the smallest node. Alternating large-star and small-star steps:
    a hub of any degree only meets its minimum, an aggregate that combines on
    the map side, and every step is written to the shared folder.
    """
    e = stage(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-0")
    turn, seen = 0, None
    while True:
        turn += 1
        # large star: every larger neighbour of u hangs on the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: the smaller neighbours of u, and u, hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        new = stage(small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                   F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                    .select("e.*").where("u <> v").distinct(), f"{label}-{turn}")
        e, before, seen = new, seen, _checksum(new)
        if seen == before:
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
