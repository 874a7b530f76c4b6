"""Embedding near-duplicates by E8 lattice hashing.

1. Equal vectors form a class, one row from here on with its count.
2. Each table has a random rotation that keeps eight times as many coordinates of
   the unit vector as it has E8 lattices; every eight of them are decoded to the
   nearest point of E8 (scaled by ``SCALE``), and the points together name a cell. A
   vector enters its own cell and the ``PROBES`` neighbouring cells whose lattice
   points are next nearest. The cells get finer as the table grows (``plan_of``):
   an E8 lattice more makes unrelated vectors meet thirty times less often, and
   more tables make up for the near ones, so a vector meets no more strangers in
   a large table than in a small one.
3. Cells with the same members count once. Those with two members or more become
   tiles, with the vectors cut to eight bits a component (the cosine is then off
   by less than ``SLACK``, unless nearly all of a vector is in one component). A
   walk emits a spanning forest of the pairs that may reach the threshold.
4. The components of the forests are brought together with their full vectors,
   and every pair inside is decided by the cosine in double precision. A row
   per vector with its number of links, and a forest of the links, come out.

A cell or component over ``BLOCK`` is cut into blocks, and every pair of blocks
is a task, so no task grows with a group; no pair list is ever written.

Only the candidate search is approximate. A pair alone at cosine 0.902 meets in
one of its tables with probability of about 0.97 at every size of table, and all
pairs inside a found component are compared, so groups do better (tests/llm
measures it for 64 and 768 dimensions at every number of lattices used).

Defined results: a null, empty or zero vector, or one with null or non-finite
components, links with nothing (n_links 0, its own component); vectors of
different length never link; rows that share an id are one node whose links
add up; a null id keeps its row and links with nothing; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, connected_components, mix64, named, stage, table
from .ngram_join import blocks, by_task, tiles_of

THRESHOLD = 0.9
PROBES, SCALE = 14, 0.3
#: Up to so many rows: E8 lattices a table, tables.
PLANS = ((20_000, 3, 5), (2_000_000, 4, 11), (100_000_000, 5, 24), (None, 6, 54))
SLACK = 0.04
BLOCK = 4096


def plan_of(rows: int) -> tuple[int, int]:
    """(E8 lattices a table, tables) for a table of so many rows."""
    return next((e8, tables) for most, e8, tables in PLANS if most is None or rows <= most)


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    pairs = [(i, j, a, b) for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(whole, pairs):
        row[i], row[j] = a, b
    halves = np.array([s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])
    return np.concatenate([whole, halves])


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd
    round the coordinate with the largest error the other way."""
    r = np.rint(y)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    e = y[odd] - r[odd]
    k = np.abs(e).argmax(axis=1)
    r[odd, k] += np.where(e[np.arange(len(odd)), k] >= 0, 1, -1)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8 = D8 and D8 shifted by a half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


class LatticeHash:
    """Cell keys of unit vectors of one dimension: [vector, table, 1 + probes]."""

    def __init__(self, dim: int, e8: int, tables: int, probes: int = PROBES, scale: float = SCALE, seed: int = 8):
        rng = np.random.default_rng([seed, dim])
        self.steps, self.probes, self.e8, self.scale = _minimal_vectors(), probes, e8, scale
        width = max(dim, 8 * e8)
        self.turns = [np.linalg.qr(rng.normal(size=(width, width)))[0][:dim, :8 * e8] * np.sqrt(width / 64) for _ in range(tables)]
        self.coefficients = rng.integers(1, 2**62, (tables, 8 * e8), dtype=np.int64) * 2 + 1

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        keys = []
        rows = np.arange(len(unit))
        for turn, coef in zip(self.turns, self.coefficients):
            y = unit @ turn / self.scale
            parts = [y[:, 8 * q:8 * q + 8] for q in range(self.e8)]
            cells = [nearest_e8(p) for p in parts]
            gain = np.concatenate([(p - c) @ self.steps.T for p, c in zip(parts, cells)], axis=1)
            own = (2 * np.concatenate(cells, axis=1)).astype(np.int64)
            best = np.argpartition(-gain, self.probes, axis=1)[:, :self.probes]
            with np.errstate(over="ignore"):
                at = [(own * coef).sum(axis=1)]
                for p in range(self.probes):
                    block, step = np.divmod(best[:, p], len(self.steps))
                    move = (2 * self.steps[step]).astype(np.int64)
                    at.append(at[0] + (move * coef.reshape(self.e8, 8)[block]).sum(axis=1))
                keys.append(mix64(np.stack(at, axis=1).view(np.uint64) ^ coef[:1].view(np.uint64)))
        return np.stack(keys, axis=1).reshape(len(rows), -1).view(np.int64)


def usable(v) -> np.ndarray | None:
    """The vector in double precision, scaled by a power of two to magnitude 1;
    None if it links with nothing."""
    if v is None or any(x is None for x in v):
        return None
    a = np.asarray(v, np.float64)
    top = np.abs(a).max() if len(a) else 0.0
    if not top or not np.isfinite(top) or not np.isfinite(a).all():
        return None
    return np.ldexp(a, -int(np.frexp(top)[1]))


def features(src: DataFrame) -> DataFrame:
    """``(id, dim, digest, vec, small)``; dim 0 = links with nothing."""
    def batches(it):
        for b in it:
            vs = [usable(v) for v in b.column("vec").to_pylist()]
            small = [None if v is None else np.rint(v / np.abs(v).max() * 127).astype(np.int8).tobytes() for v in vs]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([0 if v is None else len(v) for v in vs], pa.int64()),
                 pa.array([None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in vs], pa.binary()),
                 pa.array([None if v is None else v.tobytes() for v in vs], pa.binary()), pa.array(small, pa.binary())],
                ["id", "dim", "digest", "vec", "small"])

    return src.mapInArrow(batches, f"id {src.schema['id'].dataType.simpleString()}, dim long, digest binary, vec binary, small binary")


def cells(classes: DataFrame, e8: int, tables: int) -> DataFrame:
    """``(key, rep)``: the cells that each vector enters, each once."""
    def batches(it):
        hashes: dict[int, LatticeHash] = {}
        for whole in it:
            for lo in range(0, whole.num_rows, 2048):
                b = whole.slice(lo, 2048)
                dims, raw, reps = b.column("dim").to_numpy(), b.column("vec"), b.column("rep").to_numpy()
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    x = np.frombuffer(b"".join(raw.take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), -1)
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    keys = np.sort(hashes.setdefault(int(dim), LatticeHash(int(dim), e8, tables))(x), axis=1)
                    new = np.concatenate([np.ones((len(at), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(np.repeat(reps[at], new.sum(axis=1)))], ["key", "rep"])

    return classes.select("dim", "vec", "rep").mapInArrow(batches, "key long, rep long")


def walk(linked, n: int) -> list[tuple[int, int]]:
    """Spanning forest of a graph given by ``linked(i, ids) -> bool array``."""
    left, edges = np.arange(n), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = linked(i, left)
            found, left = left[hit], left[~hit]
            edges += [(i, int(j)) for j in found]
            queue += found.tolist()
    return edges


def _edges(ids: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    p = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[p[:, 0]]), pa.array(ids[p[:, 1]])], ["a", "b"])


def _tile_edges(least: float):
    def run(it):
        seen: set = set()
        for t in by_task(it):
            ids, at = np.unique(t.column("rep").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            key = hashlib.blake2b(ids.tobytes(), digest_size=12).digest()
            if key in seen:         # near copies share most of their cells
                continue
            if len(seen) < 200_000:
                seen.add(key)
            raw = t.column("small").take(pa.array(at)).to_pylist()
            if len({len(r) for r in raw}) > 1:      # a hash of cells of two dimensions: rare, compared exactly later
                yield _edges(ids, [(i, i + 1) for i in range(len(ids) - 1)])
                continue
            x = np.frombuffer(b"".join(raw), np.int8).reshape(len(ids), -1).astype(np.float32)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            e = walk(lambda i, left: x[left] @ x[i] >= least, len(ids)) if len(ids) > 2 else (
                [(0, 1)] if x[0] @ x[1] >= least else [])
            if e:
                yield _edges(ids, e)
    return run


def _count_links(threshold: float):
    def run(it):
        for t in by_task(it):
            ids, mult = t.column("rep").to_numpy(), t.column("mult").to_numpy()
            mine, n = t.column("mine").to_numpy(), len(t)
            same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
            raw, dims = t.column("vec").to_pylist(), t.column("dim").to_numpy()
            ok = np.zeros((n, n), bool)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join([raw[k] for k in at]), np.float64).reshape(len(at), -1)
                norm = np.linalg.norm(x, axis=1)
                for lo in range(0, len(at), 1024):
                    cos = x[lo:lo + 1024] @ x.T / (norm[lo:lo + 1024, None] * norm)
                    ok[at[lo:lo + 1024, None], at] = cos >= threshold
            if not same:
                ok &= mine[:, None] != mine
            ok[np.arange(n), np.arange(n)] = False
            count = ok @ mult
            p = np.array(walk(lambda i, left: ok[i, left], n), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, ids[p[:, 0]]])),
                 pa.array(np.concatenate([count, np.zeros(len(p), np.int64)])),
                 pa.array([None] * n + ids[p[:, 1]].tolist(), pa.int64())], ["rep", "links", "other"])
    return run


def embedding_links(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row of ``vectors``."""
    src = named(vectors, id=id_column, vec=vector)
    bounded_batches(src.sparkSession)
    feats = stage(features(src), "lattice-features")
    classes = stage(feats.where("dim > 0 and id is not null").groupBy("dim", "digest").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("vec").alias("vec"),
        F.first("small").alias("small")), "lattice-classes")

    keyed = stage(cells(classes, *plan_of(classes.count())), "lattice-keys")
    tiles = blocks(tiles_of(keyed, "lattice-cells").join(classes.select("rep", "small"), "rep"), "key", "c", BLOCK, "rep")
    maybe = (tiles.select("g", "i", "j", "rep", "small").repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
             .mapInArrow(_tile_edges(threshold - SLACK), "a long, b long"))
    near = stage(connected_components(maybe, "lattice-maybe"), "lattice-near")

    size = near.groupBy("component").agg(F.count(F.lit(1)).alias("w"))
    members = near.join(size, "component").select("component", "w", F.col("node").alias("rep"))
    rows = blocks(members.join(classes.select("rep", "mult", "dim", "vec"), "rep"), "component", "w", BLOCK, "rep", "mine")
    linked = stage(rows.select("g", "i", "j", "rep", "mine", "mult", "dim", "vec").repartition("g", "i", "j")
                   .sortWithinPartitions("g", "i", "j", "rep").mapInArrow(_count_links(threshold), "rep long, links long, other long"),
                   "lattice-links")
    found = connected_components(linked.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")),
                                 "lattice-components")
    count = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    whole = (classes.select(F.col("dim").alias("cd"), F.col("digest").alias("cg"), "rep", "mult")
             .join(count, "rep", "left").join(found, F.col("rep") == F.col("node"), "left"))
    whole = stage(whole.select("cd", "cg", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                               F.coalesce("component", "rep").alias("component")), "lattice-result")
    out = feats.select("id", "dim", "digest").join(whole, (F.col("dim") == F.col("cd")) & (F.col("digest") == F.col("cg")), "left")
    known = F.col("id").isNotNull()
    component = F.when(known, F.coalesce("component", "id"))
    return out.select("id", F.when(known, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), "component_id", "kept")


QUERIES = {"op8_embedding_dedup": op8_embedding_dedup}
ORACLE: dict[str, str] = {}
