"""Hard negatives by anchor-clustered shared lists.

Scores are inner products of vectors on a grid of whole numbers, so they are
exact. An anchor's positives are its best rows of the same label; for each
positive, the best rows of other labels inside a band of its score are wanted.

1. Rows are packed once: records of up to ``RECORD_BYTES`` with the whole numbers
   in the smallest type that holds them.
2. Anchors are dealt into groups of at most about ``GROUP_BYTES``. A group is
   clustered by direction (spherical k-means with seeded starts) and shipped to
   its tasks; it is the stated query set. ``WAVE`` groups are searched in one
   job, each by a few long tasks, so lists are begun and merged seldom.
3. A task goes through its rows in blocks, and through the labels of a block: for
   positives the anchors of that label meet them, else those of other labels. For
   each cluster the rows have the upper bound ``|i| cos(max(0, angle(i, centre) -
   r))``, where r is the largest angle between the centre and a member: no member
   a scores more than ``|a|`` times that. Rows below what all members look for are
   left out; the others are sorted by the bound, all members walk the one list, in
   steps, and each leaves it for certain when the bound falls below what it still
   looks for: the last place of a full list, or the lower end of a band. Clusters
   whose bound rules out less than half of the rows are taken together for some
   blocks, against all rows, and tried again later. Lists are kept from block to
   block, so later blocks end sooner.
4. Scores are first taken in single precision, against what is looked for less the
   largest rounding error; what passes is scored exactly.
5. A task gives at most the wanted number of rows per anchor and band; Spark
   merges them with a window per anchor and band, whose size is bounded by the
   number of tasks and not by the rows.

Two passes over the rows are made per group: positives first, then the bands
that their scores state. Nothing is dropped by the clusters: a bad clustering
costs time only. Rows are never shuffled; memory of a task is a block, the
group and its lists.

Every anchor meets every row of its vector length unless a bound rules it out.
The anchors are a fixed share of the rows, so where directions are spread evenly
over many dimensions the time grows with the square of the table.

Defined results: rows with a null label or vector, or with a null or non-finite
entry, take no part, neither do empty vectors; vectors of different length never
meet; a null id is no anchor and comes last among ties; rows that share an id are
rows of their own (an anchor is not its own positive, its namesake may be); a
label of an id divisible by 7 moves on; an anchor without positives, or a
positive with an empty band (as with a negative score), gives no rows; a score
beyond 64 bits is shown as the nearest such number; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, named, scratch, stage, table

GRID = 256                      # fixed value of the contract
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90              # the band, in hundredths of the positive's score
EVERY = 100
GROUP_BYTES = 8 << 20
WAVE = 6                        # groups of one job
CLUSTER, ROUNDS = 64, 8         # anchors a cluster, on average; rounds of k-means
RECORD_BYTES = 64 << 10         # of vectors, in a record of packed rows
ROWS, BLOCK_BYTES = 1 << 15, 16 << 20    # rows of a block, at most; bytes of its vectors as doubles
STEP = 256                      # rows of the first step along a list
TILE = 512                      # anchors, and rows, that are scored at once without a list
RUN = 2048                      # rows of a label, on average, from which labels are gone through one by one for negatives
SEED = 4096                     # rows of a first block that tell what lists will reach
PENDING = 4096                  # finds after which what is looked for is taken anew
EXACT, SINGLE = float(1 << 53), float(1 << 24)
TOP = 1 << 63


# --------------------------------------------------------------- preparation

def prepared(src: DataFrame) -> DataFrame:
    """``src(id, vec, label)`` -> ``(uid, id, label, vec)`` of floats or doubles, without null and empty vectors."""
    kind = src.schema["vec"].dataType.elementType.typeName()
    vec = F.col("vec") if kind in ("float", "double") else F.transform("vec", lambda c: c.cast("double"))
    return src.where(F.col("vec").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)).select(
        F.monotonically_increasing_id().alias("uid"), "id", F.col("label").cast("long").alias("label"), vec.alias("vec"))


def on_grid(b: pa.RecordBatch):
    """(vectors on the grid, row numbers) of the rows of a batch with equal length
    and finite entries. Beyond 2**52 every double is whole."""
    size = np.diff(b.column("vec").offsets.to_numpy())
    with np.errstate(over="ignore", invalid="ignore"):
        flat = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64) * GRID       # null is NaN
    start = np.cumsum(size) - size
    usable = np.logical_and.reduceat(np.isfinite(flat), start)
    for dim in np.unique(size[usable]).tolist():
        at = np.flatnonzero(usable & (size == dim))
        yield np.floor(flat.reshape(-1, dim) if len(at) == len(size) else flat[start[at, None] + np.arange(dim)]), at


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def by_length(b: pa.RecordBatch):
    """(vectors, row numbers) of the rows of a batch with equal length."""
    size = np.diff(b.column("q").offsets.to_numpy())
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield _matrix(b.column("q") if len(at) == len(size) else b.column("q").take(pa.array(at))), at


_ROWS = "uid long, id long, label long, q array<double>"
_PACKED = "dim int, kind string, uid binary, id binary, gone binary, label binary, q binary"


def packed(rows: DataFrame) -> DataFrame:
    """``(uid, id, label, vec)`` -> records of rows of one vector length."""
    def batches(it):
        for b in it:
            if not b.num_rows:
                continue
            ids = b.column("id")
            gone, ident = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int8), ids.fill_null(0).to_numpy(zero_copy_only=False)
            uid, label = b.column("uid").to_numpy(), b.column("label").to_numpy()
            out: list[tuple] = []
            for q, at in on_grid(b):
                rows_each = max(1, RECORD_BYTES // (2 * q.shape[1]))
                for lo in range(0, len(at), rows_each):
                    part, pick = q[lo:lo + rows_each], at[lo:lo + rows_each]
                    top = np.abs(part).max()
                    kind = "i2" if top < 1 << 15 else "f4" if top < SINGLE else "f8"
                    out.append((q.shape[1], kind, *(x[pick].tobytes() for x in (uid, ident, gone, label)), part.astype(kind).tobytes()))
            if out:
                kinds = [pa.int32(), pa.string(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                                                 ["dim", "kind", "uid", "id", "gone", "label", "q"])
    return rows.mapInArrow(batches, _PACKED)


def _records(it):
    """(vector length, [vectors, label, id, id is null, uid]) of every record."""
    for b in it:
        for r in b.to_pylist():
            uid, ident, label = (np.frombuffer(r[c], np.int64) for c in ("uid", "id", "label"))
            yield r["dim"], [np.frombuffer(r["q"], r["kind"]).reshape(-1, r["dim"]), label, ident, np.frombuffer(r["gone"], np.int8), uid]


def _blocks(it):
    """The rows of packed records, in blocks of one vector length."""
    kept: dict[int, list] = {}
    for dim, columns in _records(it):
        waiting = kept.setdefault(dim, [])
        waiting.append(columns)
        if sum(len(c[0]) for c in waiting) >= max(1, min(ROWS, BLOCK_BYTES // (8 * dim))):
            yield [np.concatenate(x) for x in zip(*kept.pop(dim))]
    for waiting in kept.values():
        yield [np.concatenate(x) for x in zip(*waiting)]


def divisible(rows: DataFrame, every: int) -> DataFrame:
    """``(uid, id, label, q)`` of the packed rows whose id is divisible by ``every``."""
    def batches(it):
        for dim, (q, label, ident, gone, uid) in _records(it):
            at = np.flatnonzero((gone == 0) & (ident % every == 0))
            if len(at):
                vectors = pa.ListArray.from_arrays(np.arange(0, len(at) * dim + 1, dim, dtype=np.int32), pa.array(q[at].astype(np.float64).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(uid[at]), pa.array(ident[at]), pa.array(label[at]), vectors], ["uid", "id", "label", "q"])
    return rows.mapInArrow(batches, _ROWS)


# -------------------------------------------------------------------- lists

def _single(q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(scale, q / scale in single precision, norms of q / scale). The scale is 1
    while single precision holds whole entries, else a power of two near the
    largest entry: squares of the quotient are finite."""
    top = float(np.abs(q).max(initial=0))
    scale = 1.0 if top < SINGLE else float(np.ldexp(1.0, int(np.frexp(top)[1]) - 1))
    x = q.astype(np.float64) / scale
    return scale, x.astype(np.float32), np.sqrt(np.einsum("ij,ij->i", x, x))


def _unit(x: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return x / np.where(norm > 0, norm, 1)[:, None].astype(x.dtype)


class Anchors:
    """A group of anchors of one vector length, in clusters."""

    def __init__(self, uid, label, q: np.ndarray, seed: int = 12):
        self.uid, self.label, self.q = uid, label, q
        self.scale, self.small, self.norm = _single(q)
        unit = _unit(q / self.scale, self.norm)
        owner, centres = _clusters(unit, max(1, -(-len(q) // CLUSTER)), np.random.default_rng(seed))
        self.owner = np.zeros(len(q), np.int64)         # the cluster, or the part of a large one
        shared, widest = [], []
        for c, centre in enumerate(centres):
            members = np.flatnonzero(owner == c)
            for part in np.array_split(members, -(-len(members) // (4 * CLUSTER))) if len(members) else []:
                self.owner[part] = len(shared)
                shared.append(centre)
                widest.append(np.clip(unit[part] @ centre, -1, 1).min() - 1e-9 if centre.any() else -2.0)
        self.centres = np.array(shared, np.float32).reshape(len(shared), q.shape[1])
        self.cos = np.maximum(np.array(widest), -1).astype(np.float32)         # of the largest angle to a member
        self.sin = np.sqrt(1 - self.cos ** 2)
        self.largest = float(np.abs(q).max(initial=0))

    def bound(self, clusters: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """[row, cluster]: no member's cosine with the row is above it."""
        slack = np.float32(1e-6 + 2.0 ** -21 * unit.shape[1])
        c = np.minimum(unit @ self.centres[clusters].T + slack, np.float32(1))
        b = np.sqrt(np.maximum(1 - c * c, 0))
        b *= self.sin[clusters]
        b += c * self.cos[clusters]
        b[c >= self.cos[clusters]] = 1
        return b + slack


def _clusters(unit: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    centres = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(ROUNDS):
        owner = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, unit)
        norm = np.linalg.norm(sums, axis=1)
        centres = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], centres)
    return (unit @ centres.T).argmax(axis=1), centres


_TILES: dict[str, np.ndarray] = {}


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows in single precision; exact while every sum stays
    below 2**24. They lie in one array that the next call fills again."""
    size = len(a) * len(b)
    if len(_TILES.get("scores", ())) < size:
        _TILES["scores"] = np.empty(size, np.float32)
    return np.matmul(a, b.T, out=_TILES["scores"][:size].reshape(len(a), len(b)))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, pair by pair: doubles while
    every sum stays below 2**53, whole numbers of any size beyond."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b)
    out = np.empty(len(a), object)
    out[:] = [sum(int(x) * int(y) for x, y in zip(*pair)) for pair in zip(a.tolist(), b.tolist())]
    return out


class Lists:
    """The best rows found so far for every slot (an anchor and one band of
    scores), by falling score, then by id, null ids last. A slot has room for
    twice the wanted number of rows and is cut back when that is full."""

    def __init__(self, slots: int, depth: int):
        self.depth, self.room = depth, 2 * depth
        self.held = np.zeros(slots, np.int64)
        self.values = np.zeros((slots, self.room))      # doubles, whole numbers of any size once one is beyond 2**53
        self.gone, self.ids, self.uids = (np.zeros((slots, self.room), t) for t in (np.int8, np.int64, np.int64))
        self.least = np.full(slots, -np.inf)            # a score that the last wanted place reaches
        self.tail = np.full(slots, TOP - 1, np.int64)   # the id of that place, if it is cut back and has one
        self.turn, self.until, self.pause, self.seeded = 0, None, None, None    # blocks seen; per cluster, when its bound is next tried; per anchor

    def held_rows(self) -> tuple[np.ndarray, ...]:
        """(slot, score, id is null, id, uid) of all rows held."""
        self._cut(np.flatnonzero(self.held))
        at = np.arange(self.room) < self.held[:, None]
        return (np.repeat(np.arange(len(self.held)), self.held), *(x[at] for x in (self.values, self.gone, self.ids, self.uids)))

    @property
    def score(self) -> np.ndarray:
        return self.held_rows()[1]

    def add(self, slot, score, gone, ident, uid) -> None:
        if len(slot) and (score.dtype == object) != (self.values.dtype == object):
            self.values, score = _whole(self.values), _whole(score)
        while len(slot):
            order = np.argsort(slot, kind="stable")
            slot, score, gone, ident, uid = (x[order] for x in (slot, score, gone, ident, uid))
            first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            count = np.diff(np.append(first, len(slot)))
            touched = slot[first]
            place = self.held[slot] + np.arange(len(slot)) - np.repeat(first, count)
            fits = place < self.room
            for x, y in ((self.values, score), (self.gone, gone), (self.ids, ident), (self.uids, uid)):
                x[slot[fits], place[fits]] = y[fits]
            self.held[touched] = held = np.minimum(self.held[touched] + count, self.room)
            self._cut(touched[(held == self.room) | ((held >= self.depth) & np.isinf(self.least[touched]))])
            rest = ~fits & (score >= self.least[slot])
            slot, score, gone, ident, uid = (x[rest] for x in (slot, score, gone, ident, uid))

    def _cut(self, slots: np.ndarray) -> None:
        """Sorts these slots and cuts them back to the wanted number."""
        valid = np.arange(self.room) < self.held[slots][:, None]
        ids, gone, values = self.ids[slots], self.gone[slots], self.values[slots]
        key = np.full(valid.shape, np.inf)
        key[valid] = -(_ranks(values[valid]) if values.dtype == object else values[valid])
        order = np.argsort(ids, axis=1, kind="stable")
        for by in (gone, key) if gone.any() else (key,):
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(by, order, 1), axis=1, kind="stable"), 1)
        for x in (self.values, self.gone, self.ids, self.uids):
            x[slots] = np.take_along_axis(x[slots], order, 1)
        self.held[slots] = np.minimum(self.held[slots], self.depth)
        full = slots[self.held[slots] == self.depth]
        last = self.depth - 1
        self.least[full] = np.maximum(self.least[full], _doubles(self.values[full, last], -1))
        self.tail[full] = np.where(self.gone[full, last] > 0, TOP - 1, self.ids[full, last])


def _whole(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def _ranks(x: np.ndarray) -> np.ndarray:
    values = sorted(set(x.tolist()))
    at = {v: i for i, v in enumerate(values)}
    return np.array([at[v] for v in x.tolist()], np.float64)


def _doubles(x: np.ndarray, side: int) -> np.ndarray:
    """Doubles that are not above (side -1) or not below (side 1) the numbers x."""
    if x.dtype != object:
        return x

    def near(v) -> float:
        try:
            f = float(v)
        except OverflowError:
            f = float("inf") if v > 0 else -float("inf")
        return f if side * f >= side * v else float(np.nextafter(f, side * np.inf))
    return np.array([near(v) for v in x.tolist()], np.float64)


class Block:
    """Rows of one vector length, by label."""

    def __init__(self, q, label, ident, gone, uid):
        order = np.argsort(label, kind="stable")
        self.q, self.label, self.ident, self.gone, self.uid = (x[order] for x in (q, label, ident, gone, uid))
        self.scale, self.small, self.norm = _single(self.q)
        self.unit = _unit(self.small, self.norm)
        self.largest = float(np.abs(self.q).max(initial=0))
        self.widest = float(self.norm.max(initial=0))
        self.first_id = int(self.ident[self.gone == 0].min(initial=TOP - 1))
        self.starts = np.flatnonzero(np.append(True, self.label[1:] != self.label[:-1]))

    def runs(self) -> list[tuple[int, int]]:
        return list(zip(self.starts.tolist(), [*self.starts[1:].tolist(), len(self.label)]))


class Walk:
    """One block of rows against all clusters of a group."""

    def __init__(self, anchors: Anchors, slot_of, low, high, same: bool, lists: Lists, block: Block):
        self.a, self.slot_of, self.low, self.high, self.same, self.lists, self.b = anchors, slot_of, low, high, same, lists, block
        self.floor, self.top = _doubles(low, -1), _doubles(high, 1)
        dim = block.q.shape[1]
        self.slack = 2.0 ** -24 * (dim + 8) * block.widest      # of a score, for an anchor of norm 1
        self.exact = anchors.scale == block.scale == 1 and anchors.largest * block.largest * dim < SINGLE
        self.chunk = max(1, (4 << 20) // dim)
        self.found: list[tuple] = []        # pairs that are not in the lists yet
        if lists.until is None:
            lists.until, lists.pause = np.zeros(len(anchors.centres), np.int64), np.full(len(anchors.centres), 8, np.int64)
            lists.seeded = np.zeros(len(anchors.uid), bool)

    def sought(self, members) -> np.ndarray:
        """[member, band]: the least score that still matters. Rows that tie with
        the last place of a full list do not, if their ids come later."""
        slots, lists = self.slot_of[members], self.lists
        least = lists.least[slots] + ((lists.tail[slots] < self.b.first_id) & (lists.least[slots] < EXACT))
        return np.where(slots >= 0, np.maximum(self.floor[slots], least), np.inf)

    def scaled(self, x) -> np.ndarray:
        return x / self.a.scale / self.b.scale

    def under(self, x, members) -> np.ndarray:
        """Single precision, below x by the largest error of a score."""
        with np.errstate(over="ignore"):
            return np.nextafter((self.scaled(x) - self.slack * self.a.norm[members] - 1e-30).astype(np.float32), np.float32(-np.inf))

    def over(self, x, members) -> np.ndarray:
        return -self.under(-x, members)

    def tile(self, members, small, need, least, rows) -> None:
        """Finds the pairs whose score may matter; ``need`` [member, band], ``least`` of a member in single precision."""
        s = scores(self.b.small[rows], small)
        at = np.flatnonzero(s.max(axis=0) >= least)
        if not len(at):
            return
        if 4 * len(at) < len(members):
            s, members, least, need = s.take(at, axis=1), members[at], least[at], need[at]
        fits = s >= least
        if 64 * np.count_nonzero(fits) > fits.size and need.shape[1] > 1:      # most are above a band
            inside = np.zeros_like(fits)
            for k in range(need.shape[1]):
                inside |= (s >= self.under(need[:, k], members)) & (s <= self.over(self.top[self.slot_of[members, k]], members))
            fits = inside
        at = np.flatnonzero(fits)
        j, i = np.divmod(at, len(members))
        self.found.append((members[i], rows.start + j if isinstance(rows, slice) else rows[j], s.ravel()[at]))

    def settle(self, start: int = 0) -> None:
        """What was found since ``start`` goes to the lists."""
        if len(self.found) > start:
            self.offer(*(np.concatenate(x) for x in zip(*self.found[start:])))
            del self.found[start:]

    def pending(self, start: int) -> int:
        return sum(len(x[0]) for x in self.found[start:])

    def offer(self, i, j, s) -> None:
        """The rows j to the lists of the anchors i."""
        a, b, lists = self.a, self.b, self.lists
        fits = (a.label[i] == b.label[j]) == self.same
        if self.same:
            fits &= a.uid[i] != b.uid[j]
        i, j, s = i[fits], j[fits], s[fits]
        for lo in range(0, len(i), self.chunk):
            x, y = i[lo:lo + self.chunk], j[lo:lo + self.chunk]
            value = s[lo:lo + self.chunk].astype(np.float64) if self.exact else inner(a.q[x], b.q[y])
            slots, each = self.slot_of[x], value[:, None]
            late = (each == lists.least[slots]) & (lists.tail[slots] < b.ident[y][:, None])
            fits = (slots >= 0) & (each >= self.low[slots]) & (each <= self.high[slots]) & (each >= lists.least[slots]) & ~late
            pick, k = np.nonzero(fits)
            y = y[pick]
            lists.add(slots[pick, k], value[pick], b.gone[y], b.ident[y], b.uid[y])

    def seed(self, members, rows: slice) -> None:
        """Scores that lists of these anchors reach for certain, from some rows of the block."""
        a, b, lists = self.a, self.b, self.lists
        s = scores(b.small[rows], a.small[members])
        out = (b.label[rows, None] == a.label[members]) != self.same
        if self.same:
            out |= b.uid[rows, None] == a.uid[members]
        s[out] = -np.inf
        s = np.sort(s.T, axis=1)
        for k in range(self.slot_of.shape[1]):
            slot = self.slot_of[members, k]
            at = np.count_nonzero(s <= self.under(self.top[slot], members)[:, None], axis=1) - lists.depth
            ok = np.flatnonzero((at >= 0) & (slot >= 0))
            with np.errstate(over="ignore"):
                reached = (s[ok, at[ok]].astype(np.float64) - self.slack * a.norm[members[ok]] - 1e-30) * a.scale * b.scale
            lists.least[slot[ok]] = np.maximum(lists.least[slot[ok]], np.where(reached < np.inf, reached, -np.inf))
        lists.seeded[members] = True

    def listed(self, members, rows, bound) -> int:
        """All members walk one list of rows, by falling bound; how far they came."""
        at, step, start = 0, STEP, len(self.found)
        while at < len(rows):
            need = self.sought(members)
            stay = self.a.norm[members] * bound[at] >= self.scaled(need.min(axis=1))   # the others have what they look for
            members, need = members[stay], need[stay]
            if not len(members):
                break
            self.tile(members, self.a.small[members], need, self.under(need.min(axis=1), members), rows[at:at + step])
            at, step = at + step, min(4 * step, 4096)
            if at < len(rows) and self.pending(start) > len(members):
                self.settle(start)
        return at

    def together(self, members, lo: int, hi: int) -> None:
        """All members against all rows of a run."""
        edges = np.linspace(lo, hi, -(-(hi - lo) // TILE) + 1).astype(np.int64).tolist()
        for part in np.array_split(members, -(-len(members) // TILE)) if len(members) else []:
            new = part[~self.lists.seeded[part]]
            if len(new):
                self.seed(new, slice(lo, min(hi, lo + SEED)) if self.same else slice(0, SEED))
            small, start, need = self.a.small[part], len(self.found), None
            for x, y in zip(edges[:-1], edges[1:]):
                if need is None:
                    need = self.sought(part)
                    least = self.under(need.min(axis=1), part)
                self.tile(part, small, need, least, slice(x, y))
                if self.pending(start) >= PENDING:
                    self.settle(start)
                    need = None

    def run(self, members, lo: int, hi: int) -> None:
        """The members against the rows lo to hi of the block."""
        a, lists = self.a, self.lists
        tried = (lists.until <= lists.turn)[a.owner[members]]
        whole = [members[~tried]]
        members = members[tried]
        members = members[np.argsort(a.owner[members], kind="stable")]
        clusters, first = np.unique(a.owner[members], return_index=True)
        if len(clusters):
            need, norm = self.scaled(self.sought(members).min(axis=1)), a.norm[members]
            each = np.where(norm > 0, need / np.where(norm > 0, norm, 1), np.where(need > 0, np.inf, -np.inf))
            least = np.minimum.reduceat(each, first)
        for c in range(0, len(clusters), 64):
            bounds = a.bound(clusters[c:c + 64], self.b.unit[lo:hi]) * self.b.norm[lo:hi, None]
            for k, bound in enumerate(bounds.T, c):
                mine = members[first[k]:first[k + 1] if k + 1 < len(first) else None]
                rows = np.flatnonzero(bound >= least[k])
                flat = np.isfinite(least[k]) and 2 * len(rows) > hi - lo
                if flat:
                    whole.append(mine)
                else:
                    rows = rows[np.argsort(-bound[rows], kind="stable")]
                    flat = 2 * self.listed(mine, rows + lo, bound[rows]) > hi - lo
                if flat:
                    lists.until[clusters[k]] = lists.turn + lists.pause[clusters[k]]
                    lists.pause[clusters[k]] = min(2 * lists.pause[clusters[k]], 64)
        self.together(np.concatenate(whole), lo, hi)


def walk(anchors: Anchors, slot_of: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, lists: Lists,
         q: np.ndarray, label, ident, gone, uid) -> None:
    """One block of rows against all clusters. ``slot_of`` [anchor, band] numbers
    the slots (-1: none); a slot takes scores from ``low`` to ``high``."""
    wanted = np.flatnonzero((slot_of >= 0).any(axis=1))
    if not len(wanted) or not len(q):
        return
    block = Block(q, label, ident, gone, uid)
    step = Walk(anchors, slot_of, low, high, same, lists, block)
    wanted = wanted[np.argsort(anchors.label[wanted], kind="stable")]
    labels, runs = anchors.label[wanted], block.runs()
    if not same and len(runs) * RUN > len(q):
        step.run(wanted, 0, len(q))
        runs = []
    for lo, hi in runs:
        x, y = np.searchsorted(labels, block.label[lo], "left"), np.searchsorted(labels, block.label[lo], "right")
        members = wanted[x:y] if same else np.concatenate((wanted[:x], wanted[y:]))
        if len(members):
            step.run(members, lo, hi)
    step.settle()
    lists.turn += 1


_NINES = str.maketrans("0123456789", "9876543210")


def _sortable(x: int) -> str:
    """Text whose order is that of whole numbers of any size."""
    digits = str(abs(x))
    return f"1{len(digits):05d}{digits}" if x >= 0 else f"0{99999 - len(digits):05d}{digits.translate(_NINES)}"


def _search(group: int, anchors: Anchors, bands, same: bool, depth: int):
    """Tasks over packed rows: the best rows per slot. ``bands``: (slot_of, low, high).
    ``exact`` and ``by`` are null for scores that fit 64 bits, which are in ``score``."""
    slot_of, low, high = bands

    def batches(it):
        lists = Lists(len(low), depth)
        for columns in _blocks(it):
            if columns[0].shape[1] == anchors.q.shape[1]:
                walk(anchors, slot_of, low, high, same, lists, *columns)
        slot, score, gone, ident, uid = lists.held_rows()
        for lo in range(0, len(slot), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            if score.dtype != object:
                shown, far = pa.array(score[part].astype(np.int64)), [None] * len(score[part])
            else:
                shown = pa.array([max(-TOP, min(TOP - 1, x)) for x in score[part]], pa.int64())
                far = [None if 1 - TOP < x < TOP - 1 else x for x in score[part]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(far), group, np.int32)), pa.array(slot[part]),
                 pa.array([None if x is None else str(x) for x in far], pa.string()),
                 pa.array([None if x is None else _sortable(x) for x in far], pa.string()), shown,
                 pa.array(ident[part], mask=gone[part].astype(bool)), pa.array(uid[part])],
                ["n", "slot", "exact", "by", "score", "id", "uid"])
    return batches


_FOUND = "n int, slot long, exact string, by string, score long, id long, uid long"


def _best(found: DataFrame, depth: int) -> DataFrame:
    """Merge of the tasks' lists: a window holds a slot's rows, at most ``depth`` a task."""
    order = Window.partitionBy("n", "slot").orderBy(F.col("score").desc(), F.col("by").desc(), F.col("id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``rows`` of a written table of packed rows, ``anchors`` ``(uid, id, label, q)`` of a written table ->
    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``."""
    spark = rows.sparkSession
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    total, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    if not total:
        return spark.createDataFrame([], schema)
    groups = -(-total * width * 8 // GROUP_BYTES)
    dealt, out = scratch(spark, "anchors"), scratch(spark, "negatives")
    anchors.withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")).repartition("g").write.partitionBy("g").parquet(dealt)
    for g in range(0, groups, WAVE):
        blocks = [spark.read.parquet(dealt).where(F.col("g") == x).drop("g").orderBy("uid").toArrow()       # at most about GROUP_BYTES
                  for x in range(g, min(g + WAVE, groups))]
        _mine_groups(rows, blocks, positives, negatives, low, high).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _mine_groups(rows: DataFrame, blocks: list[pa.Table], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    found_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    groups: list[Anchors] = []
    ids: list[np.ndarray] = []
    for block in blocks:
        for b in block.combine_chunks().to_batches():
            for q, at in by_length(b):
                groups.append(Anchors(b.column("uid").to_numpy()[at], b.column("label").to_numpy()[at], q))
                ids.append(b.column("id").to_numpy()[at])
    if not groups:
        return spark.createDataFrame([], found_schema)
    tasks = max(1, -(-2 * spark.sparkContext.defaultParallelism // len(groups)))

    def search(bands, same: bool, depth: int) -> DataFrame:
        """One job for all groups; the rows go to a few tasks a group, as they lie."""
        found = [rows.coalesce(tasks).mapInArrow(_search(n, a, band, same, depth), _FOUND) for n, (a, band) in enumerate(zip(groups, bands))]
        return _best(reduce(DataFrame.unionAll, found), depth)

    # positives: one slot an anchor, any score
    bands = [(np.arange(len(g.uid))[:, None], np.full(len(g.uid), -np.inf), np.full(len(g.uid), np.inf)) for g in groups]
    first = search(bands, True, positives).select("n", "slot", "rank", "id", "score", "exact").toArrow()
    chosen: list[list[list]] = [[[] for _ in g.uid] for g in groups]
    for n, slot, rank, ident, shown, exact in zip(*(c.to_pylist() for c in first.columns)):
        chosen[n][slot].append((rank, ident, shown, shown if exact is None else int(exact)))
    # negatives: a slot a positive, its band in whole numbers
    bands, wanted = [], []
    for n, per_anchor in enumerate(chosen):
        slot_of, lows, highs = np.full((len(per_anchor), positives), -1, np.int64), [], []
        for a, found in enumerate(per_anchor):
            for k, (_, ident, shown, score) in enumerate(sorted(found, key=lambda f: f[0])):
                least, most = -(-low * score // 100), high * score // 100
                if least <= most:
                    slot_of[a, k] = len(lows)
                    wanted.append((n, len(lows), int(ids[n][a]), ident, shown))
                    lows.append(least)
                    highs.append(most)
        number = lambda x: np.array(x, np.float64 if all(abs(v) < EXACT for v in x) else object)
        bands.append((slot_of, number(lows), number(highs)))
    if not wanted:
        return spark.createDataFrame([], found_schema)
    best = search(bands, False, negatives)
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    slots = spark.createDataFrame(pa.table([pa.array(x, t) for x, t in zip(zip(*wanted), kinds)],
                                           names=["n", "slot", "anchor_id", "positive_id", "positive_score"]))
    return best.join(slots, ["n", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                   every: int = EVERY, **options) -> DataFrame:
    """Anchors are the rows whose id is divisible by ``every``; all rows are candidates."""
    src = named(vectors, id=id_column, vec=vector, label=label)
    bounded_batches(src.sparkSession)
    rows = stage(packed(prepared(src.select(F.col("id").cast("long").alias("id"), "vec", "label"))), "negatives-rows")
    return mine(rows, stage(divisible(rows, every), "negatives-anchors"), **options)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))


_ORACLE = """WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM q a, q b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER n AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW n AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER n <= 10"""

QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE = {"op12_hard_negatives": _ORACLE}
