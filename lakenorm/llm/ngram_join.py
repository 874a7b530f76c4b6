"""N-gram Jaccard join over a count-vector R-tree.

A document's set is its distinct word n-grams (``Rule``: four words and a
similarity of 0.85 unless told otherwise), as 64-bit hashes. Hashing the
set's members into ``GROUPS`` groups and counting gives a point; for two sets
the sum of the coordinate minima bounds their overlap from above, and for a
tree node the sum of the minima with the node's coordinate maxima bounds it
for every point below. Links (``100 * overlap >= 85 * union``) are exact:

1. Sets that are equal form classes; from here on a class is one point, so a
   group of copies of any size costs one row.
2. Points are dealt to tiles. With the members of every set in one global
   order, two sets over the threshold share a member among their first
   ``n - ceil(0.85 n) + 1``; every such member that two classes share is a
   tile (tiles with the same classes count once). The order puts frequent members last (by a bounded sample of
   documents; the order changes only the cost, never the result), so a passage
   that a third of all documents hold makes no tile of that size.
3. Within a tile an R-tree answers, point by point, which points may still
   reach the threshold, from the top level down: a node is entered only if its
   coordinate maxima and size range allow a partner below. The search walks: points found leave the tree, so a
   tile emits a spanning forest of its "may link" graph, never its pairs.
4. The components of these forests hold every true link. Points of ``GROUPS``
   counts tell large sets apart badly (at 28 members a group, any two sets of a
   size come near the threshold), so components over ``BLOCK_MEMBERS`` are walked
   again by points with a group per ``LOAD`` members, in bands of sizes of which
   linked sets share at least one. What falls apart there shares no link.
5. The texts of what is left are brought together once per component, an R-tree
   proposes pairs and an exact intersection of the sets verifies them; again only
   a forest of true links is emitted, whose components are the result.

A tile or component over ``BLOCK`` is cut into blocks and every pair of blocks
is a task of its own, so no task grows with a group.

Defined results: null, empty and wordless texts have an empty set, linked with
nothing (component_id = doc_id); a null id keeps its row and links with
nothing; rows that share an id are one node; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHasher, bounded_batches, connected_components, mix64, named, pieces, slices, stage, table

GROUPS = 256
LOAD = 8                        # members per group, at most, of a fine point
PAGE = 32
FAN = 16                        # nodes below a node of the tree
#: Points of a tile, and set members of a component, that one task holds at once.
BLOCK, BLOCK_MEMBERS = 8192, 1 << 20
SAMPLE_DOCS, SAMPLE_LEAST, HOT_MOST = 4000, 4, 1 << 18
FILTER = 1 << 18

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SALT = np.random.default_rng(7).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted distinct hashes of the word n-grams of each text."""

    def __init__(self, size: int = 4):
        self.size, self.hasher = size, WordHasher(_SEP)

    def __call__(self, texts: list) -> list[np.ndarray]:
        out = []
        for _, part in pieces([(t or "").encode("utf-8", "surrogatepass") for t in texts]):
            h, start = self.hasher(b" ".join(part).translate(_LOWER))
            ends = np.cumsum([len(t) + 1 for t in part])
            stop = np.searchsorted(start, ends)
            k = self.size
            with np.errstate(over="ignore"):
                full = np.zeros(max(0, len(h) - k + 1), np.uint64)
                for j in range(k):
                    full += h[j:j + len(full)] * _SALT[j % 8]
                full = mix64(full)
                a = 0
                for b in stop:
                    if b - a >= k:
                        out.append(np.unique(full[a:b - k + 1]))
                    elif b > a:
                        short = (h[a:b] * _SALT[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                        out.append(mix64(np.array([short], np.uint64)))
                    else:
                        out.append(np.zeros(0, np.uint64))
                    a = b
        return out


@dataclass(frozen=True)
class Rule:
    """Sets of word ``size``-grams link when 100 * overlap >= percent * union."""
    size: int = 4
    percent: int = 85

    def needed(self, a, b):
        """Least overlap of linked sets of sizes a and b."""
        return (self.percent * (a + b) + 99 + self.percent) // (100 + self.percent)

    def sizes_fit(self, a, b):
        return (100 * a >= self.percent * b) & (100 * b >= self.percent * a)

    def least_partner(self, n):
        return -(-self.percent * n // 100)


RULE = Rule()


def count_vector(members: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Members per group; a count over 255 is cut, and the rest is what the set's
    size exceeds the sum by (``bound`` adds it)."""
    c = np.bincount((members >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)
    return np.minimum(c, 255).astype(np.uint8)


def fine_vector(members: np.ndarray) -> np.ndarray:
    """Count vector whose groups grow with the set, by powers of two."""
    groups = GROUPS
    while len(members) > LOAD * groups:
        groups *= 2
    return count_vector(members, groups)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point with fewer groups; counts over 255 are cut as in ``count_vector``."""
    return np.minimum(point.reshape(-1, groups).sum(axis=0, dtype=np.int64), 255).astype(np.uint8)


def cut_off(points: np.ndarray, sizes):
    return sizes - points.sum(axis=-1, dtype=np.int64)


def bound(q: np.ndarray, q_size: int, points: np.ndarray, sizes: np.ndarray, rest: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Which points may reach the threshold with q: summed coordinate minima,
    and half of what was cut off on either side."""
    most = 2 * np.minimum(points, q).sum(axis=1, dtype=np.int64) + rest + cut_off(q, q_size)
    return most >= 2 * rule.needed(q_size, sizes)


@dataclass
class Level:
    """Nodes of one level of the tree, in order; node i is below node i // FAN."""
    top: np.ndarray             # coordinate maxima
    low: np.ndarray             # sizes from
    high: np.ndarray            # to
    rest: np.ndarray            # largest part cut off
    left: np.ndarray            # points not taken out


class CountRTree:
    """R-tree over count vectors: points are split along the coordinate of the
    largest spread until they fit a page; pages that are neighbours are one node
    of the level above, up to a root level of ``FAN`` nodes. Every node keeps its
    coordinate maxima and size range. Points can be taken out."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rule: Rule = RULE):
        self.points, self.sizes, self.rule = points, sizes, rule
        self.alive = np.ones(len(sizes), bool)
        leaves, todo = [], [np.arange(len(sizes))]
        while todo:
            ids = todo.pop()
            if len(ids) <= PAGE:
                leaves.append(ids)
                continue
            spread = points[ids].std(axis=0)
            axis = int(spread.argmax())
            key = sizes[ids] if sizes[ids].std() > 4 * spread[axis] else points[ids, axis]
            order = ids[np.argsort(key, kind="stable")]
            half = len(order) // 2
            todo += [order[:half], order[half:]]
        self.leaves = leaves
        self.page = np.empty(len(sizes), np.int64)
        for i, ids in enumerate(leaves):
            self.page[ids] = i
        self.rest = cut_off(points, sizes)
        self.levels = [Level(np.array([points[x].max(axis=0) for x in leaves]), np.array([sizes[x].min() for x in leaves]),
                             np.array([sizes[x].max() for x in leaves]), np.array([self.rest[x].max() for x in leaves]),
                             np.array([len(x) for x in leaves]))]
        while len(self.levels[-1].left) > FAN:
            below = self.levels[-1]
            first = np.arange(0, len(below.left), FAN)
            self.levels.append(Level(np.maximum.reduceat(below.top, first), np.minimum.reduceat(below.low, first),
                                     np.maximum.reduceat(below.high, first), np.maximum.reduceat(below.rest, first),
                                     np.add.reduceat(below.left, first)))

    def take(self, ids) -> None:
        self.alive[ids] = False
        node = self.page[ids]
        for level in self.levels:
            np.subtract.at(level.left, node, 1)
            node = node // FAN

    def query(self, i: int) -> np.ndarray:
        """Living points that may reach the threshold with point i."""
        n, q, rule = int(self.sizes[i]), self.points[i], self.rule
        least = rule.least_partner(n)
        nodes = np.arange(len(self.levels[-1].left))
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            nodes = nodes[(level.left[nodes] > 0) & (level.high[nodes] >= least) & (100 * n >= rule.percent * level.low[nodes])]
            if len(nodes):
                nodes = nodes[bound(q, n, level.top[nodes], np.maximum(level.low[nodes], least), level.rest[nodes], rule)]
            if not len(nodes):
                return np.zeros(0, np.int64)
            if depth:
                nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1].left)]
        ids = np.concatenate([self.leaves[x] for x in nodes])
        ids = ids[self.alive[ids]]
        ids = ids[rule.sizes_fit(self.sizes[ids], n)]
        return ids[bound(q, n, self.points[ids], self.sizes[ids], self.rest[ids], rule)]


def forest(points: np.ndarray, sizes: np.ndarray, sets: list | None = None, rule: Rule = RULE) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph whose edges pass the bound and,
    where sets are given, the exact threshold. Found points leave the tree."""
    tree, edges, queue = CountRTree(points, sizes, rule), [], []
    for seed in range(len(sizes)):
        if not tree.alive[seed]:
            continue
        tree.take([seed])
        queue.append(seed)
        while queue:
            i = queue.pop()
            found = tree.query(i)
            if sets is not None and len(found):
                found = found[verify(sets, i, found, rule)]
            if len(found):
                tree.take(found)
                edges += [(i, int(j)) for j in found]
                queue += found.tolist()
    return edges


def verify(sets: list, i: int, others: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Which of the sets are over the threshold with set i, exactly."""
    mine, out = sets[i], np.zeros(len(others), bool)
    for lo in range(0, len(others), 256):
        part = others[lo:lo + 256]
        sizes = np.array([len(sets[j]) for j in part])
        every = np.concatenate([sets[j] for j in part])
        at = np.searchsorted(mine, every)
        same = mine[np.minimum(at, len(mine) - 1)] == every
        overlap = np.add.reduceat(same.astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
        out[lo:lo + 256] = overlap >= rule.needed(len(mine), sizes)
    return out


# ----------------------------------------------------------------- dataflow

def _hot_order(src: DataFrame, rule: Rule) -> np.ndarray:
    """Members seen in at least SAMPLE_LEAST of about SAMPLE_DOCS documents, most
    frequent first; at most HOT_MOST of them, so the broadcast has a fixed bound."""
    rows = src.count()

    def counts(it):
        shingle = Shingler(rule.size)
        for b in slices(it, "text"):
            sets = shingle(b.column("text").to_pylist())
            u, c = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], ["m", "c"])

    some = src.sample(fraction=min(1.0, SAMPLE_DOCS / max(1, rows)), seed=11).distinct()
    hot = (some.select("text").mapInArrow(counts, "m long, c long").groupBy("m").agg(F.sum("c").alias("c"))
           .where(F.col("c") >= SAMPLE_LEAST).orderBy(F.desc("c"), "m").limit(HOT_MOST).select("m").collect())
    return np.array([r.m for r in hot], np.int64).view(np.uint64)


def _first_members(s: np.ndarray, hot: np.ndarray, rank: np.ndarray, rule: Rule) -> np.ndarray:
    """The members that every partner shares one of: rare before frequent."""
    n = len(s)
    keep = n - rule.least_partner(n) + 1
    if len(hot) and n:
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        r = np.where(hot[at] == s, rank[at], 0)
        s = s[np.argsort(r, kind="stable")]
    return s[:keep]


def features(src: DataFrame, rule: Rule = RULE) -> DataFrame:
    """``(id, n, digest, keys, point, fine)`` of every document; ``fine`` is null
    where it would be ``point``."""
    hottest = _hot_order(src, rule)
    shared = src.sparkSession.sparkContext.broadcast(hottest)

    def batches(it):
        shingle = Shingler(rule.size)
        order = np.argsort(shared.value)
        hot, rank = shared.value[order], (len(order) - order).astype(np.int64)   # the most frequent has the highest
        for b in slices(it, "text"):
            sets = shingle(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([_first_members(s, hot, rank, rule).view(np.int64) if len(s) else [] for s in sets],
                          pa.list_(pa.int64())),
                 pa.array([count_vector(s).tobytes() for s in sets], pa.binary()),
                 pa.array([fine_vector(s).tobytes() if len(s) > LOAD * GROUPS else None for s in sets], pa.binary())],
                ["id", "n", "digest", "keys", "point", "fine"])

    return src.mapInArrow(batches, f"id {src.schema['id'].dataType.simpleString()}, n long, digest binary, "
                                   "keys array<long>, point binary, fine binary")


def blocks(df: DataFrame, group: str, weight: str, limit: int, node: str, own: str = "_own") -> DataFrame:
    """Adds the task ``(g, i, j)`` of each row: a group whose weight exceeds the
    limit is dealt into blocks by node (column ``own``), and every pair of
    blocks is a task."""
    parts = F.greatest(F.lit(1), F.ceil(F.col(weight) / F.lit(limit))).cast("int")
    mine = F.pmod(F.xxhash64(node), F.col("_parts")).cast("int")
    return (df.withColumn("_parts", parts).withColumn(own, mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
            .withColumn("g", F.col(group)).withColumn("i", F.least(own, "_other"))
            .withColumn("j", F.greatest(own, "_other")).drop("_parts", "_other"))


def tiles_of(keyed: DataFrame, label: str) -> DataFrame:
    """``keyed(key, rep)`` -> ``(key, c, rep)`` of the keys with several members;
    of keys with the same members only one. Keys are counted by an aggregate, so
    no task holds a hot key."""
    h = F.xxhash64("rep")
    sets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 16)).alias("s"),
                                    F.min("rep").alias("m")).where("c > 1")
    # two sets are taken for one only if size, least member and two sums of hashes agree
    one = stage(sets.groupBy("c", "x", "s", "m").agg(F.min("key").alias("key_")), label)
    return keyed.join(one.select("key_", "c"), F.col("key") == F.col("key_")).select("key", "c", "rep")


def by_task(it, keys=("g", "i", "j")):
    """Runs of batches -> one Arrow table per task, rows sorted by task."""
    held: list = []
    last = None
    for b in it:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        edges = [0, *cut.tolist(), b.num_rows]
        for x, y in zip(edges[:-1], edges[1:]):
            key = tuple(c[x] for c in cols)
            if held and key != last:
                done, held = [pa.Table.from_batches(held)], []
                yield done.pop()                # the reader alone holds it
            held.append(b.slice(x, y - x))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _tile_edges(rule: Rule):
    """Forests of all tiles of a partition. Tiles of two to four points, by far
    the most, are compared together."""
    def run(it):
        small: list = []

        def flush():
            if not small:
                return None
            a, b = [], []
            ids = np.concatenate([x[0] for x in small])
            pts = np.concatenate([x[1] for x in small])
            n = np.concatenate([x[2] for x in small])
            at = 0
            for x in small:
                m = len(x[0])
                for p in range(m):
                    for q in range(p):
                        a.append(at + p)
                        b.append(at + q)
                at += m
            small.clear()
            a, b = np.array(a), np.array(b)
            rest = cut_off(pts, n)
            most = 2 * np.minimum(pts[a], pts[b]).sum(axis=1, dtype=np.int64) + rest[a] + rest[b]
            ok = most >= 2 * rule.needed(n[a], n[b])
            e = np.unique(np.stack([np.maximum(ids[a], ids[b])[ok], np.minimum(ids[a], ids[b])[ok]]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1])], ["a", "b"])

        seen: set = set()
        for t in by_task(it):
            ids = t.column("rep").to_numpy()
            if len(ids) < 2:
                continue
            order = np.argsort(ids)
            key = hashlib.blake2b(ids[order].tobytes(), digest_size=12).digest()
            if key in seen:           # families share most of their tiles
                continue
            if len(seen) < 200_000:
                seen.add(key)
            pts = np.frombuffer(b"".join(t.column("point").to_pylist()), np.uint8).reshape(len(ids), -1)[order]
            n = t.column("n").to_numpy()[order]
            ids = ids[order]
            if len(ids) <= 4:
                small.append((ids, pts, n))
                if len(small) >= 4096:
                    yield flush()
                continue
            e = forest(pts, n, rule=rule)
            if e:
                yield pa.RecordBatch.from_arrays([pa.array(ids[[x for x, _ in e]]), pa.array(ids[[y for _, y in e]])],
                                                 ["a", "b"])
        last = flush()
        if last is not None:
            yield last
    return run


def _fine_edges(rule: Rule):
    """Forests by fine points; those of a task, a band of sizes, are folded to the
    fewest groups among them."""
    def run(it):
        for t in by_task(it):
            ids = t.column("rep").to_numpy()
            if len(ids) < 2:
                continue
            raw = [np.frombuffer(p, np.uint8) for p in t.column("fine").to_pylist()]
            groups = min(map(len, raw))
            e = forest(np.array([folded(p, groups) for p in raw]), t.column("n").to_numpy(), rule=rule)
            if e:
                yield pa.RecordBatch.from_arrays([pa.array(ids[[x for x, _ in e]]), pa.array(ids[[y for _, y in e]])],
                                                 ["a", "b"])
    return run


def refine(near: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``near(node, component)`` with the components over ``BLOCK_MEMBERS`` set members
    walked again by fine points; nodes that may link with nothing go."""
    points = classes.select(F.col("rep").alias("node"), "n", F.coalesce("fine", "point").alias("fine"))
    large = near.join(points.select("node", "n"), "node").groupBy("component").agg(F.sum("n").alias("w"))
    large = stage(large.where(F.col("w") > BLOCK_MEMBERS).select("component"), "jaccard-large")
    if large.isEmpty():
        return near
    # partners differ by less than a band's width, so a set meets them in its own band or a neighbour's
    width = math.log(100 / (rule.percent - 0.5))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    rows = (near.join(large, "component", "left_semi").join(points, "node")
            .withColumn("band", F.explode(F.array(band, band + 1))))
    weights = rows.groupBy("component", "band").agg(F.sum(F.octet_length("fine")).alias("w")).where(F.count(F.lit(1)) > 1)
    rows = rows.join(stage(weights, "jaccard-bands"), ["component", "band"])
    rows = rows.withColumn("key", F.xxhash64("component", "band")).withColumnRenamed("node", "rep")
    tasks = blocks(rows, "key", "w", BLOCK * GROUPS, "rep").select("g", "i", "j", "rep", "n", "fine")
    maybe = (tasks.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "rep")
             .mapInArrow(_fine_edges(rule), "a long, b long"))
    finer = connected_components(maybe, "jaccard-finer").select("node", "component")
    return stage(near.join(large, "component", "left_anti").select("node", "component").unionByName(finer), "jaccard-near")


def _true_edges(rule: Rule):
    def run(it):
        shingle = Shingler(rule.size)
        for t in by_task(it):
            ids = t.column("rep").to_numpy()
            if len(ids) < 2:
                continue
            sets = [s for b in slices(t.to_batches(), "text") for s in shingle(b.column("text").to_pylist())]
            del t
            points = np.array([count_vector(s) for s in sets])
            e = forest(points, np.array([len(s) for s in sets], np.int64), sets, rule)
            if e:
                yield pa.RecordBatch.from_arrays([pa.array(ids[[x for x, _ in e]]), pa.array(ids[[y for _, y in e]])],
                                                 ["a", "b"])
    return run


def _may_be_in(src: DataFrame, members: DataFrame) -> DataFrame:
    """Rows whose id may be a member's, by a filter of fixed size: at most
    ``FILTER`` hash values are broadcast. It only spares texts a shuffle; the
    join that follows decides."""
    of = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(FILTER))
    some = members.select(of("rep").cast("int").alias("_f")).distinct()
    return src.join(F.broadcast(some), of("id").cast("int") == F.col("_f"), "left_semi")


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """``(id, n_shingles, class_id, component_id)`` per input row. ``class_id`` is
    the smallest id with the same set, ``component_id`` the smallest reachable."""
    bounded_batches(docs.sparkSession)
    src = named(docs, id=id_column, text=text)
    feats = stage(features(src, rule), "jaccard-features", "snappy")
    sets = feats.where("n > 0 and id is not null").groupBy("n", "digest")
    classes = stage(sets.agg(F.min("id").alias("rep"), F.first("point").alias("point"), F.first("fine").alias("fine")),
                    "jaccard-classes")

    keyed = sets.agg(F.min("id").alias("rep"), F.first("keys").alias("keys")).select(F.explode("keys").alias("key"), "rep")
    tiles = tiles_of(stage(keyed, "jaccard-keys"), "jaccard-tiles")
    tiles = blocks(tiles.join(classes.select("rep", "n", "point"), "rep"), "key", "c", BLOCK, "rep")
    maybe = (tiles.select("g", "i", "j", "rep", "n", "point").repartition("g", "i", "j")
             .sortWithinPartitions("g", "i", "j").mapInArrow(_tile_edges(rule), "a long, b long"))
    near = refine(stage(connected_components(maybe, "jaccard-maybe"), "jaccard-near"), classes, rule)

    sizes = classes.select(F.col("rep").alias("node"), "n")
    weights = near.join(sizes, "node").groupBy("component").agg(F.sum("n").alias("w"))
    members = near.join(weights, "component").select("component", "w", F.col("node").alias("rep"))
    texts = (_may_be_in(src.where("text is not null"), members).join(members, F.col("id") == F.col("rep"))
             .select("component", "w", "rep", "text"))
    tasks = blocks(texts, "component", "w", BLOCK_MEMBERS, "rep").select("g", "i", "j", "rep", "text")
    linked = (tasks.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "rep")
              .mapInArrow(_true_edges(rule), "a long, b long"))
    found = connected_components(linked, "jaccard-links")

    named_classes = classes.select("n", "digest", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("n").alias("cn"), F.col("digest").alias("cd"), "rep", F.coalesce("component", "rep").alias("component"))
    return feats.join(named_classes, (F.col("n") == F.col("cn")) & (F.col("digest") == F.col("cd")), "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("class_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id")


QUERIES = {"op6_ngram_jaccard": op6_ngram_jaccard}
ORACLE: dict[str, str] = {}
