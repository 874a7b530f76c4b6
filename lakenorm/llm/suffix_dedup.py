"""Exact repeated passages by two-stage suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else in
the input goes. A suffix array over all text at once would be several times the
input, so text that cannot repeat is set aside first:

1. Anchors. Each ``LENGTH``-byte window is assigned to its anchor, the
   ``GRAM``-byte gram in it with the smallest hash (the leftmost of ties). Equal
   windows have equal anchors at equal places, so windows need only be compared
   among those of one anchor. The windows of one anchor are consecutive and
   make a segment. Per slice of a batch, segments of equal content are found at once:
   their windows repeat for sure, and one of them stands for all from here on,
   so a passage that a third of all documents hold is one row per slice.
2. Per anchor, segments of equal content repeat as a whole. Only anchors whose
   segments differ, the edges of shared passages, go on; their bytes are cut
   from the documents.
3. Hot anchors. The edges of a passage that a third of all documents hold are
   all different and have one anchor. An anchor with more than ``TEXT`` bytes is
   split: its windows are dealt by their place relative to the anchor, and all
   windows of a range share more bytes than the gram, which are the new key.
   Narrower ranges share more, down to one window, whose key is all its bytes;
   pieces of equal content repeat as a whole at every step, and what shares its
   key with nothing is done. So no task ever holds a hot anchor, and no segment
   is compared with others that cannot match it.
4. Suffix array. Many anchors' segments make one text of about ``TEXT`` bytes.
   Two-stage sorting: the suffixes smaller than their successors are sorted
   directly, bucket by bucket, to a depth of ``LENGTH``; all others are induced
   by scanning the buckets in order. Windows whose common prefix with a
   neighbour in the array reaches ``LENGTH`` repeat.

Memory of a task: ``SLICE`` bytes of text, or one long text, and about forty bytes
per byte of a sorted one.

Defined results: a null text is empty; texts shorter than ``LENGTH`` are kept;
rows are told apart by id and the MD5 of the text, so null and repeated ids are fine, and
rows that repeat as a whole are each other's copies; an empty table gives no
rows. Positions are bytes of the UTF-8 text, ends exclusive.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import STEP, bounded_batches, named, slices, stage, table, word_sums

LENGTH = 400
GRAM = 128
TEXT = 1 << 20
SLICE = 8 << 20                 # text of a batch that a worker holds at once
FILTER = 1 << 18
RANGES = (69, 18, 5, 1)         # windows of a range, step by step, when a hot anchor is split


# ------------------------------------------------------------------- anchors

def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Per run of texts: (gram hash, segment content, text number, first window,
    number of windows, place of the gram behind the first window's start) of
    every segment, as arrays and a list of bytes."""
    width = length - gram + 1
    parts = [(i, x, t[x:x + STEP + length - 1]) for i, t in enumerate(texts)
             for x in range(0, len(t) - length + 1, STEP)]
    at = 0
    while at < len(parts):
        run, size = [], 0
        while at < len(parts) and (not run or size + len(parts[at][2]) <= 2 * STEP):
            run.append(parts[at])
            size += len(parts[at][2])
            at += 1
        buf = b"".join(p for _, _, p in run)
        sums, inverse = word_sums(np.frombuffer(buf, np.uint8))
        with np.errstate(over="ignore"):
            h = (sums[gram:] - sums[:-gram]) * inverse[:size - gram + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x9E3779B97F4A7C15)
        # smallest hash first, then leftmost: the low 24 bits hold the place
        low = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        least = low
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        n = len(low) - width + 1
        place = (np.minimum(least[:n], least[width - span:width - span + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
        lens = np.array([len(p) for _, _, p in run])
        begin = np.cumsum(lens) - lens
        windows = lens - length + 1
        start = np.arange(windows.sum()) + np.repeat(begin - (np.cumsum(windows) - windows), windows)
        owner = np.repeat(np.arange(len(run)), windows)
        place = place[start]
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
        count = np.diff(np.append(first, len(start)))
        lo = start[first]
        segments = [buf[a:a + c + length - 1] for a, c in zip(lo.tolist(), count.tolist())]
        o = owner[first]
        numbers = np.array([i for i, _, _ in run])[o]
        offsets = np.array([x for _, x, _ in run])[o] + lo - begin[o]
        yield h[place[first]].view(np.int64), segments, numbers, offsets, count, place[first] - lo


_SEGMENT = "key long, content long, id {id}, rk binary, lo long, n long, gram long, many boolean, sure boolean"


def segments(src: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of ``src(id, rk, text)``. ``sure``: repeats within its batch, a
    result; otherwise a candidate, which stands for several if ``many``."""
    names = ["key", "content", "id", "rk", "lo", "n", "gram", "many", "sure"]

    def batches(it):
        for b in slices(it, "text", SLICE):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            cols: list[list] = [[], [], [], [], [], []]
            for key, bytes_, number, lo, n, at in anchors(texts, length, gram):
                content = np.frombuffer(b"".join(hashlib.blake2b(s, digest_size=8).digest() for s in bytes_), np.int64)
                for c, x in zip(cols, (key, content, number, lo, n, at)):
                    c.append(x)
            if not cols[0]:
                continue
            key, content, number, lo, n, at = map(np.concatenate, cols)
            order = np.lexsort((content, key))
            new = np.append(True, (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1]))
            size = np.diff(np.append(np.flatnonzero(new), len(order)))
            many = np.repeat(size > 1, size)
            # all members of a group of several are sure; its first is also a candidate
            pick = np.concatenate([order[many], order[new]])
            sure = np.concatenate([np.ones(many.sum(), bool), np.zeros(new.sum(), bool)])
            several = np.concatenate([np.ones(many.sum(), bool), size > 1])
            take = pa.array(number[pick])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[pick]), pa.array(content[pick]), b.column("id").take(take), b.column("rk").take(take),
                 pa.array(lo[pick]), pa.array(n[pick]), pa.array(at[pick]), pa.array(several), pa.array(sure)], names)

    return src.mapInArrow(batches, _SEGMENT.format(id=src.schema["id"].dataType.simpleString()))


# -------------------------------------------------------------- suffix array

def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes of a byte text, ordered by their first ``depth`` bytes."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    raw = text.tobytes()
    # smaller than its successor: the next different byte is larger
    up = text[:-1] < text[1:]
    known = np.append(text[:-1] != text[1:], True)
    decides = np.minimum.accumulate(np.where(known, np.arange(n), n)[::-1])[::-1]
    small = np.append(up, False)[decides]

    # first stage: sort those directly, in buckets of two bytes
    first = np.flatnonzero(small)
    pair = text[first].astype(np.uint16) << 8 | text[np.minimum(first + 1, n - 1)]
    order = np.argsort(pair, kind="stable")
    first, pair = first[order], pair[order]
    cut = np.append(np.flatnonzero(np.append(True, pair[1:] != pair[:-1])), len(first)) if len(first) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a > 1:
            at = first[a:b].tolist()
            at.sort(key=lambda i: raw[i:i + depth])
            first[a:b] = at
    small_of = np.searchsorted(text[first], np.arange(257)) if len(first) else np.zeros(257, np.int64)

    # second stage: scan the buckets; the predecessor of a suffix, if larger than
    # it, is next in the bucket of its own first byte
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    pending[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        rounds = pending[c]
        cur = np.concatenate(rounds) if rounds else np.zeros(0, np.int64)
        larger = [cur]
        while len(cur):                     # runs of one byte fill their own bucket
            prev = cur[cur > 0] - 1
            cur = prev[(text[prev] == c) & ~small[prev]]
            larger.append(cur)
        bucket = np.concatenate([*larger, first[small_of[c]:small_of[c + 1]]])
        pending[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        prev = bucket[bucket > 0] - 1
        prev = prev[(text[prev] > c) & ~small[prev]]
        if len(prev):
            byte = text[prev]
            by = np.argsort(byte, kind="stable")
            prev, byte = prev[by], byte[by]
            edge = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
            for a, part in zip(edge, np.split(prev, edge[1:])):
                pending[byte[a]].append(part)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes a[i] and b[i], at most
    ``depth``, in steps of eight bytes (the rest is compared by bytes)."""
    pad = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(pad, 8)
    lcp, left = np.zeros(len(a), np.int64), np.arange(len(a))
    for at in range(0, depth, 8):
        if not len(left):
            break
        same = words[a[left] + at] == words[b[left] + at]
        run = np.where(same.all(axis=1), 8, same.argmin(axis=1))
        lcp[left] += run
        left = left[run == 8]
    return np.minimum(lcp, depth)


def repeated(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, which of its windows occur elsewhere in any of them."""
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)      # 0xFF never occurs in UTF-8
    lens = np.array([len(p) for p in parts])
    begin = np.cumsum(lens + 1) - lens - 1
    windows = np.maximum(lens - length + 1, 0)
    valid = np.zeros(len(text), bool)
    valid[np.arange(windows.sum()) + np.repeat(begin - (np.cumsum(windows) - windows), windows)] = True
    order = suffix_array(text, length)
    near = np.flatnonzero(valid[order[:-1]] & valid[order[1:]])
    a, b = order[near], order[near + 1]
    hit = common_prefixes(text, a, b, length) >= length
    found = np.zeros(len(text), bool)
    found[a[hit]] = found[b[hit]] = True
    return [found[x:x + w] for x, w in zip(begin.tolist(), windows.tolist())]


# ------------------------------------------------------------------ dataflow

_SPAN = "id {id}, rk binary, a long, b long"
_ROW = "key long, id {id}, rk binary, lo long, n long, gram long, all boolean, bytes binary"


def _cut(length: int):
    """Requested segments of a document -> one row each, with its bytes."""
    def run(it):
        for b in slices(it, "text", SLICE):
            rows, raw, number = [], [], []
            for i, (t, want) in enumerate(zip(b.column("text").to_pylist(), b.column("want").to_pylist())):
                t = t.encode("utf-8", "surrogatepass")
                for w in want:
                    rows.append(w)
                    raw.append(t[w["lo"]:w["lo"] + w["n"] + length - 1])
                    number.append(i)
            take = pa.array(number, pa.int64())
            long = lambda c: pa.array([w[c] for w in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [long("key"), b.column("id").take(take), b.column("rk").take(take), long("lo"), long("n"), long("gram"),
                 pa.array([w["all"] for w in rows], pa.bool_()), pa.array(raw, pa.binary())],
                ["key", "id", "rk", "lo", "n", "gram", "all", "bytes"])
    return run


def _split(length: int, width: int, most: int):
    """Segments of hot anchors -> pieces of ``width`` places relative to the gram.
    A window that starts ``k`` bytes before the gram belongs to range ``k // width``;
    the bytes that all windows of the range have in common name the new anchor."""
    def run(it):
        for b in it:
            out, number = [], []
            for i, (key, lo, n, at, raw) in enumerate(zip(*[b.column(c).to_pylist() for c in ("key", "lo", "n", "gram", "bytes")])):
                for r in range((at - n + 1) // width, at // width + 1):
                    first, last = max(0, at - min((r + 1) * width - 1, most)), min(n - 1, at - r * width)     # windows of the piece
                    core = raw[at - r * width:at - min((r + 1) * width - 1, most) + length]
                    piece = raw[first:last + length]
                    mark = lambda *x: int.from_bytes(hashlib.blake2b(b"".join(x), digest_size=8).digest(), "little", signed=True)
                    out.append((mark(key.to_bytes(8, "little", signed=True), r.to_bytes(4, "little"), core), mark(piece),
                                lo + first, last - first + 1, at - first, piece))
                    number.append(i)
            cols, take = list(zip(*out)) or [()] * 6, pa.array(number, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), b.column("id").take(take), b.column("rk").take(take),
                 *[pa.array(c, pa.int64()) for c in cols[2:5]], b.column("all").take(take), pa.array(cols[5], pa.binary())],
                ["key", "content", "id", "rk", "lo", "n", "gram", "all", "bytes"])
    return run


def _sorted_texts(length: int):
    """Rows in order of anchors -> spans of the windows that repeat. Anchors are put
    together to texts of about ``TEXT`` bytes; an anchor is never cut."""
    def spans(rows):
        hit = repeated([r[4] for r in rows], length)
        out = []
        for (ident, rk, lo, whole, _), h in zip(rows, hit):
            if whole or not h.any():
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([0], h.view(np.int8), [0]))))
            out += [(ident, rk, lo + int(x), lo + int(y) - 1 + length) for x, y in zip(edge[::2], edge[1::2])]
        return out

    def run(it):
        rows, size, last = [], 0, None
        for b in it:
            kind = b.column("id").type

            def batch(found):
                cols = list(zip(*found)) or [(), (), (), ()]
                return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.binary()),
                                                   pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                                  ["id", "rk", "a", "b"])
            for key, *row in zip(*[b.column(c).to_pylist() for c in ("key", "id", "rk", "lo", "all", "bytes")]):
                if rows and key != last and size >= TEXT:
                    yield batch(spans(rows))
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4]) + 1
                last = key
        if rows:
            yield batch(spans(rows))
    return run


def _equal_contents(rows: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows(key, content, all, ...)``, a row with ``all`` standing for several:
    the rows whose content occurs twice or more, not counting those known
    (``all``); and a row per content of the keys that have several contents."""
    each = rows.groupBy("key", "content").agg(F.sum(F.when(F.col("all"), 2).otherwise(1)).alias("c"),
                                              F.first(F.struct(*keep)).alias("rep"))
    each = stage(each, "suffix-contents")
    twice = each.where("c > 1").select(F.col("key").alias("_k"), F.col("content").alias("_c"))
    spans = rows.where("not all").join(twice, (F.col("key") == F.col("_k")) & (F.col("content") == F.col("_c")), "left_semi")
    mixed = each.groupBy("key").agg(F.min("content").alias("x"), F.max("content").alias("y")).where("x <> y").select(F.col("key").alias("_k"))
    reps = each.join(mixed, F.col("key") == F.col("_k"), "left_semi").select("key", "rep.*", (F.col("c") > 1).alias("all"))
    return spans, reps


def _may_be_in(src: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose (id, rk) may be among ``ids``: a filter of at most ``FILTER``
    hash values is broadcast. The join that follows decides."""
    of = F.pmod(F.xxhash64("id", "rk"), F.lit(FILTER)).cast("int")
    return src.join(F.broadcast(ids.select(of.alias("_f")).distinct()), of == F.col("_f"), "left_semi")


def repeated_spans(src: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``src(id, rk, text)`` -> ``(id, rk, spans array<struct<a, b>>)``: byte
    intervals, possibly overlapping, of the rows that hold repeated windows."""
    id_name = src.schema["id"].dataType.simpleString()
    found = stage(segments(src, length, gram), "suffix-segments")
    c = found.where("not sure").drop("sure").withColumnRenamed("many", "all")
    # most anchors have one segment: they are done
    met = c.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("all").alias("m")).where("n > 1 or m").select(F.col("key").alias("_k"))
    c = stage(c.join(met, F.col("key") == F.col("_k"), "left_semi"), "suffix-candidates")
    place = ["id", "rk", "lo", "n", "gram"]
    again, reps = _equal_contents(c, place)
    ranges = lambda df: df.select("id", "rk", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + F.lit(length - 1)).alias("b"))
    every = [ranges(found.where("sure")), ranges(again)]

    wanted = reps.groupBy("id", "rk").agg(F.collect_list(F.struct("key", "lo", "n", "gram", "all")).alias("want"))
    wanted = stage(wanted.select(F.col("id").alias("_id"), F.col("rk").alias("_rk"), "want"), "suffix-wanted")
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("rk") == F.col("_rk"))
    some = _may_be_in(src.where("text is not null"), wanted.select(F.col("_id").alias("id"), F.col("_rk").alias("rk")))
    # a row that occurs several times is cut once
    texts = some.join(wanted, on).select("id", "rk", "text", "want").dropDuplicates(["id", "rk"])
    rows = stage(texts.mapInArrow(_cut(length), _ROW.format(id=id_name)), "suffix-cut")

    ready = []
    for width in (*RANGES, None):
        hot = rows.groupBy("key").agg(F.sum(F.octet_length("bytes") + 1).alias("size")).where(F.col("size") > TEXT)
        hot = stage(hot.select(F.col("key").alias("_k")), "suffix-hot")
        if width is None or hot.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(hot, F.col("key") == F.col("_k"), "left_anti"))
        pieces = stage(rows.join(hot, F.col("key") == F.col("_k"), "left_semi")
                       .mapInArrow(_split(length, width, length - gram), _ROW.format(id=id_name).replace("key long", "key long, content long")), "suffix-pieces")
        again, reps = _equal_contents(pieces, [*place, "bytes"])
        every.append(ranges(again))
        rows = stage(reps.select("key", *place, "all", "bytes"), "suffix-cut")
    order = reduce(DataFrame.unionByName, ready).repartition("key").sortWithinPartitions("key", "id", "lo")
    every.append(order.select("key", "id", "rk", "lo", "all", "bytes").mapInArrow(_sorted_texts(length), _SPAN.format(id=id_name)))
    spans = reduce(DataFrame.unionByName, every)
    return stage(spans.groupBy("id", "rk").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "suffix-spans")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """``(id, n_bytes, spans array<struct<a, b>>, kept binary)`` per input row:
    the removed byte intervals, maximal and in order, and the remaining bytes."""
    bounded_batches(docs.sparkSession)
    src = named(docs, id=id_column, text=text).withColumn("rk", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    spans = repeated_spans(src, length, gram).select(F.col("id").alias("_id"), F.col("rk").alias("_rk"), "spans")
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("rk") == F.col("_rk"))
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def batches(it):
        for b in slices(it, "text", SLICE):
            size, where, kept = [], [], []
            for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for x, y in sorted((p["a"], p["b"]) for p in s or ()):
                    if merged and x <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], y)
                    else:
                        merged.append([x, y])
                edges = [0, *[e for m in merged for e in m], len(raw)]
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
                size.append(len(raw))
                where.append([{"a": x, "b": y} for x, y in merged])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size, pa.int64()), pa.array(where, span),
                                              pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    joined = src.join(spans, on, "left").select("id", "text", "spans")
    return joined.mapInArrow(batches, f"id {src.schema['id'].dataType.simpleString()}, n_bytes long, "
                                      "spans array<struct<a: long, b: long>>, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeats(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                    F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE: dict[str, str] = {}
