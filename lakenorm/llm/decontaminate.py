"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words (A-Z lower-cased; a word is a run of digits,
letters a-z and characters beyond ASCII), and the words of the benchmark get
numbers, written as characters. Windows are ``WINDOW`` consecutive words of an
item (a shorter item is one window). The automaton holds every item once, cut
into chunks of ``(WINDOW + 1) // 2`` words: a window always holds a whole chunk. A
text, as the same characters, is scanned once; where a chunk is met, the words
around it are compared with those around the chunk in the items, and where both
sides add up to a window, those windows occur. Word numbers then give code point
offsets in the original text. A chunk that stands in many different
surroundings (the edge of a phrase that many items share) has its windows in a
table instead, so no match costs more than ``WINDOW`` look-ups or ``AROUND``
comparisons.

Memory: about 300 bytes per word of benchmark text at most, in words that are
all different. The benchmark is dealt into blocks of about ``BLOCK_BYTES`` by
hash (long items in parts that overlap by a window), each with its own automaton
and its own pass; the driver sees one block at a time, and the passes' hits are
written and merged by row. A large benchmark thus costs passes, not memory.
Texts are never shuffled.

Defined results: a null or wordless text has no words and is clean; a null or
wordless item has no window; an item without an id hits words and is not listed;
every document row, also with a null or repeated id, is a row with its own
result, whatever the size of the benchmark; an empty benchmark leaves all
documents clean.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, named, scratch, slices, stage, table

WINDOW = 13
BLOCK_BYTES = 8 << 20
PART_WORDS = 50_000             # words of a long item in one part
AROUND = 16                     # surroundings of a chunk that are compared one by one

#: Bytes to normalised bytes: separators become spaces, A-Z lower-case; UTF-8 of other characters stays.
_NORMAL = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
                for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def parts(item: list[bytes], size: int = WINDOW, limit: int = PART_WORDS) -> list[list[bytes]]:
    """The words of an item in runs of ``limit`` first words, each with the words
    that its last window still needs, so every window is in one run."""
    if not item:
        return []
    return [item[i:i + limit + size - 1] for i in range(0, max(1, len(item) - size + 1), limit)]


class Automaton:
    """All windows of some items ``(id, words)``."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int = WINDOW):
        import ahocorasick

        self.size, self.chunk = size, (size + 1) // 2
        code: dict[bytes, str] = {}
        self.owners: dict[str, set] = {}                # an item's words as characters -> ids
        for key, w in items:
            if w:
                flat = "".join([code.setdefault(x, chr(_point(len(code)))) for x in w])
                self.owners.setdefault(flat, set()).add(key)
        self.code = code.get
        places: dict[str, list | None] = {}             # chunk -> (item, place) where it stands
        short: dict[str, set] = {}
        for flat, keys in self.owners.items():
            if len(flat) < size:
                short.setdefault(flat, set()).update(keys)
                continue
            for at in range(0, len(flat) - self.chunk + 1, self.chunk):
                places.setdefault(flat[at:at + self.chunk], []).append((flat, at))
        self.trie = ahocorasick.Automaton()
        reach = size - self.chunk                       # words of a window beside its chunk
        for chunk, where in places.items():
            around: dict[tuple[str, str], set] = {}
            for flat, at in where:
                around.setdefault((flat[max(0, at - reach):at], flat[at + self.chunk:at + self.chunk + reach]), set()).update(self.owners[flat])
            if len(around) <= AROUND:
                self.trie.add_word(chunk, (len(chunk), [(x, y, tuple(k)) for (x, y), k in around.items()], None, short.pop(chunk, ())))
                continue
            table: dict[str, set] = {}
            for (left, right), keys in around.items():
                whole = left + chunk + right
                for i in range(len(whole) - size + 1):
                    table.setdefault(whole[i:i + size], set()).update(keys)
            self.trie.add_word(chunk, (len(chunk), (), table, short.pop(chunk, ())))
        for flat, keys in short.items():
            self.trie.add_word(flat, (len(flat), (), None, keys))
        if len(self.trie):
            self.trie.make_automaton()

    def __call__(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """(words of the text, merged hit intervals [from, to) in words, items)."""
        w = words(text)
        if not len(self.trie) or not w:
            return len(w), [], set()
        code = self.code
        flat = "".join([code(x, "\0") for x in w])
        found: list[tuple[int, int]] = []
        items: set = set()
        reach = self.size - self.chunk
        for end, (n, around, table, short) in self.trie.iter(flat):
            at, end = end + 1 - n, end + 1
            if short:
                found.append((at, end))
                items.update(short)
            for left, right, keys in around:
                x = y = 0
                while x < len(left) and x < at and flat[at - x - 1] == left[-x - 1]:
                    x += 1
                while y < len(right) and end + y < len(flat) and flat[end + y] == right[y]:
                    y += 1
                if x + n + y >= self.size:
                    found.append((at - x, end + y))
                    items.update(keys)
            if table is not None:
                for i in range(max(0, at - reach), at + 1):
                    keys = table.get(flat[i:i + self.size])
                    if keys:
                        found.append((i, i + self.size))
                        items.update(keys)
        return len(w), _merged(found), items


def _point(n: int) -> int:
    """The n-th word's character: any but 0, which stands for all other words, and surrogates."""
    return n + 1 if n + 1 < 0xD800 else n + 1 + 0x800


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals as code point intervals of the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


_HIT = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])


def item_parts(benchmark: DataFrame, size: int = WINDOW, limit: int = PART_WORDS) -> DataFrame:
    """``benchmark(id, text)`` -> ``(id string, text)``, normalised words by single
    spaces, long items in parts."""
    def batches(it):
        for b in it:
            out = [(k, " ".join([x.decode("utf-8", "surrogatepass") for x in p]))
                   for k, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()) for p in parts(words(t), size, limit)]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string())], ["id", "text"])
    return benchmark.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(batches, "id string, text string")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, n_words, n_hit, items array<string>, spans array<struct>)`` per document."""
    src = named(docs, id=id_column, text=text)
    spark = docs.sparkSession
    bounded_batches(spark)
    items = stage(item_parts(named(benchmark, id=item_id, text=item_text), window).distinct(), "benchmark-parts")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # half full on average, so that a block dealt by hash stays below its bound
    blocks = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType())),
                           T.StructField("spans", T.ArrayType(_HIT))])
    by_row = T.StructType([*schema.fields, T.StructField("row", T.StringType())])
    hit = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_word", pa.int64()),
                              ("last_word", pa.int64())]))

    def passing(rows, block, out):
        shared = spark.sparkContext.broadcast({"items": block})      # at most about BLOCK_BYTES

        def batches(it):
            held = shared.value         # one per worker, for as long as the broadcast lives there
            if "automaton" not in held:
                held["automaton"] = Automaton([(k, t.encode("utf-8", "surrogatepass").split()) for k, t in held["items"]], window)
            scan = held["automaton"]
            for b in slices(it, "text"):
                n, hits, keys, where = [], [], [], []
                for t in b.column("text").to_pylist():
                    count, spans, found = scan(t)
                    n.append(count)
                    hits.append(sum(y - x for x, y in spans))
                    keys.append(sorted(found - {None}))
                    where.append([{"start": s, "end": e, "first_word": x, "last_word": y - 1}
                                  for (x, y), (s, e) in zip(spans, offsets(t, spans) if spans else ())])
                cols = {"id": b.column("id"), "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hits, pa.int64()),
                        "items": pa.array(keys, pa.list_(pa.string())), "spans": pa.array(where, hit)}
                if "row" in out.names:
                    cols["row"] = b.column("row")
                yield pa.RecordBatch.from_arrays([cols[c] for c in out.names], out.names)

        return rows.mapInArrow(batches, out)

    fetch = lambda df: [(r.id, r.text) for r in df.collect()]  # noqa: E731  one block at a time
    if blocks == 1:
        return passing(src, fetch(items), schema)
    rows, dealt, found = src.withColumn("row", F.sha2("text", 256)), scratch(spark, "benchmark-blocks"), scratch(spark, "benchmark-hits")
    (items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
     .repartition("block").write.partitionBy("block").parquet(dealt))
    for k in range(blocks):
        block = fetch(spark.read.parquet(dealt).where(F.col("block") == k).select("id", "text"))
        out = passing(rows, block, by_row).withColumn("pass", F.lit(k))
        # the first pass writes every row, for its number of words
        (out.where("n_hit > 0") if k else out).write.mode("append").parquet(found)
    every = spark.read.schema(T.StructType([*by_row.fields, T.StructField("pass", T.IntegerType())])).parquet(found)
    merged = _merge_passes(every, by_row).withColumnsRenamed({"id": "_id", "row": "_row"})
    on = F.col("id").eqNullSafe(F.col("_id")) & F.col("row").eqNullSafe(F.col("_row"))
    return rows.select("id", "row").join(merged, on, "left").select(schema.names)


def _merge_passes(every: DataFrame, schema: T.StructType) -> DataFrame:
    """The passes' results in one row per id and text: hit intervals are merged,
    the items united. Equal rows count once per pass."""
    every = every.groupBy("id", "row", "pass").agg(*[F.first(c).alias(c) for c in ("n_words", "items", "spans")])

    def merge(it):
        for b in it:
            hits, where = [], []
            for spans in b.column("spans").to_pylist():
                merged: list[dict] = []
                for s in sorted(spans, key=lambda x: (x["first_word"], x["last_word"])):
                    if merged and s["first_word"] <= merged[-1]["last_word"] + 1:
                        if s["last_word"] > merged[-1]["last_word"]:
                            merged[-1] |= {"end": s["end"], "last_word": s["last_word"]}
                    else:
                        merged.append(dict(s))
                hits.append(sum(m["last_word"] - m["first_word"] + 1 for m in merged))
                where.append(merged)
            cols = {c: b.column(c) for c in ("id", "n_words", "items", "row")}
            yield pa.RecordBatch.from_arrays(
                [cols["id"], cols["n_words"], pa.array(hits, pa.int64()), cols["items"],
                 pa.array(where, b.column("spans").type), cols["row"]], schema.names)

    one = every.groupBy("id", "row").agg(
        F.max("n_words").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans")).select(schema.names)
    return one.mapInArrow(merge, schema)


def contaminated(n_hit, n_words):
    """The contract's rule: a twentieth of the words or more are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


QUERIES = {"op4_decontamination": op4_decontamination}

#: Words hit by a window, joined on the window's text.
ORACLE = {"op4_decontamination": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT id, i, n, item_id FROM dw JOIN bw USING (n, win)),
hw AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY id),
hi AS (SELECT id, count(*) AS n_items, sha256(string_agg(k, ',' ORDER BY k)) AS s FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (id) LEFT JOIN hi USING (id)"""}
