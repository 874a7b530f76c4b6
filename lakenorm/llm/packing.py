"""Lexical retrieval packing.

1. Texts become token ids (a byte-level BPE vocabulary given by path), closed by
   an end id, and a routing key: the smallest hash among the text's token
   trigrams, so texts that share passages tend to get the same key.
2. Rows are dealt by range of (key, id) to partitions of about
   ``PARTITION_TOKENS`` tokens; a hot key is cut by id, so copies of one text,
   however many, spread over partitions.
3. A partition is read in shards of ``SHARD_TOKENS``. Each shard gets a BM25
   inverted index. The document that opens a window is its seed; the index
   returns the seed's unused neighbours, best first and as many as it takes, and
   they fill the window greedily. What does not fit opens the next window and is its seed. A window
   without neighbours left takes the next unused document in key order.
4. Windows are full but for the last of a partition, which is cut into
   sequences of power-of-two length; so nothing is padded.

Memory of a task: one shard (or one text, if longer) and its index.

Terms are hashed token bigrams; a term in many of a shard's documents counts
little, by its idf, but it counts, so members of a large group find each other.

Defined results: a null or empty text is the end id alone; a null id is kept;
repeated rows and ids are each packed; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bounded_batches, mix64, named, slices, stage, table

WINDOW, END_ID = 2048, 1
SHARD_TOKENS, PARTITION_TOKENS = 1 << 19, 1 << 21
K1, B = 1.2, 0.75
CACHE = 0                       # words of a table of ids: none is kept any more, encoding is faster
_LATIN = bytes([10, *range(0x20, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)])


class Encoder:
    """Ids of texts, as the ``tokenizers`` file at ``vocabulary`` gives them.

    Texts of plain Latin characters are encoded by the same vocabulary's
    ``tiktoken`` file, whole; on them both cut the same words. Where white space
    never follows white space, a look-ahead for its runs decides nothing, and the
    pattern without it is faster. All other texts go to ``tokenizers``.
    """

    ODD = re.compile(r"[^\n\x20-\x7e\xa1-\xac\xae-ɏ]|\s\x20|\x20\s|<\|")

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None, size: int | None = None):
        self.vocabulary, self.ranks, self.pattern = vocabulary, ranks, pattern
        size = self.full.get_vocab_size() if size is None else size
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    # each is loaded when a text needs it: a worker keeps it for good
    @cached_property
    def full(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    @cached_property
    def fast(self):
        return self._tiktoken(self.pattern)

    @cached_property
    def single(self):
        return self._tiktoken(self.pattern.replace(r"|\s+(?!\S)|\s+", r"|\s+"))

    def _tiktoken(self, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(self.ranks, "rb"))}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def plain(self, t: str) -> bool:
        """Do both encoders cut the text alike? Latin-1 is tested without a pattern."""
        try:
            raw = t.encode("latin-1")
        except UnicodeEncodeError:
            return not self.ODD.search(t)
        return not (b"  " in raw or b"\n " in raw or b" \n" in raw or b"<|" in raw or raw.translate(None, _LATIN))

    def __call__(self, texts: list) -> list[bytes]:
        out: list = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if t and self.ranks and self.pattern and self.plain(t):
                use = self.fast if "\n\n" in t else self.single       # plain: no other white space meets
                out[i] = np.array(use.encode_ordinary(t), self.dtype).tobytes()
            else:
                rest.append(i)
        if rest:
            for i, e in zip(rest, self.full.encode_batch([texts[i] or "" for i in rest], add_special_tokens=False)):
                out[i] = np.array(e.ids, self.dtype).tobytes()
        return out


def route(ids: np.ndarray) -> int:
    """Smallest hash of the text's token trigrams."""
    wide = ids.astype(np.uint64)
    with np.errstate(over="ignore"):
        k = min(3, len(wide))
        code = wide[:len(wide) - k + 1].copy()
        for j in range(1, k):
            code = code * np.uint64(1 << 20) + wide[j:len(wide) - k + 1 + j]
        return int(mix64(code).view(np.int64).min())


def tokenise(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None,
             id_column: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``(id, n, route, ids)``; ids are little-endian unsigned integers."""
    src = named(docs, id=id_column, text=text)
    shared = docs.sparkSession.sparkContext.broadcast({})
    size = Encoder(vocabulary).full.get_vocab_size()

    def batches(it):
        held = shared.value             # one encoder per worker, for as long as the broadcast lives there
        if "encoder" not in held:
            held["encoder"] = Encoder(vocabulary, ranks, pattern, size)
        encode = held["encoder"]
        end = np.array([end_id], encode.dtype).tobytes()
        for b in slices(it, "text"):
            raw = [x + end for x in encode(b.column("text").to_pylist())]
            arrays = [np.frombuffer(x, encode.dtype) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(a) for a in arrays], pa.int64()),
                 pa.array([route(a) for a in arrays], pa.int64()), pa.array(raw, pa.binary())],
                ["id", "n", "route", "ids"])

    return src.mapInArrow(batches, f"id {src.schema['id'].dataType.simpleString()}, n long, route long, ids binary")


class Shard:
    """BM25 inverted index of some documents."""

    def __init__(self, docs: list[np.ndarray]):
        m = len(docs)
        lens = np.array([len(d) for d in docs])
        flat = np.concatenate(docs).astype(np.uint64)
        owner = np.repeat(np.arange(m, dtype=np.uint64), lens)
        with np.errstate(over="ignore"):
            code = mix64(flat[:-1] * np.uint64(1 << 32) + flat[1:]) >> np.uint64(32)
        code = (code << np.uint64(32) | owner[:-1])[owner[:-1] == owner[1:]]
        code = np.sort(code)
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        tf = np.diff(np.append(first, len(code)))
        term, doc = code[first] >> np.uint64(32), (code[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        df = np.diff(np.append(start, len(term)))
        use = df >= 2
        keep = np.repeat(use, df)
        self.doc, tf, self.df = doc[keep], tf[keep], df[use]
        self.start = np.cumsum(self.df) - self.df
        idf = np.log1p((m - self.df + 0.5) / (self.df + 0.5))
        norm = K1 * (1 - B + B * lens[self.doc] / lens.mean())
        self.weight = np.repeat(idf, self.df) * tf * (K1 + 1) / (tf + norm)
        of = np.sort(self.doc.astype(np.uint64) << np.uint64(32) | np.repeat(np.arange(len(self.df)), self.df).astype(np.uint64))
        self.terms = (of & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.bounds = np.searchsorted(of >> np.uint64(32), np.arange(m + 1, dtype=np.uint64))
        self.m = m

    def scores(self, i: int) -> np.ndarray:
        """Score of every document for document i as the query."""
        t = self.terms[self.bounds[i]:self.bounds[i + 1]]
        n = self.df[t]
        at = np.arange(n.sum()) + np.repeat(self.start[t] - (np.cumsum(n) - n), n)
        return np.bincount(self.doc[at], self.weight[at], self.m) if len(t) else np.zeros(self.m)


def best_free(score: np.ndarray, free: np.ndarray, k: int = 16) -> np.ndarray:
    """Up to k free documents with a score, best first."""
    score = score * free
    best = np.argpartition(score, -k)[-k:] if len(score) > k else np.arange(len(score))
    best = best[score[best] > 0]
    return best[np.lexsort((best, -score[best]))]


class Packer:
    """Fills windows one after the other; pieces come out per full window."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.held: list[tuple] = []
        self.fill = 0
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> bool:
        """Append a document; True if a window was completed inside or at its end."""
        at, wrapped = 0, False
        while at < len(ids):
            take = min(len(ids) - at, self.window - self.fill)
            self.held.append((doc, at, ids[at:at + take], len(ids)))
            at += take
            self.fill += take
            if self.fill == self.window:
                self._flush(self.held)
                self.held, self.fill, wrapped = [], 0, True
        return wrapped

    def _flush(self, parts: list[tuple]) -> None:
        offset = 0
        for doc, at, ids, total in parts:
            self.out.append((doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """The last, open window: sequences of power-of-two length."""
        left = self.held
        while left:
            size, part = 1 << (sum(len(x[2]) for x in left).bit_length() - 1), []
            while size:
                doc, at, ids, total = left.pop(0)
                part.append((doc, at, ids[:size], total))
                if len(ids) > size:
                    left.insert(0, (doc, at + size, ids[size:], total))
                size -= len(part[-1][2])
            self._flush(part)
        self.held, self.fill = [], 0


def pack_shard(packer: Packer, ids: list, docs: list[np.ndarray]) -> None:
    index, free = Shard(docs), np.ones(len(docs), bool)
    nxt, seed, score, ranked, k = 0, None, None, [], 16
    for _ in range(len(docs)):
        pick = None
        if seed is not None and packer.fill:
            if not ranked:                  # the seed's next neighbours, more each time
                score = index.scores(seed) if score is None else score
                ranked = best_free(score, free, k)[::-1].tolist()
                k *= 4
            if ranked:
                pick = ranked.pop()
        if pick is None:
            while not free[nxt]:
                nxt += 1
            pick = seed = nxt
            score, ranked, k = None, [], 16
        free[pick] = False
        if packer.add(ids[pick], docs[pick]):
            seed, score, ranked, k = pick, None, [], 16     # its rest opens the next window


PIECE = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(tokens: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
         partition_tokens: int = PARTITION_TOKENS) -> DataFrame:
    """Pieces of all documents of ``tokens(id, n, route, ids)``; every id in one."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // partition_tokens))
    id_type = tokens.schema["id"].dataType
    arrow_id = to_arrow_type(id_type)

    def shards(it):
        ids, docs, n = [], [], 0
        for b in slices(it, "ids"):
            for key, count, raw in zip(b.column("id").to_pylist(), b.column("n").to_pylist(),
                                       b.column("ids").to_pylist()):
                kind = "<u2" if len(raw) == 2 * count else "<u4"
                ids.append(key)
                docs.append(np.frombuffer(raw, kind))
                n += count
                if n >= shard_tokens:
                    yield ids, docs
                    ids, docs, n = [], [], 0
        if docs:
            yield ids, docs

    def fill(it):
        packer = Packer(window, TaskContext.get().partitionId() << 32)

        def drain():
            cols = list(zip(*packer.out)) if packer.out else [()] * 7
            packer.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], arrow_id), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for ids, docs in shards(it):
            pack_shard(packer, ids, docs)
            yield drain()
        packer.finish()
        if packer.out:
            yield drain()

    return (tokens.repartitionByRange(parts, "route", "id").sortWithinPartitions("route", "id")
            .mapInArrow(fill, PIECE.format(id=id_type.simpleString())))


def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's tokens and windows over all rows of ``docs``."""
    import public_tokenizers

    bounded_batches(docs.sparkSession)
    tokens = tokenise(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN, id_column, text)
    return pack(stage(tokens, "packing-tokens"))


QUERIES = {"op7_retrieval_packing": op7_retrieval_packing}
ORACLE: dict[str, str] = {}
