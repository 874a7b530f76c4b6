"""Packing: exact round trip of all ids, window rules, retrieval."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakenorm.llm import packing

from .helpers import docs

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def check(rows, texts, tokenizer):
    """Every id of every document in exactly one piece; sequences gapless."""
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in texts]
    left = collections.Counter((d, len(a), zlib.crc32(a.tobytes())) for (d, _), a in zip(texts, ids))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for (d, _), a in zip(texts, ids):
        if sum(1 for x, _ in texts if x == d) == 1:
            at = 0
            for r in sorted(by_doc[d], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(a))
                assert r.ids_crc32 == zlib.crc32(a[at:at + r.length].tobytes())
                at += r.length
            assert at == len(a)
    assert sum(r.length for r in rows) == sum(n * c for (_, n, _), c in left.items())
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == packing.WINDOW or at & (at - 1) == 0      # full, or a power of two: no padding
    return by_sequence


def test_encoder_equals_tokenizers(tokenizer):
    rng = random.Random(3)
    parts = ["the", "Thing", "é", "ß", "ǅ", "don't", "'s", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", " ", "１２", "²", "12", "_",
             "...", "<|endoftext|>", "<|", "日本", "\U0001f600", "ſ", "\x00", "á", "ªº", "word, ", " word", "\n ", " \n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(600)] + [None, "", " ", "x" * 50_000, "a " * 30_000]
    encode = packing.Encoder(VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for some in (texts, texts[::-1], texts):
        for t, raw in zip(some, encode(some)):
            assert np.frombuffer(raw, encode.dtype).tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_encoder_with_a_full_cache(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    encode = packing.Encoder(VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i * j}" for j in range(60)) for i in range(30)]
    assert [np.frombuffer(r, encode.dtype).tolist() for r in encode(texts)] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_plain_texts_are_encoded_whole_and_equal_tokenizers(tokenizer):
    rng = random.Random(5)
    parts = ["the", "a'll", "don't", "12", "x1", "...", "é", "ſt", "Ÿ", "ÿ", "<", "|", "\n", "\n\n", "-", "«a»"]
    encode = packing.Encoder(VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(20_000)]
    texts = [t for t in (rng.choice(["", " "]) + " ".join(words[i:i + 3]) + rng.choice(["", " ", "\n"]) for i in range(0, len(words), 3))
             if encode.plain(t)]
    assert len(texts) > 20 and not any(map(encode.plain, ["a  b", "a\n b", "a \nb", "<|a", "a\tb", "a\xa0b", "a\xadb", "日"]))
    calls, encode.full = [], None               # none of them reaches the slower encoder
    counted = lambda whole: type("Counted", (), {"encode_ordinary": staticmethod(lambda t: calls.append(t) or whole(t))})
    encode.fast, encode.single = counted(encode.fast.encode_ordinary), counted(encode.single.encode_ordinary)
    assert 0 < sum("\n\n" in t for t in texts) < len(texts)
    assert [np.frombuffer(r, encode.dtype).tolist() for r in encode(texts)] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert calls == texts                       # one call a text, not one per run of words and first word


def test_round_trip_of_edge_rows(spark, tokenizer):
    rng = random.Random(1)
    texts = [None, "", "a", " ".join(f"t{rng.randrange(500)}" for _ in range(9000)), "b " * 1023, "b " * 1024]
    texts += [" ".join(f"u{rng.randrange(300)}" for _ in range(rng.randrange(400))) for _ in range(60)]
    rows = [*enumerate(texts), (None, "no id"), (3000, "twice"), (3000, "twice")]
    out = packing.pack_documents(docs(spark, rows, extra=True)).collect()
    check(out, rows, tokenizer)
    assert sum(r.doc_id is None for r in out) == 1 and sum(r.doc_id == 3000 for r in out) == 2
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_several_shards_and_partitions(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tokens = packing.tokenise(docs(spark, rows), VOCABULARY)
    out = packing.pack(tokens, shard_tokens=5000, partition_tokens=20_000).collect()
    check(out, rows, tokenizer)
    assert len({r.sequence_id >> 32 for r in out}) > 3


def test_op7_on_the_table(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(packing.op7_retrieval_packing(spark, SF).collect(), rows, tokenizer)


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(0)
    documents = [rng.integers(0, 40, rng.integers(5, 60)).astype(np.uint16) for _ in range(60)]
    index = packing.Shard(documents)
    terms = [collections.Counter(zip(d[:-1].tolist(), d[1:].tolist())) for d in documents]
    df = collections.Counter(t for c in terms for t in c)
    mean, m = np.mean([len(d) for d in documents]), len(documents)

    def bm25(q, d):
        s = 0.0
        for t in terms[q]:
            if df[t] >= 2 and terms[d][t]:
                tf = terms[d][t]
                s += np.log1p((m - df[t] + 0.5) / (df[t] + 0.5)) * tf * (packing.K1 + 1) / (
                    tf + packing.K1 * (1 - packing.B + packing.B * len(documents[d]) / mean))
        return s

    free = rng.random(m) < 0.7
    for q in range(0, m, 7):
        free[q] = False
        want = sorted([(-bm25(q, d), d) for d in range(m) if free[d] and bm25(q, d) > 0])[:16]
        got = packing.best_free(index.scores(q), free).tolist()
        assert np.allclose([bm25(q, d) for d in got], [-s for s, _ in want])


def test_a_seed_fills_its_window_with_all_its_neighbours():
    """Two subjects of 60 short documents in turn, in two large groups: windows
    of 40 documents hold one subject, until it is used up."""
    rng = np.random.default_rng(4)
    subjects = [rng.integers(100 + 1000 * s, 900 + 1000 * s, 30) for s in range(2)]
    documents = [np.append(np.concatenate([[7, 8, 9], rng.permutation(subjects[i % 2].reshape(6, 5)).ravel(), [5] * 16]), 1)
                 for i in range(120)]
    packer = packing.Packer(2000, 0)
    packing.pack_shard(packer, list(range(120)), documents)
    packer.finish()
    order = [doc for doc, start, *_ in packer.out if start == 0]
    assert sorted(order) == list(range(120))
    assert sum(a % 2 != b % 2 for a, b in zip(order, order[1:])) <= 3


def test_related_documents_share_windows(spark):
    """Documents on one subject land together more often than by chance."""
    rng = random.Random(6)
    texts = []
    for subject in range(40):
        vocabulary = [f"{chr(97 + rng.randrange(26))}{rng.randrange(10**6)}" for _ in range(25)]
        texts += [(subject * 100 + i, " ".join(rng.choice(vocabulary) for _ in range(90))) for i in range(8)]
    rng.shuffle(texts)
    out = packing.pack_documents(docs(spark, texts)).collect()
    by_sequence = collections.defaultdict(list)
    for r in out:
        by_sequence[r.sequence_id].append(r.doc_id // 100)
    same = sum(sum(x == y for x, y in zip(v, v[1:])) for v in by_sequence.values())
    pairs = sum(len(v) - 1 for v in by_sequence.values())
    assert same / pairs > 0.5
