"""The pipeline against a brute-force version of its filters, and its registration."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

from .helpers import contamination_brute, docs, jaccard_brute, spans_brute
from .test_spans import BENCH, SECRETS

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    queries = __spark_entry__.queries()
    names = [n for n in queries if re.match(r"op\d+_", n)]
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names} == set(range(1, 14)) and "pipeline" in queries
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination",
                                                      "secret scans", "packing"]


def test_run_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    keep = {d: t for d, t in texts.items() if re.search("[A-Za-z]", t)}         # all are in one of the four languages
    joined = jaccard_brute(list(keep.items()), 5, 80)
    keep = {d: t for d, t in keep.items() if joined[d][1] == d}
    bench = contamination_brute(list(keep.items()), items)
    keep = {d: t for d, t in keep.items() if not (bench[d][1] and 20 * bench[d][1] >= bench[d][0])}
    keep = {d: t for d, t in keep.items() if not spans_brute(t, SECRETS)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for d, t in keep.items()}
    got = collections.defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        got[r.doc_id] += r.length
    assert got == {d: len(a) for d, a in ids.items()}


def test_stages_on_edge_rows(spark, tmp_path):
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    prose = "the thing and that of the with from this was"
    rows = [(1, prose), (1, prose), (None, prose + " none"), (2, None), (3, ""), (4, "12 34"), (5, prose + " token = abcdef1 and more"),
            (6, prose), (7, "one two three"), (8, prose + " x" * 50_000),
            (None, "token = abcdef1 " + prose[::-1]), (None, "one TWO three"), (1, "?"), (1, "password = abcdef1")]
    df = docs(spark, rows, extra=True)
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, df, str(tmp_path))
        assert out.columns == df.columns                   # also those with clashing names
        kept[name] = sorted(((r[0] or 0), (r[1] or "")[:9]) for r in out.collect())
        assert step(spark, df.limit(0), str(tmp_path)).count() == 0
    every = sorted((d or 0, (t or "")[:9]) for d, t in rows)

    def without(*gone):
        left = list(every)
        for g in gone:
            left.remove(g)
        return left
    start = prose[:9]
    # rows that share an id are judged apart, rows without an id like others
    assert kept["language ID"] == without((2, ""), (3, ""), (4, "12 34"), (1, "?"))
    # (1, prose) twice is one document, 6 is its copy and the text with "none" a near one; 7 has a copy without an id
    assert kept["n-gram Jaccard join"] == without((1, start), (6, start), (0, start), (0, "one TWO t"))
    assert kept["benchmark decontamination"] == without((7, "one two t"), (0, "one TWO t"))
    assert kept["secret scans"] == without((5, start), (0, "token = a"), (1, "password "))
    assert corpus_pipeline.STAGES[-1][1](spark, df.limit(0), str(tmp_path)).count() == 0
