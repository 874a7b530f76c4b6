"""Suffix dedup, n-gram Jaccard join and embedding links against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakenorm.llm import embedding_dedup, ngram_join, suffix_dedup
from lakenorm.llm.common import connected_components

from .helpers import Union, docs, jaccard_brute, repeats_brute

SF = "/root/testdata/sf0.001"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ------------------------------------------------------------ suffix dedup

def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(0)
    for letters in (1, 2, 3, 30):
        for n in (0, 1, 2, 7, 100, 999):
            t = rng.integers(97, 97 + letters, n).astype(np.uint8)
            raw = t.tobytes()
            assert suffix_dedup.suffix_array(t, 1000).tolist() == sorted(range(n), key=lambda i: raw[i:])


def test_common_prefixes_are_exact():
    t = np.frombuffer(b"abcabcabdabcabcabx", np.uint8)
    a, b = np.array([0, 0, 0]), np.array([9, 3, 1])
    assert suffix_dedup.common_prefixes(t, a, b, 400).tolist() == [8, 5, 0]


def passage_texts():
    rng = random.Random(5)
    shared, other = words(rng, 200), words(rng, 90)
    texts = [words(rng, 300) for _ in range(6)]
    texts += [words(rng, 40) + " " + shared + " " + words(rng, 50) for _ in range(8)]
    texts += [shared[:399], shared[5:405], shared[5:404], other + " " + other, "é" * 500, "x" * 2000, "ab" * 300, "y" * 400, "y" * 401]
    return texts + [texts[0], texts[7], texts[7], None, "", "short", "short"]


@pytest.mark.parametrize("block", [2 << 20, 3000])
def test_repeats_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TEXT", block)          # small: anchors are cut into blocks
    texts = passage_texts()
    want = repeats_brute(texts)
    for r in suffix_dedup.remove_repeats(docs(spark, texts, extra=True)).collect():
        kept = bytes(r.kept)
        assert (r.n_bytes, r.n_bytes - len(kept), len(r.spans), hashlib.sha256(kept).hexdigest()) == want[r.id], r.id


@pytest.mark.parametrize("seed", range(3))
def test_hot_anchor_is_split_by_its_next_bytes(spark, seed, monkeypatch):
    """A shared passage at the edges of different texts, some edges equal too."""
    rng = random.Random(seed)
    shared = words(rng, 30)
    assert 128 < len(shared) < 400
    texts = [words(rng, 70) + " " + shared + " " + words(rng, 70) for _ in range(40)]
    near = texts[2].index(shared)
    texts += [texts[0][200:], words(rng, 20) + texts[1][100:900], texts[2][near - 150:], texts[2][:near + len(shared) + 110] + words(rng, 90)]
    monkeypatch.setattr(suffix_dedup, "TEXT", 2000)
    got = suffix_dedup.remove_repeats(docs(spark, texts)).collect()
    want = repeats_brute(texts)
    assert {r.id: r.n_bytes - len(bytes(r.kept)) for r in got} == {i: w[1] for i, w in enumerate(want)}


def test_passage_in_a_third_of_all_texts(spark, monkeypatch):
    """The anchors at its edges are split, and all is found."""
    rng = random.Random(5)
    shared = words(rng, 90)
    texts = [words(rng, 60) + (" " + shared + " " if i % 3 == 0 else " ") + words(rng, 60) for i in range(600)]
    monkeypatch.setattr(suffix_dedup, "TEXT", 40_000)
    src = docs(spark, texts).select(F.col("doc_id").alias("id"), "text").withColumn("rk", F.unhex(F.md5("text")))
    split = []
    inner_split = suffix_dedup._split
    monkeypatch.setattr(suffix_dedup, "_split", lambda *a: (split.append(a[1]), inner_split(*a))[1])
    spans = {r.id: r.spans for r in suffix_dedup.repeated_spans(src).collect()}
    assert split
    want = repeats_brute(texts)
    for i, w in enumerate(want):
        covered = {x for s in spans.get(i, ()) for x in range(s.a, s.b)}
        assert len(covered) == w[1], i


def test_rows_of_equal_short_hash_and_null_ids(spark):
    """Two texts whose 32-bit hashes are equal are two rows, also with null ids."""
    text = F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(f"/{k}"))) for k in range(16)])
    many = spark.range(250_000).select("id", F.hash(text).alias("h"))
    pair = many.groupBy("h").agg(F.collect_list("id").alias("ids")).where("size(ids) > 1").first()
    assert pair is not None
    a, b = [r[0] for r in spark.createDataFrame([(i,) for i in pair.ids[:2]], "id long").select(text).collect()]
    out = suffix_dedup.remove_repeats(docs(spark, [(None, a), (None, b), (7, a)])).collect()
    assert sorted((r.n_bytes, len(bytes(r.kept)), bytes(r.kept)) for r in out) == [(512, 0, b""), (512, 0, b""), (512, 512, b.encode())]


def test_repeats_across_parts_of_a_long_text(spark, monkeypatch):
    rng = random.Random(2)
    text = words(rng, 3000)
    texts = [text, "z" + text, words(rng, 500) + text[5000:9000]]
    monkeypatch.setattr(suffix_dedup, "STEP", 4096)
    want = repeats_brute(texts)
    got = {r.id: r for r in suffix_dedup.remove_repeats(docs(spark, texts)).collect()}
    assert [got[i].n_bytes - len(bytes(got[i].kept)) for i in range(3)] == [w[1] for w in want]


def test_op1_on_the_table_and_null_ids(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], repeats_brute([r.text for r in rows])))
    for r in suffix_dedup.op1_suffix_dedup(spark, SF).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    long = words(random.Random(9), 200)
    out = suffix_dedup.remove_repeats(docs(spark, [(None, long), (None, long), (3, "q" + long), (3, "other")])).collect()
    assert sorted(len(bytes(r.kept)) for r in out) == [0, 0, 1, 5]
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


# ------------------------------------------------------------ Jaccard join

def near_texts():
    rng = random.Random(4)
    texts = [None, "", "  \n", "a", "A", "a b", "a b c", "A  b\tc", "a b c d", "a b c d"]
    for n in (12, 30, 80, 300):
        base = words(rng, n).split()
        for _ in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], ["X"], ["y", "z"], [w[at]] * 2])
            texts.append(" ".join(w))
    passage = words(rng, 100)
    texts += [words(rng, rng.choice([0, 3, 10, 300])) + " " + passage for _ in range(25)]
    return texts


@pytest.mark.parametrize("block", [8192, 3])
def test_jaccard_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", block * 100)
    texts = near_texts()
    got = {r.id: (r.n_shingles, r.component_id)
           for r in ngram_join.jaccard_components(docs(spark, texts, extra=True)).collect()}
    assert got == jaccard_brute(list(enumerate(texts)))


@pytest.mark.parametrize("size,percent", [(5, 80), (1, 60), (2, 100)])
def test_jaccard_by_other_rules(spark, size, percent):
    texts = near_texts()
    rule = ngram_join.Rule(size, percent)
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, texts), rule=rule).collect()}
    assert got == jaccard_brute(list(enumerate(texts)), size, percent)


def test_long_strangers_are_not_shipped_with_their_texts(spark, monkeypatch):
    """Points of 256 counts let any two long sets of a size pass; finer ones do not."""
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 20_000)
    shipped, blocks = [], ngram_join.blocks

    def recorded(df, group, *more):
        if group == "component":
            shipped.extend(r.rep for r in df.select("rep").collect())
        return blocks(df, group, *more)

    monkeypatch.setattr(ngram_join, "blocks", recorded)
    rng = random.Random(8)
    passage = words(rng, 12)
    texts = [words(rng, 9000) + " " + passage for _ in range(8)]
    texts.append(" ".join(texts[0].split()[:7500]))             # linked over a band of sizes
    texts.append(" ".join(texts[1].split()[:7500]))
    got = {r.id: (r.n_shingles, r.component_id)
           for r in ngram_join.jaccard_components(docs(spark, texts), rule=ngram_join.Rule(5, 80)).collect()}
    assert got == jaccard_brute(list(enumerate(texts)), 5, 80)
    assert got[8][1] == 0 and got[9][1] == 1 and sorted(shipped) == [0, 1, 8, 9]


def test_fine_points_folded_are_a_bound():
    rng = np.random.default_rng(3)
    s = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    fine = ngram_join.fine_vector(s)
    assert len(fine) == 1024 and (ngram_join.folded(fine, 256) == ngram_join.count_vector(s)).all()
    high = np.full(1024, 200, np.uint8)
    assert (ngram_join.folded(high, 256) == 255).all()


def test_op6_on_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op6_ngram_jaccard(spark, SF).collect()}
    assert got == jaccard_brute([(r.doc_id, r.text) for r in rows])


def test_jaccard_edge_rows(spark):
    same = "one two three four five"
    out = ngram_join.jaccard_components(docs(spark, [(5, same), (None, same), (7, same), (5, same), (9, "")])).collect()
    assert sorted((r.id or -1, r.component_id) for r in out if r.id is not None) == [(5, 5), (5, 5), (7, 5), (9, 9)]
    assert [r.component_id for r in out if r.id is None] == [None]
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0


@pytest.mark.parametrize("page,fan", [(32, 16), (2, 3), (1, 2)])
def test_tree_finds_what_the_bound_allows(page, fan, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAGE", page)
    monkeypatch.setattr(ngram_join, "FAN", fan)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[:190], rng.integers(0, 2**63, 8, dtype=np.uint64)])) for s in sets]
    points = np.array([ngram_join.count_vector(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.CountRTree(points, sizes)
    assert len(tree.levels) == {32: 1, 2: 4, 1: 7}[page]
    for i in range(len(sets)):
        true = {j for j in range(len(sets)) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
        allowed = {j for j in range(len(sets)) if ngram_join.RULE.sizes_fit(sizes[i], sizes[j]) and ngram_join.bound(
            points[i], int(sizes[i]), points[[j]], sizes[[j]], tree.rest[[j]])[0]}
        assert true <= set(tree.query(i).tolist()) == allowed
    gone = np.arange(0, len(sets), 2)
    tree.take(gone)
    assert not set(tree.query(1).tolist()) & set(gone.tolist()) and all(x.left.sum() == len(sets) // 2 for x in tree.levels)


def test_counts_over_255_stay_a_bound():
    rng = np.random.default_rng(3)
    s = np.unique(rng.integers(0, 2**63, 120_000, dtype=np.uint64))
    t = np.concatenate([s[:111_000], np.unique(rng.integers(0, 2**63, 9000, dtype=np.uint64))])
    t.sort()
    points = np.array([ngram_join.count_vector(s), ngram_join.count_vector(t)])
    sizes = np.array([len(s), len(t)])
    assert points.max() == 255 and ngram_join.forest(points, sizes, [s, t]) == [(0, 1)]


def test_one_word_hash_per_word():
    long = "x" * 1_200_000
    (a,), (b,) = ngram_join.Shingler()(["a b c " + long]), ngram_join.Shingler()(["A\nb  c\t" + long + " "])
    assert len(a) == 1 and (a == b).all()


# -------------------------------------------------------------- components

def test_components_of_a_path_a_star_and_a_clique(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    edges += [(a, b) for a in range(300, 310) for b in range(300, 310)] + [(7, 7), (None, 3)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    u = Union({x for e in edges[:-1] for x in e if x is not None} | {3})
    for a, b in edges:
        if a is not None and b is not None:
            u.join(a, b)
    assert got == {k: u.find(k) for k in got} and len(got) == 61 + 60 + 10


# -------------------------------------------------------------- embeddings

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def links_brute(rows):
    ok = {}
    for i, v, _ in rows:
        a = None if v is None or any(x is None for x in v) else np.array(v, np.float32).astype(float)
        ok[i] = a if a is not None and len(a) and np.isfinite(a).all() and a.any() else None
    u, n = Union(ok), dict.fromkeys(ok, 0)
    keys = list(ok)
    for x, i in enumerate(keys):
        for j in keys[x + 1:]:
            a, b = ok[i], ok[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9:
                u.join(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], u.find(i), u.find(i) == i) for i in ok}


@pytest.mark.parametrize("block", [4096, 5])
def test_embedding_groups_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for dim in (64, 16):
        for _ in range(8):
            c = rng.normal(size=dim)
            for _ in range(rng.integers(1, 9)):
                rows.append((c + rng.normal(size=dim) * 0.05 * rng.integers(0, 3)).tolist())
    rows += [rows[0]] * 4 + [[2 * x for x in rows[0]], [-x for x in rows[0]], None, [], [0.0] * 64, [float("nan")] + [1.0] * 63,
                             [float("inf")] * 64, [None] + [1.0] * 63, [1e30] * 64, [1e-30] * 64]
    rows = [(i, v, i % 3) for i, v in enumerate(rows)]
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(vectors(spark, rows)).collect()}
    assert got == links_brute(rows)
    assert embedding_dedup.embedding_links(vectors(spark, [])).count() == 0


def test_embedding_recall_of_lone_pairs(spark):
    """Pairs just over the threshold, far from everything else: the hardest case."""
    rng, n = np.random.default_rng(1), 1500
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=(n, 64))
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.902 * x + np.sqrt(1 - 0.902**2) * z
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))]
    found = embedding_dedup.embedding_links(vectors(spark, rows)).agg(F.sum("n_links")).first()[0]
    assert found >= 0.95 * 2 * n


def near_pairs(rng, n, dim, cosine=0.902):
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=(n, dim))
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine**2) * z


@pytest.mark.parametrize("dim", [64, 768])
def test_recall_of_every_plan(dim):
    """Pairs just over the threshold meet in a cell, whatever the size of the table."""
    x, y = near_pairs(np.random.default_rng(dim), 600, dim)
    for _, e8, tables in embedding_dedup.PLANS:
        h = embedding_dedup.LatticeHash(dim, e8, tables)
        meet = [len(np.intersect1d(a, b)) > 0 for a, b in zip(h(x), h(y))]
        assert np.mean(meet) >= 0.95, (dim, e8, tables, np.mean(meet))


def test_strangers_that_meet_do_not_grow_with_the_table(spark):
    """Pairs of vectors in a common cell, per vector, from 10,000 to 50,000 rows."""
    rng, per = np.random.default_rng(4), {}
    for n in (10_000, 50_000):
        x = rng.normal(size=(n, 64))
        table = spark.createDataFrame(pa.table({"rep": np.arange(n), "dim": np.full(n, 64), "vec": [v.tobytes() for v in x]}))
        tiles = ngram_join.tiles_of(embedding_dedup.cells(table.repartition(8), *embedding_dedup.plan_of(n)), "cells")
        pairs = tiles.groupBy("key", "c").count().agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).first()[0] or 0
        per[n] = pairs / n
    assert per[50_000] <= max(per[10_000], 1.0) and per[10_000] < 20, per


def test_cells_with_the_same_members_count_once(spark):
    rows = [(k, r) for k, m in {1: "ab", 2: "ab", 3: "abc", 4: "a", 5: "bc", 6: "ab"}.items() for r in map(ord, m)]
    got = ngram_join.tiles_of(spark.createDataFrame(rows, "key long, rep long"), "cells").collect()
    assert sorted((r.key, r.c, chr(r.rep)) for r in got) == [(1, 2, "a"), (1, 2, "b"), (3, 3, "a"), (3, 3, "b"), (3, 3, "c"), (5, 2, "b"), (5, 2, "c")]


def test_registered_query_finds_planted_links(spark, tmp_path):
    """op8 on a table of its own: lone pairs, groups, copies, vectors without links."""
    rng = np.random.default_rng(9)
    x, y = near_pairs(rng, 40, 64, 0.97)
    centre = rng.normal(size=64)
    group = centre + 0.02 * rng.normal(size=(30, 64))
    all_ = np.concatenate([x, y, group, group[:5], rng.normal(size=(50, 64))])
    rows = [(i, [float(np.float32(c)) for c in v], i % 10) for i, v in enumerate(all_)]
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.op8_embedding_dedup(spark, str(tmp_path)).collect()}
    assert got == links_brute(rows) and sum(n > 0 for n, _, _ in got.values()) == 115


def test_lattice_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(5)
    y = rng.normal(size=(200, 8)) * 3
    c = embedding_dedup.nearest_e8(y)
    assert np.allclose(2 * c, np.rint(2 * c)) and (np.rint(c.sum(axis=1)) % 2 == 0).all()
    steps = embedding_dedup._minimal_vectors()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    d = ((y - c) ** 2).sum(axis=1)
    assert (d[:, None] <= ((y[:, None] - c[:, None] - steps) ** 2).sum(axis=2) + 1e-9).all() and (d <= 1 + 1e-9).all()
