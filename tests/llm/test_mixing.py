"""Mixing to target weights against exact water-filling and plain sampling."""

import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakenorm.llm import mixing

SF = "/root/testdata/sf0.001"


def targets_brute(sizes, weights, epochs=3):
    """{source: target} by clamping and sharing again, in fractions."""
    total, capped = sum(sizes.values()), {s for s in sizes if not weights[s]}
    while True:
        parts = sum(weights[s] for s in sizes if s not in capped)
        rest = total - sum(epochs * sizes[s] for s in capped if weights[s])
        share = {s: Fraction(weights[s] * rest, parts) for s in sizes if s not in capped} if parts else {}
        over = {s for s, t in share.items() if t > epochs * sizes[s]}
        if not over:
            return {s: share.get(s, Fraction(epochs * sizes[s] if weights[s] else 0)) for s in sizes}
        capped |= over


def order(source):
    return (source is None, (source or "").encode())


def mix_brute(rows, weights=(1, 2, 3), epochs=3, seed=mixing.SEED):
    """Sorted (size, source_size, target, repeats) of (id, text, source) rows."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=order)
    sizes = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    target = targets_brute(sizes, {s: weights[i % len(weights)] for i, s in enumerate(sources)}, epochs)
    key = [hashlib.md5("\x1f".join([str(seed), "" if i is None else str(i), t or ""]).encode()).hexdigest() for i, t, _ in rows]
    repeats = [0] * len(rows)
    for s in sources:
        mine = sorted((k for k in range(len(rows)) if rows[k][2] == s), key=lambda k: (key[k], k))
        passes = min(epochs, int(target[s] / max(1, sizes[s])))
        for k in mine:
            repeats[k] = passes
        left, cut = (float(target[s]) - passes * sizes[s] if passes < epochs else 0.0), 0
        for turn in range(mixing.ROUNDS):
            last, used, some = turn + 1 == mixing.ROUNDS, 0, False
            if left <= 0:
                break
            for place in range(cut, len(mine)):
                n = size[mine[place]]
                if turn and n > (2 * left if last else left):
                    continue
                some = True
                if (2 * (used + n) - n <= 2 * left) if last else (used + n <= left):
                    repeats[mine[place]] += 1
                    used, cut = used + n, place + 1
                else:
                    break
            else:
                cut = len(mine) if some else cut
            left -= used
    return sorted((size[k], sizes[rows[k][2]], float(target[rows[k][2]]), repeats[k]) for k in range(len(rows)))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y") for r in rows], "doc_id long, text string, source string, id int, SIZE string, key string")


def result(df):
    return sorted((r["size"], r.source_size, r.target, r.repeats) for r in df.collect())


def rows_of(seed, n, sources):
    rng = random.Random(seed)
    return [(i, rng.choice([" ", "\t", "\x0b", "\n "]).join("w" * rng.randint(1, 3) for _ in range(int(rng.paretovariate(0.8)) % 400)),
             rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_mix_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "SORTED", 4)                    # the cut goes through several digits
    rows = rows_of(seed, 500, ["a"] * 12 + ["b", "é", "B", None, "", "zz", "\U0001f600", "￿"])
    got = mixing.mix_sources(frame(spark, rows))
    assert result(got) == mix_brute(rows)
    assert all(r.taken == r["size"] * r.repeats <= 3 * r["size"] for r in got.collect())


def test_op11_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    out = mixing.op11_source_mix(spark, SF)
    assert result(out) == mix_brute(rows)
    by = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= r.most for r in by)
    assert abs(sum(r.target for r in by) - sum(r["size"] for r in out.collect())) < 1e-6
    assert sorted(map(tuple, mixing.op11_source_mix(spark, SF).collect())) == sorted(map(tuple, out.collect()))     # reruns agree


def test_targets_of_uneven_sources(spark):
    sizes = {f"s{i:03}": 3 ** (i % 9) for i in range(60)}
    for weights in ([1, 2, 3], [5, 1], [0, 1, 0, 7], [0]):
        w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
        src = spark.createDataFrame([(s, n, w[s]) for s, n in sizes.items()], "source string, source_size long, weight long")
        want = targets_brute(sizes, w)
        assert {r.source: r.target for r in mixing.fill(src, 3).collect()} == {s: float(t) for s, t in want.items()}


def test_order_of_sources_over_many_partitions(spark):
    names = [f"host{i}.example" for i in range(3000)] + [None, "É", "z", "Z", ""]
    src = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(7)
    got = {r.source: r.weight for r in mixing.cycle_weights(src, (1, 2, 3)).collect()}
    assert got == {s: i % 3 + 1 for i, s in enumerate(sorted(names, key=order))}


def test_mix_edge_rows(spark):
    one = "one two three"
    rows = [(1, one, "a"), (1, one, "a"), (1, one, "a"), (1, "other words here", "a"), (None, one, "a"), (None, None, "b"), (2, "", "b"),
            (3, " \t\n", "c"), (4, "x " * 50_000, None), (5, "x", None)]
    assert result(mixing.mix_sources(frame(spark, rows))) == mix_brute(rows)
    nothing = [(1, None, "a"), (2, " ", None)]
    assert result(mixing.mix_sources(frame(spark, nothing))) == [(0, 0, 0.0, 0)] * 2
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    weights = spark.createDataFrame([("a", 3), (None, 1)], "source string, weight long")
    got = {(r.source, r.target) for r in mixing.mix_sources(frame(spark, rows), weights).collect()}
    sizes = {"a": 15, "b": 0, "c": 0, None: 50_001}
    assert got == {(s, float(t)) for s, t in targets_brute(sizes, {"a": 3, "b": 0, "c": 0, None: 1}).items()}


def test_mix_is_native(spark):
    plan = mixing.op11_source_mix(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
