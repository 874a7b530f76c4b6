"""Hard negatives and whitening against plain versions in exact or double precision."""

import math
import time

import numpy as np
import pytest

from lakenorm.llm import hard_negatives, whitening

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def frame(spark, rows, extra=False):
    """(id, vector, label) rows; with ``extra`` columns named like those the operators make."""
    more = ", uid long, q string, id int, x string, REP string, n long"
    return spark.createDataFrame([(*r, 7, "a", 1, "b", "c", 3) if extra else r for r in rows],
                                 "vec_id long, embedding array<double>, label int" + (more if extra else ""))


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def negatives_brute(rows, every=100):
    """Sorted result rows, in whole numbers of any size."""
    grid = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if usable(v) and label is not None]
    out = []
    for a, (ident, label, q) in enumerate(grid):
        if ident is None or ident % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, w)), i is None, i or 0, lab) for b, (i, lab, w) in enumerate(grid)
                         if b != a and len(w) == len(q)))
        for ps, pn, pid, _ in [s for s in scored if s[3] == label][:5]:
            p, found = -ps, [s for s in scored if s[3] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(ident, None if pn else pid, k, None if nn else nid, p, -ns) for k, (ns, nn, nid, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def mined(df, **options):
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(df, **options).collect()), key=str)


def clustered(rng, n, dim, labels=4):
    centres = rng.normal(size=(labels, dim))
    return [(i, (centres[i % labels] * rng.random() + 0.5 * rng.normal(size=dim)).tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("dim,rows_in_a_block,step,group", [(8, 8192, 256, 4 << 20), (8, 50, 7, 4 << 20), (3, 64, 16, 600), (64, 8192, 256, 4 << 20)])
def test_negatives_equal_brute_force(spark, dim, rows_in_a_block, step, group, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", rows_in_a_block)
    monkeypatch.setattr(hard_negatives, "STEP", step)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", group)
    monkeypatch.setattr(hard_negatives, "CLUSTER", 5)
    rows = clustered(np.random.default_rng(dim), 400, dim)
    assert mined(frame(spark, rows, extra=True), every=10) == negatives_brute(rows, 10)


def test_sortable_numbers():
    x = [0, 1, -1, 9, 10, -9, -10, 99, 100, -100, 10**60, -10**60, 2**63, -2**63, 123456789]
    assert sorted(x, key=hard_negatives._sortable) == sorted(x)


def test_lists_end_early():
    """Members leave their lists before the end, and what is left could not matter."""
    rng = np.random.default_rng(0)
    q = np.floor(256 * rng.normal(size=(40, 6)) + 2000 * np.eye(6)[rng.integers(0, 6, 40)])
    rows = np.floor(256 * rng.normal(size=(20_000, 6)) + 2000 * np.eye(6)[rng.integers(0, 6, 20_000)])
    a = hard_negatives.Anchors(np.arange(40), np.zeros(40, np.int64), q)
    seen, inner = [], hard_negatives.scores
    try:
        hard_negatives.scores = lambda x, y: (seen.append(len(x) * len(y)), inner(x, y))[1]
        lists = hard_negatives.Lists(40, 5)
        hard_negatives.walk(a, np.arange(40)[:, None], np.full(40, -np.inf), np.full(40, np.inf), True, lists, rows,
                            np.zeros(20_000, np.int64), np.arange(20_000), np.zeros(20_000, np.int8), np.arange(20_000) + 100)
    finally:
        hard_negatives.scores = inner
    best = np.sort(q @ rows.T, axis=1)[:, :-6:-1]
    assert (lists.score.astype(float).reshape(40, 5) == best).all()
    assert sum(seen) < 0.6 * 40 * 20_000


def lists_brute(anchors, slot_of, low, high, same, depth, q, label, ident, gone, uid):
    """[(score, id or None)] of every slot."""
    out = [[] for _ in low]
    for a, slots in enumerate(slot_of):
        score = [sum(int(x) * int(y) for x, y in zip(anchors.q[a].tolist(), row)) for row in q.tolist()]
        rows = sorted((-s, g, 0 if g else i) for s, lab, i, g, u in zip(score, label.tolist(), ident.tolist(), gone.tolist(), uid.tolist())
                      if (lab == anchors.label[a]) == same and not (same and u == anchors.uid[a]))
        for slot in slots[slots >= 0]:
            out[slot] = [(-s, None if g else i) for s, g, i in rows if low[slot] <= -s <= high[slot]][:depth]
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("same", [True, False])
def test_lists_over_blocks_equal_brute_force(seed, same, monkeypatch):
    """Many blocks, copies, ties, null ids, entries beyond single and double precision; clusters that rule out rows and others."""
    rng = np.random.default_rng(seed)
    for name, value in (("TILE", 16), ("SEED", 40), ("PENDING", 30), ("RUN", 4), ("STEP", 8), ("CLUSTER", 6)):
        monkeypatch.setattr(hard_negatives, name, value)
    n, dim, labels = 700, 5, (3, 60)[seed % 2]
    spread = (20, 20, 200, 200, 10**6, 10**10)[seed]
    q = np.floor(spread * (rng.normal(size=(n, dim)) + (seed % 3) * 4 * np.eye(dim)[rng.integers(0, dim, n)]))
    q[rng.integers(0, n, n // 5)] = q[0]
    q[rng.integers(0, n, 5)] = 0
    label, uid = rng.integers(0, labels, n), np.arange(n)
    ident, gone = rng.permutation(n) // 2, (rng.random(n) < 0.1).astype(np.int8)
    ident[gone > 0] = 0
    at = rng.choice(n, 45, replace=False)
    anchors = hard_negatives.Anchors(uid[at], label[at], q[at])
    if same:
        slot_of, low, high = np.arange(45)[:, None], np.full(45, -np.inf), np.full(45, np.inf)
    else:
        slot_of = rng.permutation(90).reshape(45, 2) - 10
        slot_of[slot_of < 0] = -1
        high = np.floor(np.abs(q).max() ** 2 * rng.random(80))
        low = np.floor(high * rng.choice([-0.5, 0.3, 0.999], 80))
    lists = hard_negatives.Lists(len(low), 5)
    for lo in range(0, n, 100):
        part = slice(lo, lo + 100)
        hard_negatives.walk(anchors, slot_of, low, high, same, lists, q[part], label[part], ident[part], gone[part], uid[part])
    got: list[list] = [[] for _ in low]
    for slot, score, g, i, _ in zip(*(x.tolist() for x in lists.held_rows())):
        got[slot].append((int(score), None if g else i))
    assert got == lists_brute(anchors, slot_of, low, high, same, 5, q, label, ident, gone, uid)


def test_evenly_spread_vectors_take_little_time():
    """Where no bound rules anything out, a block costs about its product with the
    anchors, however many lists there are (sorting all of them at each step took 29 s)."""
    rng = np.random.default_rng(1)
    q, rows = (np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]) for v in (rng.normal(size=(1000, 16)), rng.normal(size=(12_000, 16))))
    a, high = hard_negatives.Anchors(np.arange(1000), np.zeros(1000, np.int64), q), np.tile([12e3, 14e3, 16e3, 18e3, 20e3], 1000)
    lists, began = hard_negatives.Lists(5000, 10), time.process_time()
    for lo in range(0, 12_000, 4000):
        part = np.arange(lo, lo + 4000)
        hard_negatives.walk(a, np.arange(5000).reshape(1000, 5), np.zeros(5000), high, False, lists, rows[part], np.ones(4000, np.int64),
                            part, np.zeros(4000, np.int8), part)
    score = lists.score
    assert time.process_time() - began < 10
    best = [[np.sort(s[s <= h])[:-11:-1] for h in high[:5]] for s in q @ rows.T]
    assert (score.astype(float).reshape(1000, 5, 10) == best).all()


def test_negative_edge_rows(spark):
    one, big = [1.0, 0.5], 1e25
    rows = [(0, one, 0), (0, one, 0), (0, one, 1), (None, one, 0), (None, [0.5, 0.25], 1), (100, one, None), (200, None, 0), (300, [], 0),
            (400, [1.0, None], 0), (500, [float("nan"), 1.0], 0), (600, [float("inf"), 1.0], 1), (7, [0.6, 0.2], 1), (8, [0.6, 0.2], 1),
            (9, [0.6, 0.2], 0), (-100, [-1.0, 0.0], 0), (10, [-0.5, 0.0], 1), (700, [1.0, 2.0, 3.0], 0), (701, [1.0, 2.0, 2.0], 0),
            (702, [0.5, 1.0, 1.5], 1), (800, [0.0, 0.0], 0), (900, [-0.0, 0.0], 1)]
    assert mined(frame(spark, rows, extra=True)) == negatives_brute(rows)
    assert mined(frame(spark, [])) == [] and mined(frame(spark, rows[10:12])) == []
    # scores far beyond 64 bits are compared exactly and shown as the largest number
    huge = [(0, [big, 1.0], 0), (1, [big, 2.0], 0), (2, [big, 1.0], 0), (3, [big * 0.5, 3.0], 1), (4, [big * 0.5, 2.0], 1)]
    top = 2**63 - 1
    assert mined(frame(spark, huge)) == sorted([(a, b, c, d, min(e, top), min(f, top)) for a, b, c, d, e, f in negatives_brute(huge)], key=str)


def test_op12_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF2}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in hard_negatives.op12_hard_negatives(spark, SF2).collect()), key=str)
    assert got == negatives_brute(rows) and len(got) > 500


# --------------------------------------------------------------- whitening

def whiten_brute(rows):
    """(ids, x, n, S, eigenvalues, vectors) in exact sums and double precision."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, _ in rows if usable(v)]
    x = np.array([k[1] for k in kept])
    unique = np.unique(x, axis=0)
    n, s = len(unique), unique.sum(axis=0)
    c = (unique * n - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return [k[0] for k in kept], x, n, s, e[::-1], v[:, ::-1]


def check(df, rows, components=16):
    ids, x, n, s, e, v = whiten_brute(rows)
    m = min(components, int((e > 1e-12 * e.sum()).sum()))
    out = df.collect()
    assert len(out) == m * len(ids) and {r.n for r in out} == {n}
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9
    want: dict = {}
    w = ((x * n - s) / n) @ v[:, :m] / np.sqrt(e[:m])
    dev = [sum((n * a - b) ** 2 for a, b in zip(row, s.tolist())) for row in x.tolist()]
    for k, i in enumerate(ids):
        for c in range(m):
            want.setdefault((i, c + 1), []).append((dev[k], w[k, c]))
    sign = {}
    for r in out:
        pairs = want[r.id, r.component]
        near = [(d, y, g) for d, y in pairs for g in (1, -1) if d == r.deviation and abs(y * g - r.whitened) < 1e-7 * max(1, abs(y))]
        assert near, (r, pairs)
        if abs(r.whitened) > 1e-3:
            sign.setdefault(r.component, set()).update({frozenset(g for _, _, g in near)})
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
    assert all(frozenset.intersection(*x) for x in sign.values())        # one sign for all rows


def spread(rng, n, dim):
    """Vectors with distinct deviations in all directions."""
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return (rng.normal(size=(n, dim)) * np.linspace(4, 0.5, dim)) @ turn


@pytest.mark.parametrize("n,dim", [(300, 40), (200, 5), (10, 30), (2, 7)])
def test_whitening_equals_brute_force(spark, n, dim, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    x = spread(np.random.default_rng(n), n, dim)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(0, x[1].tolist(), 0), (None, x[0].tolist(), 1)]
    check(whitening.whiten(frame(spark, rows, extra=True)), rows)


def test_whitening_of_constant_and_dependent_entries(spark):
    x = spread(np.random.default_rng(3), 120, 6)
    x = np.column_stack([x, np.full(120, 3.25), np.floor(64 * x[:, 0]) / 64, np.floor(64 * x[:, 1]) / 64 + 1])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    check(whitening.whiten(frame(spark, rows)), rows)


def test_repeated_deviations_are_found_as_often_as_they_occur(spark):
    """The corners of a cross: the same deviation in every direction."""
    rows = [(2 * d + s, [float(3 * (1 - 2 * s)) if k == d else 0.0 for k in range(6)], 0) for d in range(6) for s in range(2)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert len(out) == 12 * 6 and all(abs(r.explained - 1 / 6) < 1e-9 for r in out) and out[0].identity_error < 1e-9


def test_whitening_edge_rows(spark):
    x = spread(np.random.default_rng(4), 60, 4)
    good = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(100, None, 0), (101, [1.0, None, 2.0, 3.0], 0), (102, [float("nan"), 1.0, 1.0, 1.0], 0), (103, [float("inf"), 1.0, 1.0, 1.0], 0),
           (104, [], 0), (105, [1.0, 2.0], 0), (106, [1e20, 1.0, 1.0, 1.0], 0)]
    check(whitening.whiten(frame(spark, good + bad)), good)
    for few in ([], bad[:5], good[:1] * 3):
        assert whitening.whiten(frame(spark, few)).count() == 0
    far = good + [(200, [1e9, 1.0, 1.0, 1.0], 0)]                       # squares beyond 64 bits
    out = {r.id: r.deviation for r in whitening.whiten(frame(spark, far)).where("component = 1").collect()}
    assert out[200] is None and len(out) == 61


def test_fewer_steps_are_checked(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([100 * rng.normal(size=200), 10 * rng.normal(size=200), *[rng.normal(size=200) / 10 for _ in range(20)]])
    rows = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    full = {(r.id, r.component): abs(r.whitened) for r in whitening.whiten(rows, components=2).collect()}
    some = {(r.id, r.component): abs(r.whitened) for r in whitening.whiten(rows, components=2, steps=12).collect()}
    assert full.keys() == some.keys() and all(abs(full[k] - some[k]) < 1e-6 for k in full)
    with pytest.raises(ValueError, match="allow more steps"):
        whitening.whiten(rows, components=16, steps=16)


def test_op13_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(whitening.op13_embedding_whitening(spark, SF).withColumnRenamed("vec_id", "id"), rows)
