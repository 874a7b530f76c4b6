"""Personal data, secrets, decontamination against regular-expression versions."""

import random

import pytest

from lakenorm.llm import decontaminate, pii, secret_scan
from lakenorm.llm.common import scratch

from .helpers import contamination_brute, digest, docs, spans_brute

SF = "/root/testdata/sf0.001"


def luhn_ok(m):
    d = [int(c) for c in m.group() if c.isdigit()]
    if not 12 <= len(d) <= 19:
        return False
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn_ok),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m.group()) <= 15),
]
ALPHABET = ["a", "B.", "x@y.de", "@", ".", "a@b", "1", "12", "255.1.2.3", "999.1.2.3.4", "+", "+49 ", "(0)", "-", " ", " ",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "0000000000000", "é\U0001f600", "\n", "+1 555 123-4567", "1.2", "2.3.4"]


def random_texts(parts, n=300, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_pii_equals_plain_patterns():
    for t in random_texts(ALPHABET) + [None, "", "a" * 5000 + "@b.c", "1" * 3000, "@" * 50, "1.1.1.1.1.1.1.1"]:
        want = spans_brute(t, PII)
        got = [(s, pii.BASE.index(k), e, k) for s, e, k, _ in pii.find_pii(t) if k in pii.BASE]
        assert got == want, t


def test_pii_added_kinds_need_checksum_and_context():
    good, bad = "IBAN DE89 3704 0044 0532 0130 00 here", "IBAN DE88 3704 0044 0532 0130 00 here"
    assert [k for *_, k, _ in pii.find_pii(good) if k == "iban"] == ["iban"]
    assert not [k for *_, k, _ in pii.find_pii(bad) if k == "iban"]
    assert "ssn" in [k for _, _, k, _ in pii.find_pii("social security 123-45-6789")]
    assert "ssn" not in [k for _, _, k, _ in pii.find_pii("part 123-45-6789")]
    (low,), (high,) = pii.find_pii("x 10.0.0.1"), pii.find_pii("server address 10.0.0.1")
    assert low[3] < high[3]


def test_pii_context_is_whole_words_by_distance():
    of = lambda t, k: [s for *_, kind, s in pii.find_pii(t) if kind == k]
    for text, kind in (("shipping to 10.0.0.1", "ip"), ("the chips 10.0.0.1", "ip"), ("hotel +49 30 1234567", "phone"), ("x" * 60 + "hostip 10.0.0.1", "ip")):
        assert of(text, kind) == [pii.PRIOR[kind]], text
    assert of("a stubborn reborn 1990-01-02", "birth_date") == []           # no word of its own
    assert of("born 1990-01-02", "birth_date") and of("1990-01-02 born", "birth_date") and of("Born: on 1990-01-02", "birth_date")
    assert of("born a b c d 1990-01-02", "birth_date") == []                # too far
    near, far = of("server 10.0.0.1", "ip")[0], of("server a b c d e 10.0.0.1", "ip")[0]
    assert pii.PRIOR["ip"] < far < near == pii.PRIOR["ip"] + pii.BOOST
    # a word cut by the window is no word: "...ship" + context
    text = "ship" + "-" * (pii.CONTEXT - 2) + "10.0.0.1"
    assert of(text, "ip") == [pii.PRIOR["ip"]]


def test_op2_equals_plain_patterns_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in pii.op2_pii(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        want = spans_brute(t, PII)
        assert (got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone) == tuple(sum(n == k for *_, n in want) for k in pii.BASE)
        assert got[d].base_sha256 == digest(want)
        every = pii.find_pii(t)
        assert got[d].spans == ",".join(f"{k}:{a}:{b}" for a, b, k, _ in every) and got[d].n_added == len(every) - len(want)
        assert got[d].top_score == max((x for *_, x in every), default=0.0)


def test_pii_linear_on_long_runs():
    for t in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "+1" * 100_000, "1.1.1." * 50_000):
        pii.find_pii(t)


def test_op2_digest_and_edge_rows(spark):
    texts = ["mail a@b.de, 10.0.0.1", None, "", "mail a@b.de, 10.0.0.1", (None, "x@y.z"), "é +49 30 1234567"]
    rows = [tuple(r) for r in pii.detect_pii(docs(spark, texts, extra=True)).collect()]
    assert len(rows) == 6 and sum(r[0] is None for r in rows) == 1
    assert pii.detect_pii(docs(spark, [])).count() == 0
    out = pii.op2_pii(spark, SF)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in out.collect():
        base = spans_brute(texts[r.doc_id], PII)
        assert r.base_sha256 == digest(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in base) for k in pii.BASE]
        assert {f"{n}:{a}:{b}" for a, _, b, n in base} <= set(r.spans.split(",")) | {""}


ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
          r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
SECRETS = [("assign", ASSIGN, lambda m: len(m.group(2)) >= 6), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
           ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24)]
SECRET_PARTS = ["token", "Token = ", "password:", "api_key='", "APIKEY=", "secret", "=", "\"", "'", " ", "abcdef", "x1", "AKIA",
                "ABCDEFGHIJKLMNOP", "0123456789abcdef0123456789", "deadbeef", "ſecret=abcdefg", "\U0001f600", "\n", "toKen=abcdefg", "=="]


def secret_rows(spark, texts):
    v, found = secret_scan.scan_secrets(docs(spark, texts, extra=True), scratch(spark, "t"), path="doc_id")
    return {r.path: [s for s in (r.spans or "").split(",") if s and not s.startswith(("private", "bearer"))]
            for r in v.join(secret_scan.digest(found), "blob", "left").collect()}


def test_secrets_equal_plain_patterns(spark):
    texts = [*random_texts(SECRET_PARTS, 250), None, "", "token=ab token=token:abcdef", "a" * 100_000, "\0token=abcdefg"]
    got = secret_rows(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == [f"{n}:{a}:{b}" for a, _, b, n in spans_brute(t, SECRETS)], t


def test_secret_ledger_scans_only_unseen_pairs(spark):
    ledger = scratch(spark, "ledger")
    first = docs(spark, ["token = abcdef1", "nothing", "token = abcdef1"])
    secret_scan.scan_secrets(first, ledger, path="doc_id")
    n = len(secret_scan.RULES)
    assert secret_scan.read_ledger(spark, ledger).count() == 2 * n          # two blobs
    more = docs(spark, [(7, "token = abcdef1"), (8, "password: 1234567")])
    v, found = secret_scan.scan_secrets(more, ledger, path="doc_id")
    assert secret_scan.read_ledger(spark, ledger).count() == 3 * n          # one new blob
    assert {r.path for r in v.join(found, "blob").collect()} == {7, 8}      # old findings reach the new path
    newer = [secret_scan.Rule("assign", r"token\x20=\x20([a-z0-9]+)", "token", group=1, least=3, version=2)]
    secret_scan.scan_secrets(more, ledger, path="doc_id", rules=newer)
    assert secret_scan.read_ledger(spark, ledger).where("rule = 'assign' and version = 2").count() == 2


def test_secrets_empty_table_and_native_plan(spark):
    v, found = secret_scan.scan_secrets(docs(spark, []), scratch(spark, "ledger"), path="doc_id")
    assert v.count() == 0 and found.count() == 0
    plan = secret_scan.op5_secret_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


BENCH = [(1, "One two three"), (2, " ".join(f"w{i}" for i in range(20))), (3, None), (4, "?! --"), (5, "one TWO three"), (11, "Élan vital")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_contamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(1)
    pool = ["one", "Two", "three", ",", "élan", "vital", "x", "w1 w2", "ONE two"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    texts += [None, "", "...", " ".join(f"w{i}" for i in range(20)), "zero " + " ".join(f"W{i}" for i in range(3, 18)) + "!", "onetwo three"]
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.find_contamination(docs(spark, texts, extra=True), items, block_bytes=block_bytes)
    want = contamination_brute(list(enumerate(texts)), BENCH)
    for r in got.collect():
        assert (r.n_words, r.n_hit, list(r["items"])) == want[r.id], texts[r.id]
        t, hit = texts[r.id], 0
        for s in r.spans:                       # offsets name the original words
            hit += s.last_word - s.first_word + 1
        assert hit == r.n_hit
    none = decontaminate.find_contamination(docs(spark, texts), items.limit(0))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(texts)
    assert decontaminate.find_contamination(docs(spark, []), items).count() == 0


@pytest.mark.parametrize("size,around", [(13, 16), (13, 1), (4, 16), (5, 2), (1, 16), (2, 16)])
def test_automaton_equals_brute_force(size, around, monkeypatch):
    """Windows of several sizes over few words; with ``AROUND`` 1 through the tables."""
    monkeypatch.setattr(decontaminate, "AROUND", around)
    rng = random.Random(size)
    item = lambda n: [rng.choice(b"abc"[:rng.randint(1, 3)].decode()).encode() for _ in range(n)]
    items = [(str(i % 30), item(rng.randint(0, 30))) for i in range(40)]
    scan = decontaminate.Automaton(items, size)
    owners: dict = {}
    for key, w in items:
        for i in range(max(1, len(w) - size + 1) if w else 0):
            owners.setdefault(tuple(w[i:i + size]), set()).add(key)
    for _ in range(200):
        w = item(rng.randint(0, 40)) + [b"zz"] * rng.randint(0, 1) + item(rng.randint(0, 25))
        hit, keys = set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in owners:
                    hit |= set(range(i, i + n))
                    keys |= owners[tuple(w[i:i + n])]
        count, spans, found = scan(b" ".join(w).decode())
        assert count == len(w) and found == keys
        assert {x for a, b in spans for x in range(a, b)} == hit


def test_parts_hold_every_window_once():
    for n in range(0, 40):
        w = [str(i).encode() for i in range(n)]
        got = [tuple(p[i:i + 5]) for p in decontaminate.parts(w, 5, 7) for i in range(max(1, len(p) - 4))]
        assert got == [tuple(w[i:i + 5]) for i in range(max(1, n - 4) if n else 0)]


def test_automaton_of_a_full_block_stays_below_its_memory():
    """8 MB of benchmark in words that are all invented, in a process of its own."""
    import subprocess
    import sys
    code = """
import random, resource, sys
sys.path.insert(0, %r)
from lakenorm.llm.decontaminate import Automaton
rng = random.Random(1)
items, size = [], 0
while size < 8 << 20:
    w = ["%%x" %% rng.getrandbits(20) for _ in range(200)]
    size += sum(map(len, w)) + 200
    items.append((str(len(items)), [x.encode() for x in w]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
scan = Automaton(items)
used = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
key, w = items[77]
assert scan((b"x y " + b" ".join(w[30:60]) + b" z").decode()) == (33, [(2, 32)], {key})
print(round(used))
""" % sys.path[0]
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) < 500, out.stdout


def test_contamination_of_each_row_with_several_blocks(spark):
    """Null and repeated ids, equal rows: the same rows whatever the number of blocks."""
    rows = [(1, "one two three"), (1, "x y z"), (1, "x y z"), (1, None), (1, None), (None, "élan vital here"), (None, "clean"),
            (None, None), (None, "one two three and " + " ".join(f"w{i}" for i in range(20))), (2, ""), (2, "one two three")]
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    one, many = [sorted(map(str, decontaminate.find_contamination(docs(spark, rows), items, block_bytes=n).collect()))
                 for n in (1 << 20, 20)]
    assert len(many) == len(rows) and many == one


def test_contamination_offsets_in_the_original(spark):
    text = "Ünder: One,  TWO three! end"
    r = decontaminate.find_contamination(docs(spark, [text]), spark.createDataFrame(BENCH, "item_id long, text string")).first()
    assert [text[s.start:s.end] for s in r.spans] == ["One,  TWO three"]
    assert decontaminate.contaminated(1, 20) and not decontaminate.contaminated(1, 21) and not decontaminate.contaminated(0, 0)
