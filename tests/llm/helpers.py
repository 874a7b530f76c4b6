"""Brute-force versions and small frames for the operators of lakenorm.llm."""

from __future__ import annotations

import collections
import hashlib
import re

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra: bool = False):
    """A documents table: ``texts`` are texts or (id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    if not extra:
        return spark.createDataFrame(full, DOCS)
    # columns named like those the operators make, also by case
    more = ", id string, key long, n int, rep string, spans string, TEXT string, g int, _f int, row string"
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z", "other", 3, 4, "w") for r in full], DOCS + more)


class Union:
    def __init__(self, keys):
        self.up = {k: k for k in keys}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def spans_brute(text, rules):
    """``rules``: (name, pattern, test on the match) -> sorted (start, rank, end, name)."""
    found = []
    for rank, (name, pattern, ok) in enumerate(rules):
        found += [(m.start(), rank, m.end(), name) for m in re.finditer(pattern, text or "") if ok(m)]
    return sorted(found)


def digest(spans):
    return hashlib.sha256(",".join(f"{n}:{a}:{b}" for a, _, b, n in spans).encode()).hexdigest()


def repeats_brute(rows, length=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per row of texts."""
    raw = [(t or "").encode() for t in rows]
    count = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_brute(rows, size=4, percent=85):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {d: shingles(t, size) for d, t in rows}
    u, post = Union(sets), collections.defaultdict(list)
    for d, s in sets.items():
        shared = collections.Counter(j for x in s for j in post[x])
        for j, i in shared.items():
            if 100 * i >= percent * (len(s) + len(sets[j]) - i):
                u.join(d, j)
        for x in s:
            post[x].append(d)
    return {d: (len(s), u.find(d)) for d, s in sets.items()}


def words_brute(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def contamination_brute(rows, items):
    """{doc_id: (n_words, n_hit, sorted item ids)}."""
    owners = collections.defaultdict(set)
    for key, text in items:
        w = words_brute(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            owners[tuple(w[i:i + 13])].add(str(key))
    sizes = {len(k) for k in owners}
    out = {}
    for d, text in rows:
        w, hit, keys = words_brute(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                k = owners.get(tuple(w[i:i + n]))
                if k:
                    keys |= k
                    hit |= set(range(i, i + n))
        out[d] = (len(w), len(hit), sorted(keys))
    return out
