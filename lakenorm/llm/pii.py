"""Personal data: patterns propose, checksums confirm, context words rescore.

A pattern per kind proposes spans of the whole text; a validator (Luhn for
card numbers, mod 97 for IBANs, octet range, digit counts) drops what fails;
whole words of context near a span, before or behind it, raise its score, the
nearer the more.
Base kinds keep every span that their checksum confirms, whatever the score;
the added kinds (iban, ssn, birth date) need a score of ``THRESHOLD``.

Rows are independent: one pass over the text in Arrow batches, no shuffle, so
neither a hot source nor groups of copies matter. Work per text is linear: the
address search starts at '@' and digit runs are entered only at their start,
so a text of a million letters or digits costs one scan.

Defined results: a null text is the empty text (no spans); repeated rows and
ids each give a row; positions are code points, end exclusive.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, named, slices, table

CONTEXT = 48
THRESHOLD = 0.6

# fixed patterns of the base kinds
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# added kinds
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
BIRTH = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])")

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "ssn", "birth_date")

#: Score of a confirmed span without context, and the words that raise it.
PRIOR = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "birth_date": 0.2}
WORDS = {
    "email": {"mail", "mails", "email", "emails", "contact", "write", "reach", "schreib", "schreiben", "kontakt", "correo", "courriel"},
    "ip": {"ip", "ipv4", "host", "server", "address", "addr", "adresse", "direccion"},
    "card": {"card", "cards", "visa", "mastercard", "amex", "credit", "kreditkarte", "karte", "carte", "tarjeta"},
    "phone": {"phone", "telephone", "call", "tel", "mobile", "cell", "fax", "telefon", "telefonnummer", "handy", "telefono"},
    "iban": {"iban", "account", "bank", "konto", "kontonummer", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "birth_date": {"born", "birth", "birthday", "dob", "birthdate", "geboren", "geburtsdatum", "nacido", "nacida", "naissance"},
}
#: Whole words only: a run of letters (with digits inside) that no letter precedes.
WORD = re.compile(r"(?<![^\W_])[^\W\d_][^\W_]*")
NEAR = 3                        # words that count in full; farther ones count NEAR / distance
BOOST = 0.4


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    if not 15 <= len(iban) <= 34:
        return False
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    at = 0
    while m := IP.search(text, at):
        at = m.end()
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def _ibans(text: str):
    for m in IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            yield m.span()


PROPOSE = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
           "ssn": lambda t: (m.span() for m in SSN.finditer(t)),
           "birth_date": lambda t: (m.span() for m in BIRTH.finditer(t))}


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, raised by its nearest context word within ``CONTEXT``
    characters before the span or half as many behind it, the less the more words
    lie between."""
    wanted, best = WORDS[kind], 0.0
    before = [m.group().lower() for m in WORD.finditer(text, max(0, start - CONTEXT), start)][::-1]
    behind = [m.group().lower() for m in WORD.finditer(text, end, min(len(text), end + CONTEXT // 2))]
    for words in (before, behind):
        at = next((i for i, w in enumerate(words, 1) if w in wanted), None)
        if at:
            best = max(best, min(1.0, NEAR / at))
    return min(1.0, PRIOR[kind] + BOOST * best)


def find_pii(text: str | None) -> list[tuple[int, int, str, float]]:
    """``(start, end, kind, score)`` by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    found = []
    for rank, kind in enumerate(KINDS):
        for start, end in PROPOSE[kind](text):
            s = score(text, kind, start, end)
            if kind in BASE or s >= THRESHOLD:
                found.append((start, rank, end, kind, s))
    return [(start, end, kind, s) for start, _, end, kind, s in sorted(found)]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("value", T.StringType())])


def detect_pii(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans array<struct<kind, start, end, score, value>>)`` per input row."""
    bounded_batches(df.sparkSession)
    src = named(df, id=id_column, text=text)
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64()), ("value", pa.string())]))

    def batches(it):
        for b in slices(it, "text"):
            out = [[{"kind": k, "start": s, "end": e, "score": p, "value": t[s:e]} for s, e, k, p in find_pii(t)]
                   for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, arrow)], ["id", "spans"])

    return src.mapInArrow(batches, schema)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


QUERIES = {"op2_pii": op2_pii}
ORACLE: dict[str, str] = {}
