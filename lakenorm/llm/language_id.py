"""Language identification by fusing Bayesian evidence.

* Text: log-likelihood of the hashed byte trigrams under one smoothed model per
  language, fitted on a bounded sample of labelled rows (about ``TRAIN_ROWS``
  for each label, all rows of a rarer one, so every label has a model),
  and a background class ``und`` for text in none of them. Trigrams of a text
  are not independent, so a text counts as at most ``EFFECTIVE`` of them.
* Declared language (markup attribute or metadata): likelihood of the
  declaration given the language, counted over all rows.
* Host: a prior per host from grouped sums of the text posteriors, smoothed
  towards its domain's, that towards its address suffix's, that towards the
  global one (``KAPPA`` rows of pseudo-counts each; a row's own vote is taken
  out of its host first).

The likelihoods are computed in one pass and written; the sums are grouped
aggregates with map-side combining, so a host that holds a third of all rows
costs one row per task, and the join back carries no text.

Languages are primary subtags: labels, declarations and markup all go through
``primary_tag`` (``en-US`` is ``en``; ``fi`` and ``fil`` are two; ``eng`` is not ``en``).
Evidence is kept in one array per row, a number per class, and votes are summed
in rows of (place, class), so plans do not grow with the languages. The model is
a table of ``BUCKETS`` x languages; more than ``MOST_LANGUAGES`` different labels
are no languages, and an error.

Defined results: a label that is no language tag is none; a null, empty or letterless text has no text evidence and is
rejected (``und``); a null host, domain, suffix or declaration is a group of
its own without weight; every input row gives a row; an empty table, or one
without a labelled row, gives ``und`` for all rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, named, pieces, slices, stage, table

BUCKETS = 1 << 16
TRAIN_ROWS = 4000
EFFECTIVE = 120
KAPPA = 20.0
ALPHA = 0.05
PART = 1 << 20
#: Log-probability of a trigram outside all languages: uniform over 26 letters and the space.
BACKGROUND = -math.log(27.0 ** 3)
ACCEPT = 0.3
MOST_LANGUAGES = 1000
VOTE = 1e-12                    # a smaller share of a row's vote is none

#: Texts with a trigram: two letters in a row, or one beyond ASCII (several bytes).
LETTERS = r"[A-Za-z]{2}|[^\x00-\x7F]"

_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def primary_tag(column) -> Column:
    """Primary subtag of a language tag, in lower case; null if it is none."""
    tag = F.regexp_extract(F.lower(F.trim(column)), r"^([a-z]{2,8})(?:[-_].*)?$", 1)
    return F.nullif(tag, F.lit(""))


def trigrams(texts: list):
    """Runs of bounded size: (bucket of every trigram, 0 = none; number of the
    text, start and length of each of its parts). Long texts are cut into parts
    that overlap by two bytes, so every trigram is in exactly one."""
    parts: list[tuple[int, bytes]] = []
    for i, t in enumerate(texts):
        b = b" " + (t or "").encode("utf-8", "surrogatepass").translate(_FOLD) + b" "
        parts += [(i, b[x:x + PART + 2]) for x in range(0, len(b) - 1, PART)]
    for first, run in pieces([b for _, b in parts]):
        a = np.frombuffer(b"".join(run) + b"  ", np.uint8).astype(np.uint32)
        code = a[:-2] << 16 | a[1:-1] << 8 | a[2:]
        bucket = (code * np.uint32(2654435761) >> np.uint32(16)) & np.uint32(BUCKETS - 1)
        space = a == 32
        bucket[(space[1:-1]) | (space[:-2] & space[2:])] = 0
        size = np.array([len(t) for t in run])
        end = np.cumsum(size)
        bucket[end - 2] = bucket[end - 1] = 0       # these reach into the next part
        yield bucket, [i for i, _ in parts[first:first + len(run)]], end - size, size


def fit(sample: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [bucket, language]) from labelled rows."""
    def counts(it):
        for b in slices(it, "text"):
            labels = b.column("label").to_pylist()
            sums: dict = {}
            for bucket, owner, start, size in trigrams(b.column("text").to_pylist()):
                for i, x, n in zip(owner, start, size):
                    if labels[i]:
                        sums.setdefault(labels[i], np.zeros(BUCKETS, np.int64))
                        np.add.at(sums[labels[i]], bucket[x:x + n], 1)
            for k, c in sums.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(at)), pa.array(at), pa.array(c[at])], ["label", "bucket", "c"])

    src = named(sample, text=text, label=label).select("text", primary_tag(F.col("label")).alias("label"))
    rows = (src.where("label is not null").mapInArrow(counts, "label string, bucket long, c long")
            .groupBy("label", "bucket").agg(F.sum("c").alias("c")).where("bucket > 0").toArrow())
    langs = sorted(pc.unique(rows["label"]).to_pylist())
    _few(len(langs))
    c = np.full((BUCKETS, len(langs)), ALPHA)
    c[rows["bucket"].to_numpy(), pc.index_in(rows["label"], pa.array(langs, pa.string())).to_numpy()] += rows["c"].to_numpy()
    logp = np.log(c / c.sum(axis=0))
    logp[0] = 0
    return langs, np.column_stack([logp, np.full(BUCKETS, BACKGROUND) * (np.arange(BUCKETS) > 0)]).astype(np.float32)


def _few(n: int) -> None:
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} different labels: more than {MOST_LANGUAGES} are no languages")


def likelihoods(texts: list, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tempered log-likelihoods [text, class], trigrams per text)."""
    ll, n = np.zeros((len(texts), logp.shape[1])), np.zeros(len(texts), np.int64)
    for bucket, owner, start, _ in trigrams(texts):
        np.add.at(n, owner, np.add.reduceat((bucket > 0).astype(np.int64), start))
        np.add.at(ll, owner, np.add.reduceat(logp[bucket], start, axis=0, dtype=np.float64))
    return ll * (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))[:, None], n


def identify(rows: DataFrame, languages: list[str], logp: np.ndarray, accept: float = ACCEPT) -> DataFrame:
    """``rows(id, text, declared, host, domain, suffix)`` ->
    ``(id, language, posterior, text_language, declared, accepted)``."""
    spark = rows.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(logp)      # 65,536 x (languages + 1) floats
    classes = [*languages, "und"]
    k = len(classes)
    places = ["host", "domain", "suffix"]

    def batches(it):
        for b in slices(it, "text"):
            ll, n = likelihoods(b.column("text").to_pylist(), model.value)
            p = np.exp(ll - ll.max(axis=1, keepdims=True)) if len(ll) else ll
            p = p / p.sum(axis=1, keepdims=True) if len(ll) else p
            p[n == 0] = 0
            at = pa.array(np.arange(len(ll) + 1, dtype=np.int32) * k)
            of = lambda x: pa.ListArray.from_arrays(at, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("declared"), *[b.column(c) for c in places], pa.array(n, pa.int64()), of(ll), of(p)],
                ["id", "declared", *places, "n", "l", "p"])

    known = primary_tag(F.col("declared"))
    src = rows.select("id", "text", F.when(known.isin(languages), known).alias("declared"),
                      *[F.col(c).cast("string").alias(c) for c in places])
    feats = stage(src.mapInArrow(batches, f"id {src.schema['id'].dataType.simpleString()}, declared string, host string, "
                                          "domain string, suffix string, n long, l array<double>, p array<double>"), "language")

    # votes: a row per class a row of text may be in; sums per group and class, then one row per group
    voted = F.filter(F.transform("p", lambda v, i: F.struct(i.alias("c"), v.alias("v"))), lambda e: e["v"] > VOTE)
    votes = feats.select(*places, "declared", F.explode(voted).alias("e")).select(*places, "declared", "e.c", "e.v")

    def dense(sums: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at(sums, i), F.lit(0.0)))

    def per_group(sums: DataFrame, keys: list[str], name: str) -> DataFrame:
        """``(k_<key>..., <name> array, <name>_n)`` of rows ``(keys..., c, v)``."""
        each = sums.groupBy(*keys, "c").agg(F.sum("v").alias("v"))
        one = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("c", "v"))).alias("m"), F.sum("v").alias(f"{name}_n"))
        return one.select(*[F.col(c).alias(f"k_{c}") for c in keys], dense(F.col("m")).alias(name), f"{name}_n")

    def on(keys: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in keys])

    literal = lambda x: F.array(*[F.lit(float(v)) for v in x])

    # likelihood of each declaration: a row per language declared
    said = stage(per_group(votes.where("declared is not null"), ["declared"], "d"), "language-declared")
    total = [0.0] * k
    for r in said.select(F.posexplode("d").alias("c", "v")).groupBy("c").agg(F.sum("v").alias("v")).collect():
        total[r.c] = r.v
    said = said.select("k_declared", F.zip_with("d", literal(t + len(languages) for t in total),
                                                lambda v, t: F.log((v + 1) / t)).alias("said"))

    # host priors: host within domain within suffix within all
    hosts = stage(votes.groupBy(*places, "c").agg(F.sum("v").alias("v")), "language-hosts")
    overall = {r.c: r.v for r in hosts.groupBy("c").agg(F.sum("v").alias("v")).collect()}
    mass = sum(overall.values()) + k
    prior = per_group(hosts, places, "h").select(*[F.col(f"k_{c}").alias(c) for c in places], "h")
    prior = prior.withColumn("q", literal((overall.get(i, 0.0) + 1) / mass for i in range(k)))
    for key in (["suffix"], ["domain", "suffix"]):
        up = per_group(hosts, key, "u")
        within = F.zip_with("u", "q", lambda u, q: (u + KAPPA * q) / (F.col("u_n") + KAPPA))
        prior = prior.join(up, on(key), "left").select(
            *places, "h", F.when(F.col(key[0]).isNull(), F.col("q")).otherwise(within).alias("q"))
    prior = stage(prior.select(*[F.col(c).alias(f"k_{c}") for c in places], "h", "q"), "language-priors")
    even = literal((overall.get(i, 0.0) + 1) / mass for i in range(k))
    j = feats.join(prior, on(places), "left").join(said, on(["declared"]), "left")
    # a host without any vote (no text in it) has the prior of all; the sums of all classes are left out: they shift all scores alike
    own = F.zip_with(F.zip_with("h", "p", lambda h, p: F.greatest(h - p, F.lit(0.0))), "q", lambda o, q: o + KAPPA * q)
    p = F.when(F.col("q").isNull(), even).when(F.col("host").isNull(), F.col("q")).otherwise(own)
    score = F.zip_with("l", p, lambda a, b: a + F.log(b))
    score = F.when(F.col("said").isNull(), score).otherwise(F.zip_with(score, "said", lambda a, b: a + b))
    j = j.select("id", "n", "declared", "l", score.alias("s"))
    first = lambda c: F.array_max(F.transform(c, lambda v, i: F.struct(v.alias("s"), i.alias("i"))))
    j = j.select("id", "n", "declared", "s", first("s").alias("best"), first("l")["i"].alias("seen"))
    name = lambda i: F.get(F.array(*[F.lit(c) for c in classes]), i)
    spread = F.aggregate("s", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("best.s")))
    some = F.col("n") > 0
    j = j.select("id", F.when(some, name(F.col("best.i"))).otherwise(F.lit("und")).alias("language"),
                 F.when(some, 1 / spread).otherwise(F.lit(0.0)).alias("posterior"),
                 F.when(some, name(F.col("seen"))).otherwise(F.lit("und")).alias("text_language"), "declared")
    return j.withColumn("accepted", (F.col("language") != "und") & (F.col("posterior") >= accept))


def sample_rows(df: DataFrame, label: str, at_most: int = TRAIN_ROWS) -> DataFrame:
    """About ``at_most`` rows of each label to fit on; all of a label with no more."""
    counts = df.groupBy(label).count().limit(MOST_LANGUAGES + 1).collect()
    _few(len(counts))
    return df.sampleBy(label, {r[label]: min(1.0, at_most / r["count"]) for r in counts}, seed=5)


def document_evidence(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """A document declares ``lang`` and its source stands for the host."""
    d = named(docs, id=id_column, text="text", declared="lang", host="source")
    none = F.lit(None).cast("string")
    return d.select("id", "text", "declared", "host", none.alias("domain"), none.alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Markup attribute, host, registered domain and address suffix of a page."""
    p = named(pages, id="page_id", url="url", html="html")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    labels = F.split(F.col("host"), r"\.")
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")
    return (p.select("id", "html", F.nullif(host, F.lit("")).alias("host"))
            .select("id", body.alias("text"),
                    primary_tag(F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z][a-z0-9_-]*)", 1)).alias("declared"),
                    "host", F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("domain"),
                    F.element_at(labels, -1).alias("suffix")))


def fitted_on_documents(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    labelled = named(docs, text="text", lang="lang").select("text", primary_tag(F.col("lang")).alias("lang"))
    labelled = labelled.where(F.col("text").rlike(LETTERS) & F.col("lang").isNotNull())
    return fit(sample_rows(labelled, "lang"), "text", "lang")


def identify_documents(docs: DataFrame) -> DataFrame:
    return identify(document_evidence(docs), *fitted_on_documents(docs))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language and whether it is accepted."""
    r = identify_documents(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "language", F.round("posterior", 6).alias("posterior"),
                    "text_language", "declared", "accepted")


def op3_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page, with the markup, suffix and host evidence a page has."""
    model = fitted_on_documents(table(spark, sf_dir, "documents"))
    r = identify(page_evidence(table(spark, sf_dir, "pages")), *model)
    return r.select(F.col("id").alias("page_id"), "language", F.round("posterior", 6).alias("posterior"),
                    "text_language", "declared", "accepted")


QUERIES = {"op3_language_id": op3_language_id, "op3_language_id_pages": op3_language_id_pages}
ORACLE: dict[str, str] = {}
