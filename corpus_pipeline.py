"""Corpus pipeline over ``documents``: each stage takes what its predecessor
kept, decides with one of the operators of ``lakenorm.llm``, and its result is
written as Parquet and read again before the next.

1. language ID: documents without an accepted language go;
2. n-gram Jaccard join: of every group of linked documents the one with the
   smallest id stays (a repeated row counts once);
3. benchmark decontamination: documents with a twentieth of their words inside
   benchmark windows go;
4. secret scans: documents with a finding of a base rule go;
5. packing: what is left becomes pieces of full windows.

A document is a row as told by its id, text, language and source: rows equal in
these are one document, and every filter decides for it by the hash of all four
(``key``), so a row without an id, or one that shares its id with another text, is
judged by what it holds like any other. Of rows that are one document the n-gram
Jaccard join keeps one; it prefers the smallest id, rows without an id come last.
Near copies are linked by the general rule, five words and a similarity of 0.8.
The filters only subtract, and every column passes through as it is. Keys to drop
are written first and joined; only texts whose key's hash is among theirs are shuffled. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakenorm.llm.common import scratch, stage, table
from lakenorm.llm.decontaminate import contaminated, find_contamination
from lakenorm.llm.language_id import document_evidence, fitted_on_documents, identify
from lakenorm.llm.ngram_join import Rule, jaccard_components
from lakenorm.llm.packing import pack_documents
from lakenorm.llm.secret_scan import scan_secrets


NEAR = Rule(size=5, percent=80)
KEYED_BY = ("doc_id", "text", "lang", "source")


def _values(docs: DataFrame) -> list[Column]:
    """The four columns by their exact names, whatever else is there."""
    flat = {c: i for i, c in enumerate(docs.columns)}
    return [F.col(f"_{flat[c]}") for c in KEYED_BY]


def keyed(docs: DataFrame) -> DataFrame:
    """``(key, doc_id, text, lang, source)``: ``key`` names the document in 128 bits."""
    return _keyed_rows(docs).select("key", *[v.alias(c) for v, c in zip(_values(docs), KEYED_BY)])


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, named by position, and ``key`` behind them."""
    flat = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    mark = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("-")) for v in _values(docs)]
    return flat.withColumn("key", F.md5(F.concat_ws("\x1f", *mark)))


FILTER = 1 << 18


def _without(docs: DataFrame, keys: DataFrame, label: str, once: DataFrame | None = None) -> DataFrame:
    """All rows of ``docs`` but those with a key of ``keys(key)``, and one row only
    of each key of ``once(key)``. A filter of at most ``FILTER`` hash values is
    broadcast first: rows outside it stay without a shuffle of their text."""
    drop = stage(keys.distinct(), label).select(F.col("key").alias("drop"))
    some = drop if once is None else drop.unionByName(once.select(F.col("key").alias("drop")))
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER)).cast("int")
    near = F.broadcast(stage(some.select(of("drop").alias("near")).distinct(), f"{label}-filter"))
    rows = _keyed_rows(docs)
    touched = rows.join(near, of("key") == F.col("near"), "left_semi").join(drop, F.col("key") == F.col("drop"), "left_anti")
    if once is not None:
        touched = touched.dropDuplicates(["key"])       # keys that occur once are not changed by it
    kept = rows.join(near, of("key") == F.col("near"), "left_anti").unionByName(touched)
    return kept.drop("key").toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = keyed(docs)
    found = identify(document_evidence(d, "key"), *fitted_on_documents(d))
    return _without(docs, found.where("not accepted").select(F.col("id").alias("key")), "no-language")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = keyed(docs).select("key", "doc_id", "text", F.xxhash64("key").alias("node"))
    linked = jaccard_components(d, "node", "text", NEAR).select("id", "component_id").distinct()
    rows = stage(d.select("key", "doc_id", "node").groupBy("key", "doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
                 .join(linked, F.col("node") == F.col("id")), "near-rows")
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))["key"].alias("stays"))
    copies = rows.join(stage(first, "near-first"), "component_id").where("key <> stays").select("key")
    several = stage(rows.where("n > 1").select("key"), "near-repeated")     # rows that are one document
    return _without(docs, copies, "near-copies", several)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_contamination(keyed(docs), table(spark, sf_dir, "benchmark"), id_column="key")
    return _without(docs, found.where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("id").alias("key")), "contaminated")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    versions, found = scan_secrets(keyed(docs), scratch(spark, "pipeline-ledger"), path="key")
    leaks = stage(found.where(F.col("rule").isin("assign", "access", "hex")).select("blob").distinct(), "leaks")
    return _without(docs, versions.join(leaks, "blob", "left_semi").select(F.col("path").alias("key")), "with-secrets")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: The tokens and the retrieval of the last stage are not expressible in SQL;
#: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        out = scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        step(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
