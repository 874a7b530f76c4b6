"""Secret scans with an incremental blob ledger (built-in functions only).

Every version of every path is addressed by the SHA-256 of its content. The
ledger, a Parquet table in the shared folder, has one row per (blob, rule,
rule version) that was ever scanned. A run scans only the pairs it does not
hold yet: a blob seen before costs one hash, a new rule version rescans only
for that rule. Findings are joined back to all paths that hold the blob.

A ledger row stores, for one rule, the lengths of the gaps between matches, of
the matches and of their checked group (in code points), so positions are
running sums, made later over the few blobs that have matches.

Defined results: a null text is the empty text; a path may be null or occur
several times (each row keeps its findings); empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, scratch, stage, table


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str            # one regular expression, leftmost non-overlapping
    hint: str               # cheap test that every match passes
    group: int = 0          # the group whose length is checked
    least: int = 1          # its least length
    version: int = 1
    base: bool = True


#: Fixed patterns of the base rules, in the order of the digest; then the added ones.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"""[DdTtNnYy]["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA", least=20),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{24}", least=24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----", base=False),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.", least=30, base=False),
)

LEDGER = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("gaps", T.ArrayType(T.IntegerType())),
    T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("checked", T.ArrayType(T.IntegerType())),
])


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _scan(rule: Rule) -> Column:
    """Struct of a ledger row for one rule over column ``text``."""
    lens = lambda a: F.transform(a, lambda x: F.length(x))
    pattern, none = F.lit(rule.pattern), F.array().cast("array<int>")
    hit = F.col("text").rlike(rule.hint)
    return F.struct(
        F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"),
        F.when(hit, lens(F.split("text", rule.pattern, -1))).otherwise(none).alias("gaps"),
        F.when(hit, lens(F.regexp_extract_all("text", pattern, F.lit(0)))).otherwise(none).alias("lengths"),
        F.when(hit, lens(F.regexp_extract_all("text", pattern, F.lit(rule.group)))).otherwise(none).alias("checked"))


def scan_unseen(versions: DataFrame, ledger: str, rules=RULES) -> None:
    """Scan what the ledger lacks and append it. ``versions(blob, text)``."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger).groupBy("blob").agg(
        F.collect_set(F.concat_ws(":", "rule", F.col("version").cast("string"))).alias("seen"))
    blobs = (versions.dropDuplicates(["blob"]).join(known, "blob", "left")
             .withColumn("seen", F.coalesce("seen", F.array().cast("array<string>"))))
    todo = [F.when(~F.array_contains("seen", f"{r.name}:{r.version}"), _scan(r)) for r in rules]
    (blobs.select("blob", F.explode(F.filter(F.array(*todo), lambda x: x.isNotNull())).alias("r"))
     .select("blob", "r.*").write.mode("append").option("compression", "zstd").parquet(ledger))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """``(blob, rule, start, end)`` of every match that passes its rule, for the
    given rule versions; code points, end exclusive."""
    wanted = None
    for r in rules:
        one = (F.col("rule") == r.name) & (F.col("version") == r.version)
        wanted = one if wanted is None else wanted | one
    least = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.least))])
    each = (ledger.where(wanted).where("size(lengths) > 0").dropDuplicates(["blob", "rule"])
            .select("blob", "rule", F.posexplode(F.arrays_zip(F.slice("gaps", 1, F.size("lengths")).alias("gap"),
                                                              F.col("lengths").alias("len"),
                                                              F.col("checked").alias("got"))).alias("i", "m")))
    w = Window.partitionBy("blob", "rule").orderBy("i")
    return (each.select("blob", "rule", F.col("m.len").alias("len"), F.col("m.got").alias("got"),
                        F.sum(F.col("m.gap").cast("long") + F.col("m.len")).over(w).alias("end"))
            .where(F.col("got") >= least[F.col("rule")])
            .select("blob", "rule", (F.col("end") - F.col("len")).alias("start"), "end"))


def scan_secrets(versions: DataFrame, ledger: str, path: str = "path", text: str = "text",
                 rules=RULES) -> tuple[DataFrame, DataFrame]:
    """Scan all rows ``(path, text)`` against the ledger. Returns the versions
    ``(path, blob)`` and the findings per blob; a join gives every path's."""
    v = named(versions, path=path, text=text).select(
        "path", content_address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    scan_unseen(v.select("blob", "text"), ledger, rules)
    return v.select("path", "blob"), findings(read_ledger(versions.sparkSession, ledger), rules)


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """Findings of a blob in one row: counts per base rule, ``base_sha256``, ``spans``."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    base = [r.name for r in rules if r.base]
    item = F.struct("start", order[F.col("rule")].alias("k"),
                    F.concat_ws(":", "rule", F.col("start").cast("string"), F.col("end").cast("string")).alias("s"))
    text = lambda a: F.concat_ws(",", F.transform(F.array_sort(a), lambda x: x["s"]))
    return (found.groupBy("blob").agg(
        *[F.count(F.when(F.col("rule") == n, 1)).alias(f"n_{n}") for n in base],
        F.collect_list(F.when(F.col("rule").isin(base), item)).alias("b"), F.collect_list(item).alias("a"))
        .select("blob", *[f"n_{n}" for n in base], F.sha2(text(F.col("b")), 256).alias("base_sha256"),
                text(F.col("a")).alias("spans")))


EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    v, found = scan_secrets(docs, scratch(spark, "secret-ledger"), path="doc_id")
    d = stage(digest(found), "secret-digest")    # a join of its own, so a blob of many paths can be split
    zero = [F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in RULES if r.base]
    return v.join(d, "blob", "left").select(
        F.col("path").alias("doc_id"), *zero, F.coalesce("base_sha256", F.lit(EMPTY_SHA256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), "blob")


def _oracle() -> str:
    """The same digest in SQL: positions are running sums of gaps and matches."""
    def arm(i: int, r: Rule) -> str:
        p = r.pattern.replace("'", "''")
        return (f"SELECT id, {i} AS k, '{r.name}' AS rule, "
                f"unnest(regexp_extract_all(t, '{p}', 0)) AS m, unnest(regexp_extract_all(t, '{p}', {r.group})) AS g, "
                f"unnest(regexp_split_to_array(t, '{p}')[:len(regexp_extract_all(t, '{p}', 0))]) AS gap, "
                f"unnest(range(len(regexp_extract_all(t, '{p}', 0)))) AS i, {r.least} AS least FROM d")
    arms = " UNION ALL ".join(arm(i, r) for i, r in enumerate(RULES))
    base = ", ".join(f"'{r.name}'" for r in RULES if r.base)
    counts = ", ".join(f"CAST(count(*) FILTER (rule = '{r.name}') AS BIGINT) AS n_{r.name}" for r in RULES if r.base)
    zero = ", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in RULES if r.base)
    return f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({arms}),
p AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY id, k ORDER BY i) AS e FROM m),
f AS (SELECT id, k, rule, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e,
  rule || ':' || CAST(e - length(m) AS BIGINT) || ':' || CAST(e AS BIGINT) AS x FROM p WHERE length(g) >= least),
a AS (SELECT id, {counts}, sha256(coalesce(string_agg(x, ',' ORDER BY s, k) FILTER (rule IN ({base})), '')) AS base_sha256,
  string_agg(x, ',' ORDER BY s, k) AS spans FROM f GROUP BY id)
SELECT doc_id, {zero}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob
FROM d LEFT JOIN a USING (id)"""


QUERIES = {"op5_secret_scan": op5_secret_scan}
ORACLE = {"op5_secret_scan": _oracle()}
