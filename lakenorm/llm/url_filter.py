"""Temporal URL filters: dated list entries, as-of join with captures
(DataFrame operations only).

List entries are events: on a date a value is added to or removed from a list.
Per (list, action, kind, value) consecutive events become validity intervals
``[from, to)``; several events of one date count as one, where a removal wins.
A capture yields the keys by which a list can name it (its exact address, its
path prefixes, its host, its domains including itself); an equality join on the key with
the range condition ``from <= fetched < to`` finds the entries that were active
when it was fetched. The most specific kind decides (url, prefix, host,
domain), and within a kind an allow entry loses to a block entry.

Path prefixes and domains are made only as deep as any list entry goes,
so an address with thousands of segments costs no more than others. The lists
are written before the join, whose two sides are then plain shuffles: a host
that holds a third of all captures is split by adaptive execution, and only
``(id, fetched, key)`` is shuffled, never a page.

Defined results: a capture without address or date, or with text that is no
address, matches no entry but keeps its row (not blocked); entries with a null
field are ignored; ids may repeat (each row keeps its own result, as rows that
share id, address and date are equal); empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, stage, table

KINDS = ("domain", "host", "prefix", "url")         # from the least to the most specific

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*[?]([^#]*)"


def canonical(url):
    """(host, path, address) columns: lower-case host without user, port and
    ``www.``; path with a leading slash; address = host, path and query."""
    host = F.lower(F.regexp_extract(url, _AUTHORITY, 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"^www\.", "")
    path = F.regexp_extract(url, _PATH, 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(url, _QUERY, 1)
    return host, path, F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(list, action, kind, value, date, event add|remove)`` ->
    ``(list, action, kind, value, valid_from, valid_to)``; ``valid_to`` null = open."""
    e = named(entries, list="list", action="action", kind="kind", value="value", date="date", event="event").dropna()
    key = ["list", "action", "kind", "value"]
    days = e.groupBy(*key, "date").agg(F.max("event").alias("event"))       # 'remove' > 'add'
    w = Window.partitionBy(*key).orderBy("date")
    return (days.withColumn("valid_to", F.lead("date").over(w)).where(F.col("event") == "add")
            .select(*key, F.col("date").alias("valid_from"), "valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame, id_column: str, url: str, fetched: str) -> DataFrame:
    """``(id, url, fetched, host, blocked, n_entries, kind, lists)`` per capture."""
    active = stage(intervals(entries), "url-intervals")
    depth = active.agg(
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("value", "/")) - 2)).alias("path"),
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("value", r"\.")))).alias("labels")).first()
    host, path, address = canonical(F.col("url"))
    c = (named(captures, id=id_column, url=url, fetched=fetched)
         .select("id", "url", "fetched", host.alias("host"), path.alias("path"), address.alias("address")))

    segment = F.split("path", "/")
    dirs = F.greatest(F.lit(0), F.least(F.size(segment) - 2, F.lit(depth.path or 0)))
    label = F.split("host", r"\.")
    up = F.greatest(F.lit(0), F.least(F.size(label), F.lit(depth.labels or 0)))
    each = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), f)).otherwise(F.array())
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    keys = F.concat(
        F.array(pair("url", F.col("address")), pair("host", F.col("host"))),
        each(dirs, lambda i: pair("prefix", F.concat(F.col("host"), F.array_join(F.slice(segment, 1, i + 1), "/"), F.lit("/")))),
        each(up, lambda i: pair("domain", F.array_join(F.slice(label, F.size(label) - i + 1, i), "."))))
    asked = (c.where((F.col("host") != "") & F.col("fetched").isNotNull())
             .select("id", "url", "fetched", F.explode(keys).alias("k")).distinct()
             .select("id", "url", "fetched", F.col("k.kind").alias("kind"), F.col("k.value").alias("value")))
    hit = (asked.join(active, ["kind", "value"])
           .where((F.col("valid_from") <= F.col("fetched"))
                  & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    decided = hit.groupBy(F.col("id").alias("_id"), F.col("url").alias("_url"), F.col("fetched").alias("_at")).agg(
        F.max(F.struct(rank[F.col("kind")].alias("r"), F.col("action").alias("a"), F.col("kind").alias("k"))).alias("top"),
        F.count(F.lit(1)).alias("n"), F.concat_ws(",", F.array_sort(F.collect_set("list"))).alias("lists"))
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url")) & (F.col("fetched") == F.col("_at"))
    return c.join(decided, on, "left").select(
        "id", "url", "fetched", "host", (F.coalesce(F.col("top.a"), F.lit("")) == "block").alias("blocked"),
        F.coalesce("n", F.lit(0)).alias("n_entries"), F.col("top.k").alias("kind"),
        F.coalesce("lists", F.lit("")).alias("lists"))


# -------------------------------------------- captures and lists of the query

#: The tables hold neither fetch dates nor lists; both are derived from all of ``pages``.
FETCHED = "date_add(DATE'2024-01-01', CAST((page_id * 7919) % 366 AS INT))"


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.expr(FETCHED).alias("fetched"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated entries for every host, registered domain, first directory and
    address of ``pages``; dates and lists follow from its smallest page_id ``p``."""
    host, path, address = canonical(F.col("url"))
    c = pages.select("page_id", host.alias("host"), path.alias("path"), address.alias("address")).where("host <> ''")
    label, segment = F.split("host", r"\."), F.split("path", "/")
    kinds = F.array(
        F.struct(F.lit("host").alias("kind"), F.col("host").alias("value")),
        F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(label, F.greatest(F.size(label) - 1, F.lit(1)), 2), ".").alias("value")),
        F.struct(F.lit("prefix").alias("kind"), F.concat("host", F.lit("/"), F.element_at(segment, 2), F.lit("/")).alias("value")),
        F.struct(F.lit("url").alias("kind"), F.col("address").alias("value")))
    named_values = (c.select("page_id", F.explode(kinds).alias("k")).groupBy("k.kind", "k.value")
                    .agg(F.min("page_id").alias("p")))
    step = lambda base, days: f"date_add(DATE'{base}', CAST({days} AS INT))"
    events = F.array(
        F.struct(F.expr(step("2023-12-01", "(p * 13) % 300")).alias("date"), F.lit("add").alias("event")),
        F.struct(F.expr(step("2023-12-01", "(p * 13) % 300 + 20 + p % 90")).alias("date"), F.lit("remove").alias("event")),
        F.struct(F.expr(step("2023-12-01", "(p * 13) % 300 + 150")).alias("date"), F.lit("add").alias("event")))
    return named_values.select(
        F.expr("CASE WHEN p % 4 = 0 THEN 'ads' WHEN p % 4 = 1 THEN 'adult' WHEN p % 4 = 2 THEN 'malware' ELSE 'trusted' END").alias("list"),
        F.expr("CASE WHEN p % 4 = 3 THEN 'allow' ELSE 'block' END").alias("action"), "kind", "value",
        F.explode(events).alias("e")).select("list", "action", "kind", "value", "e.date", "e.event")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return evaluate(captures_of(pages), lists_of(pages), "page_id", "url", "fetched").select(
        F.col("id").alias("page_id"), "url", "fetched", "host", "blocked", "n_entries", "kind", "lists")


_CANON = r"""regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', ''), '^www\.', '') AS host,
  CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) END AS path,
  regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query"""

QUERIES = {"op9_url_filter": op9_url_filter}
ORACLE = {"op9_url_filter": f"""
WITH c0 AS (SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INT) AS fetched, {_CANON} FROM pages),
c AS (SELECT *, host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS address,
  string_split(host, '.') AS label, string_split(path, '/') AS seg FROM c0),
names AS (SELECT kind, value, min(page_id) AS p FROM (
  SELECT page_id, 'host' AS kind, host AS value FROM c WHERE host <> ''
  UNION ALL SELECT page_id, 'domain', array_to_string(label[greatest(len(label) - 1, 1):], '.') FROM c WHERE host <> ''
  UNION ALL SELECT page_id, 'prefix', host || '/' || seg[2] || '/' FROM c WHERE host <> ''
  UNION ALL SELECT page_id, 'url', address FROM c WHERE host <> '') GROUP BY kind, value),
events AS (SELECT p, kind, value, unnest([DATE '2023-12-01' + CAST((p * 13) % 300 AS INT), DATE '2023-12-01' + CAST((p * 13) % 300 + 20 + p % 90 AS INT), DATE '2023-12-01' + CAST((p * 13) % 300 + 150 AS INT)]) AS date,
  unnest(['add', 'remove', 'add']) AS event FROM names),
days AS (SELECT p, kind, value, date, max(event) AS event FROM events GROUP BY ALL),
spans AS (SELECT *, lead(date) OVER (PARTITION BY kind, value ORDER BY date) AS until FROM days),
active AS (SELECT kind, value, date AS since, until, CASE p % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'adult' WHEN 2 THEN 'malware' ELSE 'trusted' END AS list,
  CASE WHEN p % 4 = 3 THEN 'allow' ELSE 'block' END AS action FROM spans WHERE event = 'add'),
asked AS (SELECT page_id, fetched, 'url' AS kind, address AS value, 3 AS r FROM c WHERE host <> ''
  UNION ALL SELECT page_id, fetched, 'host', host, 1 FROM c WHERE host <> ''
  UNION ALL SELECT page_id, fetched, 'prefix', host || array_to_string(seg[1:i + 1], '/') || '/', 2 FROM (SELECT *, unnest(range(1, len(seg) - 1)) AS i FROM c WHERE host <> '')
  UNION ALL SELECT page_id, fetched, 'domain', array_to_string(label[len(label) - i + 1:], '.'), 0 FROM (SELECT *, unnest(range(1, len(label) + 1)) AS i FROM c WHERE host <> '')),
hit AS (SELECT page_id, r, action, a.kind, list FROM asked a JOIN active b ON a.kind = b.kind AND a.value = b.value AND since <= fetched AND (until IS NULL OR fetched < until)),
best AS (SELECT page_id, arg_max(action, r * 2 + CASE WHEN action = 'block' THEN 1 ELSE 0 END) AS action, arg_max(kind, r * 2 + CASE WHEN action = 'block' THEN 1 ELSE 0 END) AS kind, count(*) AS n,
  array_to_string(list_sort(list(DISTINCT list)), ',') AS lists FROM hit GROUP BY page_id)
SELECT c.page_id, url, fetched, host, coalesce(action, '') = 'block' AS blocked, coalesce(n, 0) AS n_entries, kind, coalesce(lists, '') AS lists
FROM c LEFT JOIN best USING (page_id)"""}
