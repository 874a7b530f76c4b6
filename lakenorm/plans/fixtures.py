"""Inputs of the registered queries, derived by Spark from the driver's tables.

Every builder reads the given Parquet tables and writes a JSON or Parquet
table into a fresh folder below the shared folder (``spark.checkpoint.dir``),
so the work of each query grows with the tables. Nested values are built
per row (``array(struct(...))``); no builder groups rows into arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from ..sources.json_source import write_json

DT = "dt"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day(ts: str = "ts") -> Column:
    """``yyyyMMdd`` of a timestamp: the partition value."""
    return F.date_format(F.col(ts), "yyyyMMdd")


def stage_json(df: DataFrame, label: str, path: str | None = None, mode: str = "append") -> str:
    """Write ``df`` as a JSON table (partitioned by ``dt`` when present)."""
    spark = df.sparkSession
    configure(spark)
    path = path or scratch_path(spark, label)
    write_json(df, path, mode=mode)
    return path


def messy_events(spark: SparkSession, sf_dir: str, where: Column | None = None, doubled: bool = True,
                 extra: bool = False) -> DataFrame:
    """``events`` as an application would log them: mixed-case keys that
    collide (``Event_Id`` on even ids, ``event_id`` on odd ones), a nested
    ``Props`` object parsed from the JSON string, every line twice."""
    ev = table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.filter(where)
    cols = [
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("Event_Id"),
        F.when(F.col("event_id") % 2 == 1, F.col("event_id")).alias("event_id"),
        F.col("user_id").alias("User_ID"),
        F.col("event_type"),
        F.col("value").alias("Value"),
        F.from_json(F.col("props"), "k bigint").alias("Props"),
    ]
    if extra:
        cols.append((F.col("event_id") % 7).alias("Extra"))
    cols.append(day().alias(DT))
    out = ev.select(*cols)
    return out.unionAll(out) if doubled else out


def stage_messy_events(spark: SparkSession, sf_dir: str, path: str | None = None, where: Column | None = None,
                       extra: bool = False) -> str:
    return stage_json(messy_events(spark, sf_dir, where, extra=extra), "events-json", path)


def customer_orders(spark: SparkSession, sf_dir: str, all_null_element: bool = False) -> DataFrame:
    """One row per customer and order: ``os`` is an array holding the order
    struct, null for finished orders (``o_orderstatus = 'F'``) and for
    customers without orders; ``c`` is a struct with the name.

    Built as an inner join (adaptive execution can split a customer with a
    huge number of orders on both sides) plus the customers without orders
    (anti join against the distinct order keys, pre-aggregated map-side),
    instead of a left join whose hot right side could not be split.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    with_orders = cust.join(orders, cust.c_custkey == orders.o_custkey, "inner")
    buyers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    without = (cust.join(buyers, "c_custkey", "left_anti")
               .select("c_custkey", "c_name", F.lit(None).cast("bigint").alias("o_custkey"),
                       F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(None).cast("string").alias("o_orderstatus")))
    joined = with_orders.unionByName(without)
    elem = F.struct("o_orderkey", "o_orderstatus")
    elems = [elem]
    if all_null_element:
        elems.append(F.struct(F.lit(None).cast("bigint").alias("o_orderkey"),
                              F.lit(None).cast("string").alias("o_orderstatus")))
    arr = F.when(F.col("o_orderkey").isNotNull() & (F.col("o_orderstatus") != "F"), F.array(*elems))
    return joined.select("c_custkey", F.struct(F.col("c_name").alias("name")).alias("c"), arr.alias("os"))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with a two-level struct ``O {o_orderstatus, In {P}}``."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.struct("o_orderstatus", F.struct(F.col("o_totalprice").alias("P")).alias("In"))
                    .alias("O"))


def lineitem_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as documents: mixed-case key, a struct ``Meta {K}``, an array
    ``Lines`` holding the line twice plus an all-null element; every document
    twice."""
    li = table(spark, sf_dir, "lineitem")
    line = F.struct(F.col("l_linenumber").alias("LineNo"), F.col("l_partkey").alias("PartKey"))
    empty = F.struct(F.lit(None).cast("int").alias("LineNo"), F.lit(None).cast("bigint").alias("PartKey"))
    docs = li.select(F.col("l_orderkey").alias("L_OrderKey"), F.struct(F.col("l_orderkey").alias("K")).alias("Meta"),
                     F.array(line, line, empty).alias("Lines"))
    return docs.unionAll(docs)


def conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with an array ``Turns`` holding the turn twice; each
    line twice."""
    cv = table(spark, sf_dir, "conversations")
    t = F.struct(F.col("turn").alias("Turn"), F.col("role").alias("Role"))
    docs = cv.select(F.col("conv_id").alias("Conv_Id"), F.array(t, t).alias("Turns"))
    return docs.unionAll(docs)


def schema_pair(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two JSON tables from ``events`` whose inferred schemas differ: days up to
    the 15th have ``a`` string and ``st {p}``; later days have ``a`` double,
    ``st {p, q}`` and ``extra`` boolean."""
    ev = table(spark, sf_dir, "events")
    early = day() <= F.lit("20240115")
    old = ev.filter(early).select("event_id", F.col("event_type").alias("a"),
                                  F.struct(F.col("user_id").alias("p")).alias("st"), day().alias(DT))
    new = ev.filter(~early).select("event_id", F.col("value").alias("a"),
                                   F.struct(F.col("user_id").alias("p"), F.col("event_type").alias("q")).alias("st"),
                                   (F.col("event_id") % 2 == 0).alias("extra"), day().alias(DT))
    return stage_json(old, "schema-old"), stage_json(new, "schema-new")
