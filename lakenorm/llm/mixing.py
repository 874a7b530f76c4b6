"""Mixing sources to target weights (built-in functions only).

1. Every document gets its size in words and a seeded key, the MD5 of seed, id
   and text; these go to a written table without the texts.
2. Capped water-filling. Sources share the sum of all sizes by weight, and no
   source may exceed ``epochs`` times its own size. Each round clamps the
   sources above their cap and shares the rest among the others by weight, with
   whole numbers only, until no source is above. It is Newton's method on a
   concave function of whole numbers, so there are O(log(words x weights))
   rounds, each one aggregate of the table of sources.
3. Repetitions. A source at ``e`` epochs takes every document ``floor(e)`` times
   and, in the order of the keys, one more time until its target is met as
   nearly as whole documents allow. Where that order is cut is found digit by
   digit: sums per three hex digits of the key, then again within the one group
   that holds the cut, until it is small enough to be sorted. A hot source is
   spread over 4096 groups from the first step on, and no task holds a source.

The order of sources (by code point, null last) comes from a range partitioning
with counts per partition, so there is no task with all sources either.

Defined results: a null or empty text, or one of white space, has size 0 and
takes 0 words; a null source is a source of its own; a source of size 0 has
target 0; documents that share an id are told apart by their text, and of rows
that are equal as a whole any may be the ones taken once more (the rows of the
result are the same); without any word all targets are 0; an empty table gives
no rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, stage, table

WORD = r"[^\x20\x09-\x0D]+"     # fixed pattern of the contract
SEED = 11
DIGITS = 3                      # hex digits of the key per step: 4096 groups
SORTED = 1024                   # rows of a group that are put in order at once
ROUNDS = 3
LAST = "g"                      # behind all hex digits


def sized_documents(src: DataFrame, seed: int = SEED) -> DataFrame:
    """``src(id, text, source)`` -> ``(id, source, size, key)``; keys are unique.
    The end of a key is the row's number, which only orders equal rows."""
    name = F.concat_ws("\x1f", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return src.select("id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                      F.concat(F.md5(name), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")).alias("key"))


def cycle_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sources(source, ...)``, distinct, with ``weight``: the given weights in
    turn, in the order of sources."""
    order = F.col("source").asc_nulls_last()
    dealt = stage(sources.repartitionByRange(order).sortWithinPartitions(order)
                  .withColumn("at", F.monotonically_increasing_id()), "mix-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c"))     # a row per partition
    before = counts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    turn = F.pmod(F.col("before") + place, F.lit(len(weights))).cast("int")
    given = F.array(*[F.lit(w).cast("long") for w in weights])
    return (dealt.withColumn("part", part).join(before, "part")
            .select(*sources.columns, F.get(given, turn).alias("weight")))


def fill(sources: DataFrame, epochs: int) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target``: the water level
    by which the weights share the sum of all sizes, each source up to its cap."""
    whole = lambda c: c.cast("decimal(19,0)")
    number = lambda n: F.lit(Decimal(n)).cast("decimal(19,0)")
    cap, weight = whole(F.col("source_size") * epochs), whole(F.col("weight"))
    active = F.col("weight") > 0
    total, parts = sources.agg(F.sum("source_size"), F.sum(F.when(active, F.col("weight")))).first()
    total, parts = int(total or 0), int(parts or 0)
    rest = total

    def above() -> Column:
        return active & (cap * number(parts) < weight * number(rest))

    while parts and rest:
        clamped, others = sources.agg(F.sum(F.when(above(), F.col("source_size") * epochs)),
                                      F.sum(F.when(active & ~above(), F.col("weight")))).first()
        if int(others or 0) == parts:
            break
        rest, parts = total - int(clamped or 0), int(others or 0)
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(parts or 1))
    full = (F.col("source_size") * epochs).cast("double")
    target = F.when(above(), full).otherwise(share) if parts else full
    return sources.withColumn("target", F.when(active, target).otherwise(F.lit(0.0)))


def cuts(sized: DataFrame, wanted: DataFrame, nearest: bool) -> DataFrame:
    """``wanted(source, rest)`` -> ``(source_, cut, left)``: the documents of a
    source with keys up to ``cut`` have at most ``rest`` words, ``left`` less
    than that; with ``nearest`` one more if that comes nearer. Sources without
    a document in ``sized(source, size, key)`` have no row."""
    by_source = Window.partitionBy("source").orderBy("p")
    same = lambda other: F.col("source").eqNullSafe(other["source_"]) & (F.col("parent") == other["prefix"])
    opened = wanted.select(F.col("source").alias("source_"), F.lit("").alias("prefix"), "rest")
    step, ended = 0, None
    while True:
        step += 1
        parent, p = F.substring("key", 1, DIGITS * (step - 1)), F.substring("key", 1, DIGITS * step)
        inside = sized.select("source", "size", parent.alias("parent"), p.alias("p"))
        if step > 1:                                        # dealt by source and digits: no hot key
            inside = inside.join(opened.select("source_", "prefix"), same(opened), "left_semi")
        sums = inside.groupBy("source", "parent", "p").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("c"))
        run = (sums.withColumn("before", F.sum("s").over(by_source) - F.col("s"))     # at most 4096 rows of a source
               .join(opened, same(opened)))
        if step == 1:
            run = stage(run, "mix-sums")                    # sources that stay below ``rest`` end here
            ended = (run.groupBy("source_", "rest").agg(F.sum("s").alias("s")).where("s <= rest")
                     .select("source_", F.lit(LAST).alias("cut"), (F.col("rest") - F.col("s")).alias("left")))
        found = stage(run.where("before <= rest and rest < before + s")
                      .select("source_", F.col("p").alias("prefix"), (F.col("rest") - F.col("before")).alias("rest"), "c"), f"mix-cut-{step}")
        opened = found.drop("c")
        if (found.agg(F.max("c")).first()[0] or 0) <= SORTED:
            break
    rows = (sized.withColumn("parent", F.substring("key", 1, DIGITS * step)).join(opened, same(opened))
            .withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("key"))))
    fits = (2 * F.col("upto") - F.col("size") <= 2 * F.col("rest")) if nearest else (F.col("upto") <= F.col("rest"))
    last = rows.groupBy("source_", "prefix", "rest").agg(F.max(F.when(fits, F.col("key"))).alias("key"),
                                                         F.max(F.when(fits, F.col("upto"))).alias("upto"))
    return ended.unionByName(last.select("source_", F.coalesce("key", "prefix").alias("cut"),
                                         (F.col("rest") - F.coalesce("upto", F.lit(0))).alias("left")))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] | DataFrame = (1, 2, 3), epochs: int = 3, seed: int = SEED,
                id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(id, source, size, source_size, weight, target, repeats, taken)`` per row
    of ``docs``. ``weights``: whole numbers given to the sources in turn, or a
    frame ``(source, weight)`` with one row per source (others weigh 0)."""
    sized = stage(sized_documents(named(docs, id=id_column, text=text, source=source), seed), "mix-sizes")
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    if isinstance(weights, DataFrame):
        given = named(weights, given="source", weight="weight")
        sources = (sources.join(given, F.col("source").eqNullSafe(F.col("given")), "left")
                   .select("source", "source_size", F.coalesce(F.col("weight").cast("long"), F.lit(0).cast("long")).alias("weight")))
    else:
        sources = cycle_weights(sources, tuple(weights))
    plan = fill(stage(sources, "mix-weights"), epochs)
    size = F.greatest("source_size", F.lit(1))
    plan = plan.withColumn("passes", F.least(F.floor(F.col("target") / size), F.lit(epochs)).cast("long"))
    left = F.when(F.col("passes") < epochs, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(F.lit(0.0))
    plan = stage(plan.select(F.col("source").alias("of"), "source_size", "weight", "target", "passes", F.lit("").alias("cut_0"),
                             left.alias("left_0")), "mix-targets")
    once_more = F.lit(False)
    for k in range(ROUNDS):
        cut, rest, last = F.col(f"cut_{k}"), F.col(f"left_{k}"), k + 1 == ROUNDS
        fits = (F.col("key") > cut) & (F.col("size") <= (2 * rest if last else rest)) if k else F.lit(True)
        open_ = plan.where(rest > 0).select(F.col("of").alias("source"), rest.alias("rest"))
        rows = sized
        if k:
            rows = sized.join(plan.where(rest > 0).select("of", f"cut_{k}", f"left_{k}"), F.col("source").eqNullSafe(F.col("of"))).where(fits)
        found = cuts(rows.select("source", "size", "key"), open_, last)
        once_more = once_more | ((rest > 0) & fits & (F.col("key") <= F.col(f"cut_{k + 1}")))
        plan = plan.join(found, F.col("of").eqNullSafe(F.col("source_")), "left").drop("source_")
        plan = stage(plan.withColumn(f"cut_{k + 1}", F.coalesce("cut", cut)).withColumn(f"left_{k + 1}", F.coalesce("left", rest))
                     .drop("cut", "left"), f"mix-plan-{k}")
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("repeats", F.col("passes") + F.when(once_more, 1).otherwise(0).cast("long"))
            .select("id", "source", "size", "source_size", "weight", "target", "repeats",
                    (F.col("repeats") * F.col("size")).alias("taken")))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "repeats")


_ORACLE = r"""WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
  md5(concat_ws(chr(31), '11', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
r AS (SELECT *, 18 * source_size // weight AS full_at FROM w),
c AS (SELECT *, (SELECT sum(source_size) FROM w) - coalesce(sum(3 * source_size) OVER b, 0) AS rest,
  (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0) AS parts FROM r
  WINDOW b AS (ORDER BY full_at RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest, full_at) AS rest, arg_min(parts, full_at) AS parts FROM c WHERE 6 * rest <= full_at * parts),
t AS (SELECT w.*, CASE WHEN 3 * source_size * parts < weight * rest THEN CAST(3 * source_size AS DOUBLE)
  ELSE CAST(weight * rest AS DOUBLE) / CAST(parts AS DOUBLE) END AS target FROM w, l),
p AS (SELECT *, least(floor(target / greatest(source_size, 1)), 3) AS passes FROM t),
o AS (SELECT d.doc_id, d.source, d.size, d.key, p.source_size, p.target, p.passes, 0 AS more, '' AS cut,
  CASE WHEN passes < 3 THEN target - passes * source_size ELSE 0.0 END AS rest FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
"""


def _oracle() -> str:
    """The rounds in SQL: running sums over what is behind the cut and fits."""
    def turn(k: int) -> str:
        last = k + 1 == ROUNDS
        open_ = f"rest > 0 AND key > cut AND size <= {'2 * rest' if last else 'rest'}" if k else "rest > 0"
        takes = "2 * upto - size <= 2 * rest" if last else "upto <= rest"
        return f"""a{k} AS (SELECT *, {open_} AS open, sum(CASE WHEN {open_} THEN size ELSE 0 END)
  OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto FROM {f'b{k - 1}' if k else 'o'}),
b{k} AS (SELECT doc_id, source, size, key, source_size, target, passes, more + CASE WHEN open AND {takes} THEN 1 ELSE 0 END AS more,
  coalesce(CASE WHEN bool_or(open) OVER s THEN CASE WHEN bool_and({takes} OR NOT open) OVER s THEN '{LAST}'
    ELSE max(CASE WHEN open AND {takes} THEN key END) OVER s END END, cut) AS cut,
  rest - coalesce(max(CASE WHEN open AND {takes} THEN upto END) OVER s, 0) AS rest FROM a{k} WINDOW s AS (PARTITION BY source))"""
    rounds = ",\n".join(turn(k) for k in range(ROUNDS))
    return _ORACLE + rounds + f"""
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, source, CAST(passes + more AS BIGINT) AS repeats,
  CAST((passes + more) * size AS BIGINT) AS taken FROM b{ROUNDS - 1}"""


QUERIES = {"op11_source_mix": op11_source_mix}
ORACLE = {"op11_source_mix": _oracle()}
