"""Fold rows that are equal outside their arrays of structs (``rows="fuse"``),
at every level.

This is the reference's result for the fold step: rows equal in every other
column become one row whose arrays are the union of theirs. Arrays are folded
one after the other, each grouped by everything else. Sibling arrays are
never exploded against each other (no cross product); the other arrays take
part in the key as whole values.

Below the root: an array inside root structs is lifted to the root, folded like
any other and put back. Within an array, elements equal outside their own
nested arrays become one element with these united, deepest level included, by
an expression over the row alone (nested arrays too are folded one after the
other): elements are sorted by what is outside the nested array, and runs of
equal ones become one, so a value of many elements costs a sort. Elements that hold maps cannot be compared and stay as they are.

A group's united array is one output value, so it must fit a task: that is the
documented limit of this mode (``rows="keep"`` has none).

Skew: one group may hold a large share of all rows. A fold is therefore two
aggregations. The first is a plain distinct over (everything else, element): a
hash aggregate without objects, which removes duplicates in every map task and
spreads a hot group over all reducers. The second groups by everything else and
only collects: the reducer of a hot group receives exactly its distinct
elements - the output row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import has_map, is_struct_array, quote
from .normalize import distinct_rows


def fuse_arrays(df: DataFrame, arrays: list[str] | None = None, keys_exclude: tuple[str, ...] = (),
                sort: bool = True) -> DataFrame:
    """Fold ``arrays`` (default: every root array of structs) in the given order."""
    if arrays is None:
        arrays = [f.name for f in df.schema.fields if is_struct_array(f.dataType) and f.name not in keys_exclude]
    if not arrays:
        return distinct_rows(df)
    order = [quote(c) for c in df.columns]
    df = df.select(*[unite(F.col(quote(c)), df.schema[c].dataType).alias(c) if c in arrays else F.col(quote(c)) for c in df.columns])
    for name in arrays:
        col, kind = F.col(quote(name)), df.schema[name].dataType
        rest = [quote(c) for c in df.columns if c != name]
        exploded = df.select(*rest, F.explode_outer(col).alias(name))
        df = distinct_rows(exploded).groupBy(*rest).agg(F.collect_list(col).alias(name))
        done = unite(col, kind)         # elements of different rows meet here
        done = F.sort_array(done) if sort else done
        df = df.withColumn(name, done).select(*order)
    return df


def _nested_arrays(element: T.DataType) -> list[T.StructField]:
    return [f for f in element.fields if is_struct_array(f.dataType)] if isinstance(element, T.StructType) else []


def unite(col: Column, kind: T.ArrayType) -> Column:
    """An array whose elements, where equal outside a nested array of structs,
    are one element with the union of it; at every level below."""
    element = kind.elementType
    nested = _nested_arrays(element)
    if not nested or has_map(element):
        return col
    for f in nested:
        rest = [g.name for g in element.fields if g.name != f.name]
        key = lambda e: F.struct(F.lit(True).alias("_"), *[e.getField(n).alias(n) for n in rest])
        col = _unite_one(col, element, f, key)
    return col


def _bind(value: Column, of) -> Column:
    """``of(value)`` with ``value`` evaluated once: inside a lambda an outer
    expression is evaluated again for every element, a lambda variable is not."""
    return F.transform(F.array(value), of)[0]


def sorted_distinct(arr: Column) -> Column:
    """The elements of an array in order, each once: sorted, then compared with
    the one before (``array_distinct`` compares every pair of structs)."""
    return _bind(F.sort_array(arr), lambda s: F.filter(s, lambda e, i: (i == 0) | ~e.eqNullSafe(F.get(s, i - 1))))


def _unite_one(col: Column, element: T.StructType, f: T.StructField, key) -> Column:
    """Elements sorted by their key stand in runs; a run is one element of the
    result. Each step is linear in the elements, but for the sort."""
    empty = F.array().cast(f.dataType)

    def one(run: Column) -> Column:
        k = F.get(run, F.lit(0)).getField("k")
        nested = F.flatten(F.transform(run, lambda r: F.coalesce(r.getField("v"), empty)))
        united = sorted_distinct(unite(nested, f.dataType))
        return F.struct(*[(united if g.name == f.name else k.getField(g.name)).alias(g.name) for g in element.fields])

    def runs(s: Column) -> Column:
        place = F.transform(s, lambda _, i: i)
        first = F.filter(place, lambda i: (i == 0) | ~F.get(s, i).getField("k").eqNullSafe(F.get(s, i - 1).getField("k")))
        return _bind(first, lambda at: F.transform(at, lambda a, j: one(F.slice(s, a + 1, F.coalesce(F.get(at, j + 1), F.size(s)) - a))))

    keyed = F.transform(col, lambda e, i: F.struct(key(e).alias("k"), i.alias("i"), e.getField(f.name).alias("v")))
    return _bind(F.sort_array(keyed), runs)


# ------------------------------------------------- arrays inside root structs

def struct_arrays(schema: T.StructType, keep: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the arrays of structs that lie inside root structs."""
    def below(kind: T.DataType, path: tuple[str, ...]):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from below(f.dataType, (*path, f.name))
        elif len(path) > 1 and is_struct_array(kind):
            yield path
    return [p for f in schema.fields if f.name not in keep for p in below(f.dataType, (f.name,))]


_HERE = "__lakenorm_here"


def _without(col: Column, kind: T.DataType, path: tuple[str, ...], gone: set[tuple[str, ...]]) -> Column:
    if not isinstance(kind, T.StructType) or not any(g[:len(path)] == path for g in gone):
        return col
    fields = [_without(col.getField(f.name), f.dataType, (*path, f.name), gone).alias(f.name)
              for f in kind.fields if (*path, f.name) not in gone]
    return F.when(col.isNotNull(), F.struct(F.lit(True).alias(_HERE), *fields))


def _with(col: Column, kind: T.DataType, path: tuple[str, ...], at: dict[tuple[str, ...], Column]) -> Column:
    if not isinstance(kind, T.StructType) or not any(g[:len(path)] == path for g in at):
        return col
    fields = [(at[(*path, f.name)] if (*path, f.name) in at else _with(col.getField(f.name), f.dataType, (*path, f.name), at)).alias(f.name)
              for f in kind.fields]
    return F.when(col.isNotNull(), F.struct(*fields))


def fuse_rows(df: DataFrame, arrays: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Fold the root arrays and the arrays inside root structs."""
    paths = [] if has_map(df.schema) else struct_arrays(df.schema, keep)
    if not paths:
        return fuse_arrays(df, arrays=arrays)
    schema, lifted = df.schema, {p: f"__lakenorm_lift_{i}" for i, p in enumerate(paths)}

    def at(path):
        col = F.col(quote(path[0]))
        for name in path[1:]:
            col = col.getField(name)
        return col
    gone = set(paths)
    flat = df.select(*[_without(F.col(quote(f.name)), f.dataType, (f.name,), gone).alias(f.name) for f in schema.fields],
                     *[at(p).alias(n) for p, n in lifted.items()])
    folded = fuse_arrays(flat, arrays=sorted([*lifted.values(), *arrays]))
    back = {p: F.col(n) for p, n in lifted.items()}
    return folded.select(*[_with(F.col(quote(f.name)), f.dataType, (f.name,), back).alias(f.name) for f in schema.fields])
