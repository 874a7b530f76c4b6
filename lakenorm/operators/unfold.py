"""Unfold nested frames into flat, user-visible columns.

``unfold_structs`` opens one level: struct ``a`` with field ``b`` becomes
column ``a___b``. ``explode_arrays`` turns an array of structs ``a`` into the
struct column ``a_exploded`` with ``explode_outer`` (a null or empty array
keeps its row). ``unfold`` repeats both up to ``depth`` times or until the
frame is flat; each pass is one projection or one generator, no shuffle.

Only a lone array of structs is exploded: exploding two siblings would emit
every pair of their elements, so sibling arrays stay arrays (``normalize``
never needs to explode at all).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import EXPLODED_SUFFIX, PATH_SEP, is_flat, is_struct_array, quote


def unfold_structs(df: DataFrame) -> DataFrame:
    """Open every root struct one level; other columns unchanged, order kept."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for c in f.dataType.fields:
                cols.append(F.col(quote(f.name)).getField(c.name).alias(f"{f.name}{PATH_SEP}{c.name}"))
        else:
            cols.append(F.col(quote(f.name)))
    out = df.select(*cols)
    twice = sorted({c for c in out.columns if out.columns.count(c) > 1})
    if twice:
        raise ValueError(f"unfolding gives two columns of the name {twice[0]!r}")
    return out


def explode_arrays(df: DataFrame, column: str | None = None) -> DataFrame:
    """``explode_outer`` one array of structs (the first one, or ``column``)."""
    arrays = [f.name for f in df.schema.fields if is_struct_array(f.dataType)]
    if column is None:
        if not arrays:
            return df
        column = arrays[0]
    cols = [
        F.explode_outer(F.col(quote(n))).alias(f"{n}{EXPLODED_SUFFIX}") if n == column else F.col(quote(n))
        for n in df.columns
    ]
    return df.select(*cols)


def unfold(df: DataFrame, depth: int | None = None, explode: bool = True) -> DataFrame:
    """Flatten structs, and arrays of structs, level by level.

    A pass explodes the root array of structs when it is the only one (an
    array nested in an exploded element becomes such a root array in the
    next pass); sibling arrays are left as arrays, never crossed.
    """
    passes = 0
    while not is_flat(df.schema) and (depth is None or passes < depth):
        before = df.schema
        arrays = [f.name for f in df.schema.fields if is_struct_array(f.dataType)]
        if explode and len(arrays) == 1:
            df = explode_arrays(df, arrays[0])
        df = unfold_structs(df)
        passes += 1
        if df.schema == before:
            break
    return df


def fold_structs(df: DataFrame, sep: str = PATH_SEP) -> DataFrame:
    """Fold flat ``a___b___c`` columns back into nested structs.

    The inverse of repeated ``unfold_structs``: columns sharing a prefix
    become one struct, fields in order of first appearance. A name is split
    at every separator, so original names must not contain it.
    """
    tree: dict = {}
    for name in df.columns:
        node = tree
        parts = name.split(sep)
        for p in parts[:-1]:
            node = node.setdefault(p, {})
            if not isinstance(node, dict):
                raise ValueError(f"column {name!r} collides with a flat column of the same prefix")
        node[parts[-1]] = name

    def build(node) -> list:
        out = []
        for key, sub in node.items():
            if isinstance(sub, dict):
                out.append(F.struct(*build(sub)).alias(key))
            else:
                out.append(F.col(quote(sub)).alias(key))
        return out

    return df.select(*build(tree))
