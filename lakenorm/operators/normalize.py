"""The schema normaliser as one recursive column expression.

``normalize(df)`` walks ``df.schema`` once on the driver and emits one
``select`` whose columns

* lowercase every name and merge colliding siblings (``Foo`` / ``foo``),
* sort root columns and struct fields alphabetically,
* turn a null array of structs into ``[]``, drop elements whose fields are all
  null and remove duplicate elements (``array_distinct`` keeps first order),
* keep a null struct null (``null_struct="expand"`` gives a struct of nulls),

followed by one whole-row ``distinct``. No explode, no collect, no helper
columns: the plan has exactly one exchange (the distinct, with map-side
combine), so heavy runs of duplicate rows are collapsed before the shuffle.

Levels: root names are level 1. A container (struct or array of structs) on
level ``L`` is opened when ``depth is None or L <= depth``; an opened
container has its children (level ``L+1``) lowercased, merged and sorted.
Anything below stays as it is, except that colliding members are still
merged by exact field name so that the result has one type.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import has_map, is_struct_array, unify_types
from ..functions.schema import quote as q


@dataclass(frozen=True)
class NormalizeOptions:
    depth: int | None = None          # None: every level
    precedence: str = "first"         # "first": code-point order of original names wins; "last": reversed
    null_struct: str = "keep"         # "keep" | "expand"
    unwrap_single_field: bool = False  # array<struct<a>> -> array<a>
    canonical_arrays: bool = False    # sort arrays of structs, so order does not hide duplicates
    dedup_atomic_arrays: bool = False  # array_distinct on arrays of atomics too
    rows: str = "keep"                # "keep": distinct rows; "fuse": reference fold (see fuse.py)
    dedup_keys: tuple[str, ...] | None = None  # keep one row per key (smallest by value) instead of whole-row distinct

    def opened(self, level: int) -> bool:
        return self.depth is None or level <= self.depth


Member = tuple[str, T.DataType, str]   # (SQL path expression, type, original name for precedence)


def _group(fields: list[tuple[str, T.StructField, tuple]], fold_case: bool, precedence: str
           ) -> list[tuple[str, list[tuple[str, T.StructField, tuple]]]]:
    """Group sibling fields by (lowercased) name.

    Each entry carries an ordering key (path of original names); members of a
    group are ordered by it, groups by output name when case is folded, else
    by first appearance.
    """
    groups: dict[str, list] = {}
    for item in fields:
        key = item[1].name.lower() if fold_case else item[1].name
        groups.setdefault(key, []).append(item)
    out = []
    for key, members in groups.items():
        # original name decides inside one parent (reversed for "last"); the
        # parent's own precedence (rank prefix of the key) decides first
        members = sorted(members, key=lambda m: m[2][-1], reverse=(precedence == "last"))
        members = sorted(members, key=lambda m: m[2][:-1])
        out.append((key, members))
    if fold_case:
        out.sort(key=lambda g: g[0])
    return out


def _target(types: list[T.DataType], level: int, opts: NormalizeOptions) -> T.DataType:
    """Output type of a group of colliding members on ``level``."""
    real = [t for t in types if not isinstance(t, T.NullType)]
    if not real:
        return T.StringType()
    if all(isinstance(t, T.StructType) for t in real):
        opened = opts.opened(level)
        fields = [(None, f, (i, f.name)) for i, t in enumerate(real) for f in t.fields]
        groups = _group(fields, fold_case=opened, precedence=opts.precedence)
        return T.StructType([
            T.StructField(name, _target([m[1].dataType for m in members], level + 1, opts), True)
            for name, members in groups
        ])
    if all(is_struct_array(t) for t in real):
        elem = _target([t.elementType for t in real], level, opts)
        if opts.opened(level) and opts.unwrap_single_field and len(elem.fields) == 1:
            return T.ArrayType(elem.fields[0].dataType, True)
        return T.ArrayType(elem, True)
    return reduce(unify_types, real)


def _string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ddl(dt: T.DataType) -> str:
    """A type as SQL DDL, with quoted field names (``simpleString`` does not quote)."""
    if isinstance(dt, T.StructType):
        return "struct<" + ",".join(f"{q(f.name)}:{ddl(f.dataType)}" for f in dt.fields) + ">"
    if isinstance(dt, T.ArrayType):
        return f"array<{ddl(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"map<{ddl(dt.keyType)},{ddl(dt.valueType)}>"
    return dt.simpleString()


def _field(expr: str, name: str) -> str:
    return f"({expr}).{q(name)}"


def _null(dt: T.DataType) -> str:
    return f"CAST(NULL AS {ddl(dt)})"


_lambda_ids = itertools.count()


def _var() -> str:
    """A fresh lambda variable name (nested lambdas never share one)."""
    return f"_ln{next(_lambda_ids)}"


def conform(expr: str, src: T.DataType, dst: T.DataType) -> str:
    """SQL converting ``expr`` from ``src`` to ``dst`` by field *name* (``CAST``
    on structs goes by position). Missing fields become typed nulls."""
    if src == dst:
        return expr
    if isinstance(src, T.NullType):
        return _null(dst)
    if isinstance(dst, T.StringType) and isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_json({expr})"
    if isinstance(dst, T.StructType) and isinstance(src, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        parts = [
            f"{_string(f.name)}, "
            + (conform(_field(expr, f.name), have[f.name], f.dataType) if f.name in have else _null(f.dataType))
            for f in dst.fields
        ]
        return f"CASE WHEN ({expr}) IS NULL THEN {_null(dst)} ELSE named_struct({', '.join(parts)}) END"
    if isinstance(dst, T.ArrayType) and isinstance(src, T.ArrayType):
        if src.elementType == dst.elementType:
            return expr
        v = _var()
        return f"transform({expr}, {v} -> {conform(v, src.elementType, dst.elementType)})"
    if isinstance(dst, T.MapType) and isinstance(src, T.MapType):
        out = expr
        if src.keyType != dst.keyType:
            k, v = _var(), _var()
            out = f"transform_keys({out}, ({k}, {v}) -> {conform(k, src.keyType, dst.keyType)})"
        if src.valueType != dst.valueType:
            k, v = _var(), _var()
            out = f"transform_values({out}, ({k}, {v}) -> {conform(v, src.valueType, dst.valueType)})"
        return out
    return f"CAST({expr} AS {ddl(dst)})"


def _is_empty(expr: str, dt: T.DataType) -> str:
    """An array element counts as empty when every leaf is null (inner arrays
    of structs: empty); such elements are dropped (they come from nulls)."""
    if isinstance(dt, T.StructType):
        if not dt.fields:
            return "true"
        inner = " AND ".join(f"({_is_empty(_field(expr, f.name), f.dataType)})" for f in dt.fields)
        return f"({expr}) IS NULL OR ({inner})"
    if is_struct_array(dt):
        return f"({expr}) IS NULL OR size({expr}) = 0"
    return f"({expr}) IS NULL"


# Up to this size comparing all pairs of elements is faster than sorting them.
PAIRS = 48


def distinct_elements(arr: str, in_order: bool = False) -> str:
    """SQL of an array of structs without its repeated elements, in the order of
    first occurrence or sorted. ``array_distinct`` compares every pair of structs:
    longer arrays are sorted instead and neighbours compared."""
    s, t, v, i = _var(), _var(), _var(), _var()
    new = f"{i} = 0 OR NOT ({v} <=> get({s}, {i} - 1))"
    if in_order:
        return f"transform(array(array_sort({arr})), {s} -> filter({s}, ({v}, {i}) -> {new}))[0]"
    placed = f"sort_array(transform({s}, ({v}, {i}) -> struct({v} AS v, {i} AS i)))"
    first = f"filter({t}, ({v}, {i}) -> {i} = 0 OR NOT ({v}.v <=> get({t}, {i} - 1).v))"
    back = f"transform(sort_array(transform({first}, {v} -> struct({v}.i AS i, {v}.v AS v))), {v} -> {v}.v)"
    many = f"transform(array({placed}), {t} -> {back})[0]"
    return f"transform(array({arr}), {s} -> CASE WHEN size({s}) <= {PAIRS} THEN array_distinct({s}) ELSE {many} END)[0]"


def _build(members: list[Member], target: T.DataType, level: int, opts: NormalizeOptions) -> str:
    """SQL of the output value of one group of colliding members.

    Member expressions are paths (a root column, field accesses, a lambda
    variable), so repeating them inside the result stays small.
    """
    real = [m for m in members if not isinstance(m[1], T.NullType)]
    if not real:
        if is_struct_array(target) and opts.opened(level):
            return f"CAST(array() AS {ddl(target)})"       # a field that one member lacks, like a null one
        return _null(target)

    if isinstance(target, T.StructType) and all(isinstance(m[1], T.StructType) for m in real):
        opened = opts.opened(level)
        fields = [
            (_field(expr, f.name), f, (rank, f.name))
            for rank, (expr, dt, _) in enumerate(real)
            for f in dt.fields
        ]
        groups = dict(_group(fields, fold_case=opened, precedence=opts.precedence))
        parts = []
        for out_field in target.fields:
            grp = groups.get(out_field.name, [])
            child = [(e, f.dataType, f.name) for e, f, _ in grp]
            parts.append(f"{_string(out_field.name)}, {_build(child, out_field.dataType, level + 1, opts)}")
        value = f"named_struct({', '.join(parts)})" if parts else "struct()"
        if opts.null_struct == "keep":
            all_null = " AND ".join(f"({m[0]}) IS NULL" for m in real)
            value = f"CASE WHEN {all_null} THEN {_null(target)} ELSE {value} END"
        return value

    if isinstance(target, T.ArrayType) and all(is_struct_array(m[1]) for m in real):
        opened = opts.opened(level)
        elem_target = _target([m[1].elementType for m in real], level, opts)
        parts = []
        for expr, dt, _ in real:
            src = f"coalesce({expr}, CAST(array() AS {ddl(dt)}))" if opened else expr
            v = _var()
            parts.append(f"transform({src}, {v} -> {_build([(v, dt.elementType, '')], elem_target, level, opts)})")
        if not opened:
            return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"
        arr = parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"
        v = _var()
        arr = f"filter({arr}, {v} -> NOT ({_is_empty(v, elem_target)}))"
        if not isinstance(target.elementType, T.StructType):
            # unwrap_single_field: array<struct<a>> -> array<a>
            v = _var()
            arr = f"transform({arr}, {v} -> {_field(v, elem_target.fields[0].name)})"
        if has_map(target.elementType):
            return arr      # maps cannot be compared: such elements are all kept
        return distinct_elements(arr, opts.canonical_arrays)

    exprs = [conform(expr, dt, target) for expr, dt, _ in real]
    value = exprs[0] if len(exprs) == 1 else f"coalesce({', '.join(exprs)})"
    if (opts.dedup_atomic_arrays and opts.opened(level - 1) and isinstance(target, T.ArrayType)
            and not isinstance(target.elementType, (T.StructType, T.MapType))):
        value = f"array_distinct({value})"
    return value


def normalized_exprs(schema: T.StructType, opts: NormalizeOptions, keep: tuple[str, ...] = ()
                     ) -> tuple[list[str], T.StructType]:
    """SQL select expressions (``... AS name``) of the normalised root, and the
    resulting schema. ``keep`` names columns passed through untouched (the
    partition column).

    The whole projection is SQL text handed to ``selectExpr`` in one call:
    building it from Column objects costs several Python-to-JVM calls per
    field, which for a table of thousands of columns takes longer than the
    plan it produces.
    """
    fields = [(q(f.name), f, (f.name,)) for f in schema.fields if f.name not in keep]
    groups = _group(fields, fold_case=True, precedence=opts.precedence)
    exprs, out_fields = [], []
    for name, members in groups:
        if name in keep:
            raise ValueError(f"data column {members[0][1].name!r} collides with the partition column {name!r}")
        target = _target([m[1].dataType for m in members], 1, opts)
        sql = _build([(e, f.dataType, f.name) for e, f, _ in members], target, 1, opts)
        exprs.append(f"{sql} AS {q(name)}")
        out_fields.append(T.StructField(name, target, True))
    for k in keep:
        if k in schema.fieldNames():
            exprs.append(q(k))
            out_fields.append(schema[k])
    return exprs, T.StructType(out_fields)


def normalized_columns(schema: T.StructType, opts: NormalizeOptions, keep: tuple[str, ...] = ()
                       ) -> tuple[list[Column], T.StructType]:
    """As :func:`normalized_exprs`, as Column objects."""
    exprs, out = normalized_exprs(schema, opts, keep)
    return [F.expr(e) for e in exprs], out


def normalized_projection(df: DataFrame, opts: NormalizeOptions | None = None,
                          partition_cols: tuple[str, ...] = ("dt",)) -> DataFrame:
    """The normaliser's projection alone (names, merges, arrays), without the
    row de-duplication: no shuffle, so a ``limit`` reaches the scan."""
    keep = tuple(c for c in partition_cols if c in df.columns)
    return df.selectExpr(*normalized_exprs(df.schema, opts or NormalizeOptions(), keep)[0])


def normalized_schema(schema: T.StructType, opts: NormalizeOptions | None = None,
                      keep: tuple[str, ...] = ()) -> T.StructType:
    return normalized_columns(schema, opts or NormalizeOptions(), keep)[1]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup that also works with map columns.

    ``distinct`` is a hash aggregate with a partial (map-side) step, so copies
    of a hot row are collapsed in every task before the exchange. Map columns
    cannot be compared by ``distinct``; ``groupBy`` accepts them.
    """
    if not has_map(df.schema):
        return df.distinct()
    names = [q(n) for n in df.columns]
    tmp = "__lakenorm_n"
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(tmp)).select(*names)


def keep_one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest row in value order (deterministic).

    ``min`` over a struct of the other columns is a partial aggregate, so a
    hot key is reduced in every map task before the exchange, and only the
    key columns are hashed. Map columns are not orderable and cannot be used.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[F.col(q(k)) for k in keys]).distinct()
    tmp = "__lakenorm_row"
    best = F.min(F.struct(*[F.col(q(c)) for c in rest])).alias(tmp)
    out = df.groupBy(*[F.col(q(k)) for k in keys]).agg(best)
    return out.select(*[F.col(q(c)) if c in keys else F.col(tmp).getField(c).alias(c) for c in df.columns])


def normalize(df: DataFrame, depth: int | None = None, *, rows: str = "keep", precedence: str = "first",
              null_struct: str = "keep", unwrap_single_field: bool = False, canonical_arrays: bool = False,
              dedup_atomic_arrays: bool = False, dedup_keys: list[str] | None = None,
              partition_cols: tuple[str, ...] = ("dt",),
              options: NormalizeOptions | None = None) -> DataFrame:
    """Normalise a (nested, mixed-case, duplicated) frame; see module doc.

    ``rows="keep"`` (default) keeps rows that differ anywhere, arrays included;
    ``rows="fuse"`` folds rows that are equal outside their arrays of structs
    into one row with united arrays. ``dedup_keys`` keeps one row per key
    instead of comparing whole rows. ``partition_cols`` present in the frame
    are passed through (and are part of the duplicate key).
    """
    opts = options or NormalizeOptions(depth=depth, precedence=precedence, null_struct=null_struct,
                                       unwrap_single_field=unwrap_single_field,
                                       canonical_arrays=canonical_arrays,
                                       dedup_atomic_arrays=dedup_atomic_arrays, rows=rows,
                                       dedup_keys=tuple(dedup_keys) if dedup_keys else None)
    if not df.columns:
        return df
    keep = tuple(c for c in partition_cols if c in df.columns)
    exprs, _ = normalized_exprs(df.schema, opts, keep)
    out = df.selectExpr(*exprs)
    if opts.rows == "fuse":
        from .fuse import fuse_rows
        # arrays that hold structs in the input (unwrapped ones included) and
        # are still arrays after merging (a collision with a scalar gives string)
        from_structs = {f.name.lower() for f in df.schema.fields if f.name not in keep and is_struct_array(f.dataType)}
        arrays = sorted(f.name for f in out.schema.fields
                        if f.name in from_structs and isinstance(f.dataType, T.ArrayType))
        return fuse_rows(out, arrays, keep)
    if opts.dedup_keys:
        # names are matched after lowercasing; the partition column is always part of the key
        return keep_one_per_key(out, [k.lower() for k in opts.dedup_keys] + [k for k in keep])
    return distinct_rows(out)


def case_merge(df: DataFrame, precedence: str = "first") -> DataFrame:
    """Lowercase root names and merge colliding columns; nothing else."""
    opts = NormalizeOptions(depth=0, precedence=precedence)
    exprs, _ = normalized_exprs(df.schema, opts)
    return df.selectExpr(*exprs)

