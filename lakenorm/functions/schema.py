"""Schema algebra on the driver: tree walk, flat rows, type unification.

These functions look at ``StructType`` objects only; they never touch data.
The data work (joins of schema rows, counts) lives in ``operators.schema_diff``.
"""

from __future__ import annotations


from pyspark.sql import types as T

# Separator and suffix of the flat, user-visible column paths (fixed values).
PATH_SEP = "___"
EXPLODED_SUFFIX = "_exploded"

_INTEGRAL_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def quote(name: str) -> str:
    """A back-quoted identifier for column references (back quotes in the name doubled)."""
    return "`" + name.replace("`", "``") + "`"


def is_struct_array(dt: T.DataType) -> bool:
    return isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType)


def is_nested(dt: T.DataType) -> bool:
    """A struct or an array of structs (the two containers the engine opens)."""
    return isinstance(dt, T.StructType) or is_struct_array(dt)


def is_flat(schema: T.StructType) -> bool:
    """True when no root column is a struct or an array of structs."""
    return not any(is_nested(f.dataType) for f in schema.fields)


def has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.StructType):
        return any(has_map(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return has_map(dt.elementType)
    return False


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _unify_numeric(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, (T.DoubleType, T.FloatType)) or isinstance(b, (T.DoubleType, T.FloatType)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        da = a if isinstance(a, T.DecimalType) else T.DecimalType(20, 0)
        db = b if isinstance(b, T.DecimalType) else T.DecimalType(20, 0)
        scale = max(da.scale, db.scale)
        digits = max(da.precision - da.scale, db.precision - db.scale)
        if digits + scale > 38:
            return T.DoubleType()
        return T.DecimalType(digits + scale, scale)
    ra, rb = _INTEGRAL_RANK.get(type(a), 4), _INTEGRAL_RANK.get(type(b), 4)
    return a if ra >= rb else b


def unify_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """Least common type in the lattice of JSON inference.

    null + x = x; integral types widen; integral + double = double;
    struct + struct merges fields by exact name (order of first appearance);
    array + array unifies elements; every other mix becomes string.
    """
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType) or a == b:
        return a
    if _is_numeric(a) and _is_numeric(b):
        return _unify_numeric(a, b)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return unify_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(unify_types(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(unify_types(a.keyType, b.keyType), unify_types(a.valueType, b.valueType), True)
    if isinstance(a, (T.DateType, T.TimestampType, T.TimestampNTZType)) and \
            isinstance(b, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()


def unify_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Union of two schemas by exact field name; shared fields get ``unify_types``."""
    out: dict[str, T.DataType] = {}
    for f in list(a.fields) + list(b.fields):
        out[f.name] = unify_types(out[f.name], f.dataType) if f.name in out else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in out.items()])


# --------------------------------------------------- leaves that were always null
#
# JSON inference calls a leaf without any value a string. In the log such a leaf
# is void instead, so that merging day after day gives what one inference over
# all days would give: void + x = x.

def string_leaves(dt: T.DataType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the string leaves; an array's elements are the step ``[]``."""
    if isinstance(dt, T.StructType):
        return [p for f in dt.fields for p in string_leaves(f.dataType, (*path, f.name))]
    if isinstance(dt, T.ArrayType):
        return string_leaves(dt.elementType, (*path, "[]"))
    return [path] if isinstance(dt, T.StringType) else []


def void_leaves(dt: T.DataType, void: set[tuple[str, ...]], path: tuple[str, ...] = ()) -> T.DataType:
    """The type with the leaves at these paths void."""
    if path in void:
        return T.NullType()
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, void_leaves(f.dataType, void, (*path, f.name)), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(void_leaves(dt.elementType, void, (*path, "[]")), True)
    return dt


def readable(dt: T.DataType) -> T.DataType:
    """The type with void leaves as strings, as a reader needs it."""
    if isinstance(dt, T.NullType):
        return T.StringType()
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, readable(f.dataType), True) for f in dt.fields])
    return T.ArrayType(readable(dt.elementType), True) if isinstance(dt, T.ArrayType) else dt


def void_where_missing(dt: T.DataType, typed: T.DataType | None) -> T.DataType:
    """The type with what ``typed`` (an inference that drops fields without any
    value) does not have as void."""
    if typed is None:
        return T.NullType()
    if isinstance(dt, T.StructType) and isinstance(typed, T.StructType):
        have = {f.name: f.dataType for f in typed.fields}
        return T.StructType([T.StructField(f.name, void_where_missing(f.dataType, have.get(f.name)), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType) and isinstance(typed, T.ArrayType):
        return T.ArrayType(void_where_missing(dt.elementType, typed.elementType), True)
    return dt


def may_be_void(known: T.DataType, new: T.DataType) -> bool:
    """Is there a string in ``new`` where ``known`` has another type?"""
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        have = {f.name: f.dataType for f in known.fields}
        return any(f.name in have and may_be_void(have[f.name], f.dataType) for f in new.fields)
    if isinstance(known, T.ArrayType) and isinstance(new, T.ArrayType):
        return may_be_void(known.elementType, new.elementType)
    return isinstance(new, (T.StringType, T.ArrayType)) and not isinstance(known, (T.StringType, T.NullType))


def void_resolved(known: T.DataType, merged: T.DataType) -> bool:
    """Has a leaf that was void got a type other than the string it was written as?"""
    if isinstance(known, T.NullType):
        return not isinstance(merged, (T.NullType, T.StringType))
    if isinstance(known, T.StructType) and isinstance(merged, T.StructType):
        have = {f.name: f.dataType for f in merged.fields}
        return any(f.name in have and void_resolved(f.dataType, have[f.name]) for f in known.fields)
    if isinstance(known, T.ArrayType) and isinstance(merged, T.ArrayType):
        return void_resolved(known.elementType, merged.elementType)
    return False


def type_string(dt: T.DataType) -> str:
    return dt.simpleString()


def schema_rows(schema: T.StructType, depth: int | None = None) -> list[tuple[str, str]]:
    """Flat ``(col_name, data_type)`` rows of a schema, in the unfolded naming.

    A struct ``c`` contributes ``c___name``; an array of structs ``os``
    contributes ``os_exploded___field``. Containers on level ``depth + 1`` and
    below are listed as one row with their full type string. ``depth=None``
    unfolds everything.
    """
    rows: list[tuple[str, str]] = []

    def walk(prefix: str, dt: T.DataType, level: int) -> None:
        opened = depth is None or level <= depth
        if isinstance(dt, T.StructType) and opened and prefix:
            for f in dt.fields:
                walk(f"{prefix}{PATH_SEP}{f.name}", f.dataType, level + 1)
        elif is_struct_array(dt) and opened and prefix:
            for f in dt.elementType.fields:
                walk(f"{prefix}{EXPLODED_SUFFIX}{PATH_SEP}{f.name}", f.dataType, level + 1)
        else:
            rows.append((prefix, type_string(dt)))

    for f in schema.fields:
        walk(f.name, f.dataType, 1)
    return rows


def leaf_paths(schema: T.StructType) -> dict[tuple[str, ...], T.DataType]:
    """Every leaf as a path tuple; array elements add the marker ``[]``."""
    out: dict[tuple[str, ...], T.DataType] = {}

    def walk(path: tuple[str, ...], dt: T.DataType) -> None:
        if isinstance(dt, T.StructType):
            if not dt.fields:
                out[path] = dt
            for f in dt.fields:
                walk(path + (f.name,), f.dataType)
        elif is_struct_array(dt):
            walk(path + ("[]",), dt.elementType)
        else:
            out[path] = dt

    for f in schema.fields:
        walk((f.name,), f.dataType)
    return out


def _widening_ok(old: T.DataType, new: T.DataType) -> bool:
    """Numeric widenings that Spark's Parquet readers (vectorized and row
    based) apply to files written with the old type, so old partitions stay
    readable under the new schema without a rebuild [probed on 4.1.2]:
    byte/short/int to a wider integral type or to double, float to double,
    and decimal to a decimal with at least as many integer and fraction
    digits. ``bigint -> double`` is not among them (the reader refuses
    INT64 as DOUBLE), nor is an integral type to decimal."""
    if isinstance(old, (T.ByteType, T.ShortType, T.IntegerType)):
        if isinstance(new, T.DoubleType):
            return True
        return type(new) in _INTEGRAL_RANK and _INTEGRAL_RANK[type(new)] > _INTEGRAL_RANK[type(old)]
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return False


def schema_changes(old: T.StructType, new: T.StructType, numeric_widening: bool = False,
                   strict: str = "symmetric") -> list[tuple[str, str | None, str | None, str]]:
    """Differences that force a rebuild of old partitions.

    Returns ``(path, old_type, new_type, reason)`` rows. Root columns may be
    added or removed freely (readers match them by name); a changed leaf type
    anywhere, or a nested field added or removed, is a breaking change.
    ``strict="old_only"`` only reports nested fields of the old schema (added
    nested fields pass), ``numeric_widening`` lets the widenings of
    ``_widening_ok`` pass (those the Parquet reader applies to old files).
    """
    lo, ln = leaf_paths(old), leaf_paths(new)
    changes = []
    for path in sorted(set(lo) | set(ln)):
        name = ".".join(path)
        a, b = lo.get(path), ln.get(path)
        if a is not None and b is not None:
            if a != b and not (numeric_widening and _widening_ok(a, b)):
                changes.append((name, type_string(a), type_string(b), "type"))
        elif len(path) > 1:
            root = path[0]
            root_in_both = any(p[0] == root for p in lo) and any(p[0] == root for p in ln)
            if not root_in_both:
                continue
            if a is None and strict == "old_only":
                continue
            changes.append((name, type_string(a) if a else None, type_string(b) if b else None,
                            "added" if a is None else "removed"))
    return changes


def needs_recalc(old: T.StructType, new: T.StructType, numeric_widening: bool = False,
                 strict: str = "symmetric") -> bool:
    """Does a table stored with ``old`` need a full rebuild to accept ``new``?"""
    return bool(schema_changes(old, new, numeric_widening=numeric_widening, strict=strict))
