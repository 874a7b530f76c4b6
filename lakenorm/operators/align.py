"""Schema alignment, witness row, null sentinels, column metadata.

Alignment is ``DataFrame.to(schema)``: it matches by name at every level
(also inside arrays of structs), fills missing columns with nulls and casts
where the type is wider. The reference's witness row is offered for users who
want it, but no result depends on it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .normalize import conform, ddl, q

# Sentinel values of the witness row (fixed values, as in the reference):
# strings, integral numbers, floating numbers, booleans.
STRING_SENTINEL = "___NOVALUE___"
INT_SENTINEL = -2147483648
DOUBLE_SENTINEL = -1.7976931348623157e308
BOOL_SENTINEL = False


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder, add (as null) and widen columns to ``schema``, by name.

    Columns of ``df`` that ``schema`` lacks raise, so data is never dropped
    silently; unify the schemas first (``functions.schema.unify_schemas``).
    """
    missing = [c for c in df.columns if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"columns {missing} are not part of the target schema")
    exprs = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        value = conform(q(f.name), have[f.name], f.dataType) if f.name in have else f"CAST(NULL AS {ddl(f.dataType)})"
        exprs.append(f"{value} AS {q(f.name)}")
    return df.selectExpr(*exprs)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union with missing columns filled by null, nested structs merged."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def null_fill(df: DataFrame, string_value: str = STRING_SENTINEL, int_value: int = INT_SENTINEL,
              double_value: float | None = DOUBLE_SENTINEL, bool_value: bool = BOOL_SENTINEL) -> DataFrame:
    """``na.fill`` per type. As in the reference, the integral fill also reaches
    floating columns (``na.fill(int)`` applies to every numeric column)."""
    out = df.na.fill(string_value).na.fill(int_value)
    if double_value is not None:
        out = out.na.fill(double_value)
    return out.na.fill(bool_value)


def _sentinel(dt: T.DataType) -> Column | None:
    if isinstance(dt, T.StringType):
        return F.lit(STRING_SENTINEL)
    if isinstance(dt, T.BooleanType):
        return F.lit(BOOL_SENTINEL)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.lit(INT_SENTINEL).cast(dt)
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(INT_SENTINEL).cast(dt)
    return None


def _fill_deep(col: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StructType):
        return F.struct(*[_fill_deep(col.getField(f.name), f.dataType).alias(f.name) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        elem = _fill_deep(F.lit(None).cast(dt.elementType), dt.elementType)
        filled = F.transform(col, lambda x: _fill_deep(x, dt.elementType))
        return F.when(F.size(col) > 0, filled).otherwise(F.array(elem))
    value = _sentinel(dt)
    return col if value is None else F.coalesce(col, value)


def witness_row(df: DataFrame) -> DataFrame:
    """One row of ``df`` with every null (also nested, also null or empty
    arrays) replaced by a type sentinel, so the row shows every column.

    ``limit(1)`` reads little only above a plan without a shuffle; for a
    normalised table pass ``normalized_projection(df)`` rather than
    ``normalize(df)``, whose whole-row dedup would run over all the data to
    give one row."""
    picked = df.limit(1)
    return picked.select(*[_fill_deep(F.col(q(f.name)), f.dataType).alias(f.name) for f in df.schema.fields])


def tag_drop_rename(df: DataFrame, tags: dict[str, object] | None = None, drop: list[str] | None = None,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """Constant tag columns, dropped columns, renamed columns."""
    out = df
    if tags:
        out = out.withColumns({k: F.lit(v) for k, v in tags.items()})
    if drop:
        out = out.drop(*drop)
    if rename:
        out = out.withColumnsRenamed(rename)
    return out


def set_comment(df: DataFrame, column: str, comment: str | None, append: bool = False) -> DataFrame:
    """Set, append to or (``comment=None``) remove a column comment."""
    meta = dict(df.schema[column].metadata)
    if comment is None:
        meta.pop("comment", None)
    elif append and meta.get("comment"):
        meta["comment"] = f"{meta['comment']},{comment}"
    else:
        meta["comment"] = comment
    return df.withMetadata(column, meta)


def comments(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}
