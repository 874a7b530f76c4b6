"""Schema algebra: rebuild decision (S1-S6), unification (U1-U4), rows."""

import pytest
from pyspark.sql import types as T

from lakenorm.functions.schema import (is_flat, needs_recalc, schema_changes, schema_rows, unify_schemas,
                                       unify_types)


def st(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def test_s1_s2_rebuild(spark):
    S1 = st("id bigint, a string, st struct<p:bigint>")
    S2 = st("id bigint, a double, st struct<p:bigint,q:string>, extra boolean")
    changes = {c[0]: c[3] for c in schema_changes(S1, S2)}
    assert changes == {"a": "type", "st.q": "added"}
    assert needs_recalc(S1, S2)


@pytest.mark.parametrize("old,new,expected", [
    ("id bigint, a string", "id bigint, a string, b bigint", False),   # S3
    ("id bigint, a string, b bigint", "id bigint, a string", False),   # S4
    ("st struct<p:bigint>", "st struct<p:bigint,q:string>", True),     # S5
    ("a bigint", "a double", True),                                    # S6
])
def test_s3_to_s6(spark, old, new, expected):
    assert needs_recalc(st(old), st(new)) is expected


def test_s6_numeric_widening_and_old_only(spark):
    # only widenings the Parquet reader applies to old files pass; bigint -> double does not
    assert needs_recalc(st("a bigint"), st("a double"), numeric_widening=True)
    assert not needs_recalc(st("a int, b float, c decimal(10,2)"), st("a bigint, b double, c decimal(20,4)"),
                            numeric_widening=True)
    assert not needs_recalc(st("a int"), st("a double"), numeric_widening=True)
    assert needs_recalc(st("a int"), st("a decimal(20,0)"), numeric_widening=True)
    assert needs_recalc(st("a double"), st("a bigint"), numeric_widening=True)
    assert not needs_recalc(st("st struct<p:bigint>"), st("st struct<p:bigint,q:string>"), strict="old_only")


@pytest.mark.parametrize("old,new,unified,rebuild", [
    ("a string", "a bigint", "a string", False),              # U1
    ("a bigint", "a double", "a double", True),               # U2
    ("a bigint", "a string", "a string", True),               # U3
    ("a array<bigint>", "a array<string>", "a array<string>", True),
])
def test_u1_to_u3(spark, old, new, unified, rebuild):
    u = unify_schemas(st(old), st(new))
    assert u == st(unified)
    assert needs_recalc(st(old), u) is rebuild


def test_u4_empty_array_does_not_change_type(spark):
    # an array seen only empty is inferred as array<string>; when comparing
    # schemas (never a witness), a stored array<bigint> stays and needs nothing
    assert not needs_recalc(st("a array<bigint>"), unify_schemas(st("a array<bigint>"), st("b bigint")))


def test_unify_lattice(spark):
    assert unify_types(T.IntegerType(), T.LongType()) == T.LongType()
    assert unify_types(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert unify_types(T.BooleanType(), T.LongType()) == T.StringType()
    assert unify_types(T.ArrayType(T.LongType()), st("x bigint")) == T.StringType()
    assert unify_types(T.NullType(), T.LongType()) == T.LongType()
    assert unify_types(T.LongType(), T.DecimalType(21, 0)) == T.DecimalType(21, 0)


def test_schema_rows_and_is_flat(spark):
    s = st("c_custkey bigint, os array<struct<o_orderkey:bigint,o_orderstatus:string>>, c struct<name:string>")
    assert schema_rows(s) == [("c_custkey", "bigint"), ("os_exploded___o_orderkey", "bigint"),
                              ("os_exploded___o_orderstatus", "string"), ("c___name", "string")]
    assert schema_rows(s, depth=0) == [("c_custkey", "bigint"),
                                       ("os", "array<struct<o_orderkey:bigint,o_orderstatus:string>>"),
                                       ("c", "struct<name:string>")]
    assert not is_flat(s)
    assert is_flat(st("a bigint, tags array<string>"))


def test_widenings_that_pass_keep_old_files_readable(spark, tmp_path):
    """Every pair ``numeric_widening`` lets pass can be read from old files."""
    pairs = [("int", "bigint"), ("int", "double"), ("smallint", "int"), ("tinyint", "bigint"), ("float", "double"),
             ("decimal(10,2)", "decimal(20,4)"), ("decimal(20,2)", "decimal(30,2)")]
    for i, (old, new) in enumerate(pairs):
        assert not needs_recalc(st(f"x {old}"), st(f"x {new}"), numeric_widening=True), (old, new)
        path = str(tmp_path / f"w{i}")
        spark.sql(f"SELECT CAST(12 AS {old}) AS x").write.parquet(path)
        for vectorized in ("true", "false"):
            spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
            try:
                assert spark.read.schema(f"x {new}").parquet(path).collect()[0][0] == 12, (old, new)
            finally:
                spark.conf.unset("spark.sql.parquet.enableVectorizedReader")
