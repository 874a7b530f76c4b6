"""Normaliser rules with the hand-derived fixtures N1-N22 of FIXTURES.md."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakenorm import normalize
from lakenorm.operators.normalize import case_merge, distinct_rows


def rows(df):
    return sorted(df.collect(), key=str)


def test_n1_flat_collision_first_in_code_point_order(jsonl):
    df = jsonl([{"id": 1, "Foo": "a", "foo": "b"}, {"id": 2, "foo": "c"}])
    out = normalize(df)
    assert out.columns == ["foo", "id"]
    assert rows(out) == [Row(foo="a", id=1), Row(foo="c", id=2)]


def test_n1_precedence_last(jsonl):
    df = jsonl([{"id": 1, "Foo": "a", "foo": "b"}])
    assert normalize(df, precedence="last").collect() == [Row(foo="b", id=1)]


def test_n2_duplicate_rows(jsonl):
    lines = [{"id": 1, "Foo": "a", "foo": "b"}, {"id": 2, "foo": "c"}]
    assert rows(normalize(jsonl(lines + lines))) == [Row(foo="a", id=1), Row(foo="c", id=2)]


def test_n3_nested_collision(jsonl):
    df = jsonl([{"id": 1, "User": {"Id": 7}, "user": {"id": 8, "n": "z"}}])
    out = normalize(df)
    assert out.schema.simpleString() == "struct<id:bigint,user:struct<id:bigint,n:string>>"
    assert out.collect() == [Row(id=1, user=Row(id=7, n="z"))]


def test_n4_null_struct_kept_or_expanded(jsonl):
    df = jsonl([{"id": 1, "user": {"n": "z"}}, {"id": 2, "user": None}])
    assert rows(normalize(df))[1] == Row(id=2, user=None)
    assert rows(normalize(df, null_struct="expand"))[1] == Row(id=2, user=Row(n=None))


def test_n5_array_duplicates(jsonl):
    df = jsonl([{"id": 1, "Items": [{"A": 1, "b": "x"}, {"A": 1, "b": "x"}, {"A": 2}]}])
    assert normalize(df).collect() == [Row(id=1, items=[Row(a=1, b="x"), Row(a=2, b=None)])]


def test_n6_null_and_empty_arrays(jsonl):
    df = jsonl([{"id": 1, "items": [{"a": 1, "b": "x"}]}, {"id": 2, "items": []}, {"id": 3, "items": None}])
    out = {r.id: r.items for r in normalize(df).collect()}
    assert out == {1: [Row(a=1, b="x")], 2: [], 3: []}


def test_array_that_one_colliding_member_lacks_is_empty(jsonl):
    df = jsonl([{"id": 1, "Items": [{"a": 1, "xs": []}]}, {"id": 1, "items": [{"a": 1}]},
                {"id": 2, "Items": [{"a": 2, "xs": [{"b": 3}]}], "items": [{"a": 2}]}])
    once = normalize(df)
    assert {r.id: r["items"] for r in once.collect()} == {1: [Row(a=1, xs=[])], 2: [Row(a=2, xs=[Row(b=3)]), Row(a=2, xs=[])]}
    assert once.count() == 2 and rows(normalize(once)) == rows(once)


def test_n7_all_null_element_one_row(jsonl):
    df = jsonl([{"id": 1, "items": [{"a": None, "b": None}, {"a": 1, "b": "x"}]}])
    assert normalize(df).collect() == [Row(id=1, items=[Row(a=1, b="x")])]


def test_n8_single_field_struct(jsonl):
    df = jsonl([{"id": 1, "items": [{"a": 1}, {"a": 2}]}])
    assert normalize(df).schema["items"].dataType.simpleString() == "array<struct<a:bigint>>"
    out = normalize(df, unwrap_single_field=True)
    assert out.collect() == [Row(id=1, items=[1, 2])]


def test_n9_only_an_array_column(jsonl):
    assert normalize(jsonl([{"items": [{"a": 1}]}])).count() == 1


def test_n10_equal_rows_different_arrays(jsonl):
    df = jsonl([{"id": 1, "items": [{"a": 1, "b": 1}]}, {"id": 1, "items": [{"a": 2, "b": 2}]}])
    assert normalize(df).count() == 2
    fused = normalize(df, rows="fuse").collect()
    assert fused == [Row(id=1, items=[Row(a=1, b=1), Row(a=2, b=2)])]


def test_n11_sibling_arrays_unchanged(jsonl):
    df = jsonl([{"id": 1, "x": [{"a": 1, "b": 1}, {"a": 2, "b": 2}], "y": [{"c": 1, "d": 1}]}])
    out = normalize(df).collect()
    assert out == [Row(id=1, x=[Row(a=1, b=1), Row(a=2, b=2)], y=[Row(c=1, d=1)])]


def test_n12_colliding_arrays_concatenated(jsonl):
    df = jsonl([{"id": 1, "Items": [{"a": 1, "b": 1}], "items": [{"a": 2, "b": 2}]}])
    assert normalize(df).collect() == [Row(id=1, items=[Row(a=1, b=1), Row(a=2, b=2)])]


def test_n13_common_prefix_not_swallowed(jsonl):
    df = jsonl([{"user": {"n": "z"}, "user_id": 5}])
    out = normalize(df)
    assert out.schema.simpleString() == "struct<user:struct<n:string>,user_id:bigint>"


def test_n14_awkward_names_kept(jsonl):
    df = jsonl([{"a.b": 1, "a___b": 2, "x_exploded": 3, "p$": 4, "s": {"q.r": 5}}])
    out = normalize(df)
    assert out.columns == ["a.b", "a___b", "p$", "s", "x_exploded"]
    assert out.collect()[0]["s"]["q.r"] == 5


def test_n15_n16_atomic_arrays_unchanged(jsonl):
    df = jsonl([{"id": 1, "tags": ["x", "x"], "m": [[1], [1]]}])
    assert normalize(df).collect() == [Row(id=1, m=[[1], [1]], tags=["x", "x"])]
    assert normalize(df, dedup_atomic_arrays=True).collect()[0].tags == ["x"]


@pytest.mark.parametrize("depth,expected", [
    (0, "struct<a:struct<B:struct<C:struct<D:bigint>>>>"),
    (1, "struct<a:struct<b:struct<C:struct<D:bigint>>>>"),
    (2, "struct<a:struct<b:struct<c:struct<D:bigint>>>>"),
    (None, "struct<a:struct<b:struct<c:struct<d:bigint>>>>"),
])
def test_n17_depth(jsonl, depth, expected):
    df = jsonl([{"A": {"B": {"C": {"D": 1}}}}])
    assert normalize(df, depth=depth).schema.simpleString() == expected


def test_n18_partition_column_clash(jsonl, spark):
    from lakenorm.sources.json_source import read_json_table
    path = jsonl(None, partitioned={"20240101": [{"DT": "x", "id": 1}]})
    with pytest.raises(ValueError):
        read_json_table(spark, path)


def test_n18_helper_names_kept(jsonl):
    df = jsonl([{"drop": True, "tmp_dt": "x", "id": 1}])
    assert normalize(df).columns == ["drop", "id", "tmp_dt"]


def test_n19_type_conflict_to_string(jsonl):
    df = jsonl([{"K": 1}, {"k": "x"}])
    out = normalize(df)
    assert out.schema.simpleString() == "struct<k:string>"
    assert sorted(r.k for r in out.collect()) == ["1", "x"]


def test_n19_nested_type_conflict(jsonl):
    df = jsonl([{"S": {"v": 1}, "s": {"V": 2.5}}, {"s": {"v": "t"}}])
    out = normalize(df)
    assert out.schema.simpleString() == "struct<s:struct<v:string>>"


def test_n20_corrupt_line_kept(jsonl):
    df = jsonl([{"id": 1}, "not json"])
    out = normalize(df)
    assert "_corrupt_record" in out.columns and out.count() == 2


def test_n21_empty_input(spark):
    df = spark.createDataFrame([], "")
    assert normalize(df) is df


def test_n22_duplicates_across_partitions_kept(jsonl, spark):
    from lakenorm.sources.json_source import read_json_table
    path = jsonl(None, partitioned={"20240101": [{"id": 1}], "20240102": [{"id": 1}]})
    assert normalize(read_json_table(spark, path)).count() == 2


def test_map_columns_dedup(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (2, {"b": 2})], "id int, m map<string,int>")
    assert distinct_rows(df).count() == 2
    assert normalize(df).count() == 2


def test_case_merge_only_root(jsonl):
    df = jsonl([{"A": 1, "s": {"X": 1}}])
    assert case_merge(df).schema.simpleString() == "struct<a:bigint,s:struct<X:bigint>>"


def test_canonical_arrays(jsonl):
    df = jsonl([{"id": 1, "x": [{"a": 2}, {"a": 1}]}, {"id": 1, "x": [{"a": 1}, {"a": 2}]}])
    assert normalize(df).count() == 2
    assert normalize(df, canonical_arrays=True).count() == 1


def test_nested_arrays_inside_arrays(jsonl):
    df = jsonl([{"id": 1, "O": [{"L": [{"P": 1}, {"P": 1}], "n": 1}, {"l": [{"p": 2}], "N": 1}]}])
    out = normalize(df).collect()[0]
    # colliding members inside the element are merged; inner duplicates go
    assert out.o == [Row(l=[Row(p=1)], n=1), Row(l=[Row(p=2)], n=1)]


def test_one_exchange_in_plan(jsonl):
    df = jsonl([{"id": 1, "Items": [{"A": 1}]}, {"id": 1, "items": [{"a": 2}]}])
    plan = normalize(df)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange " in line for line in plan.splitlines()) == 1


def test_properties_idempotent_sorted_lowercase(jsonl):
    df = jsonl([{"B": 1, "a": {"Z": [{"Y": 1, "x": None}], "c": 2}}, {"b": 2, "A": {"z": None}}])
    once = normalize(df)
    twice = normalize(once)
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)
    text = once.schema.json()
    assert text == text.lower()

    def sorted_everywhere(dt):
        from pyspark.sql import types as T
        if isinstance(dt, T.StructType):
            names = [f.name for f in dt.fields]
            return names == sorted(names) and all(sorted_everywhere(f.dataType) for f in dt.fields)
        if isinstance(dt, T.ArrayType):
            return sorted_everywhere(dt.elementType)
        return True
    assert sorted_everywhere(once.schema)


def test_row_order_and_split_independent(jsonl):
    lines = [{"id": i % 5, "Items": [{"a": i % 3}, {"A": i % 3}]} for i in range(40)]
    a = normalize(jsonl(lines)).collect()
    b = normalize(jsonl(list(reversed(lines))).repartition(7)).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_fuse_two_arrays_sequential(jsonl):
    df = jsonl([{"k": 1, "a": [{"v": 1}], "b": [{"w": 1}]},
                {"k": 1, "a": [{"v": 2}], "b": [{"w": 1}]},
                {"k": 1, "a": [{"v": 3}], "b": [{"w": 2}]}])
    out = normalize(df, rows="fuse").select("k", F.size("a").alias("na"), F.size("b").alias("nb")).collect()
    assert sorted(out) == [Row(k=1, na=1, nb=1), Row(k=1, na=2, nb=1)]


def test_dedup_keys_keeps_smallest_row_per_key_and_day(jsonl, spark):
    from lakenorm.sources.json_source import read_json_table
    path = jsonl(None, partitioned={"20240101": [{"Id": 1, "v": "b"}, {"id": 1, "v": "a"}, {"id": 2, "v": "c"}],
                                    "20240102": [{"id": 1, "v": "z"}]})
    out = normalize(read_json_table(spark, path), dedup_keys=["ID"])
    assert sorted(out.collect(), key=str) == sorted([Row(id=1, v="a", dt="20240101"), Row(id=2, v="c", dt="20240101"),
                                                     Row(id=1, v="z", dt="20240102")], key=str)


def test_fuse_spreads_hot_groups(spark):
    """A hot group (half of all rows, many copies of few elements): duplicates
    go by a hash aggregate over (key, element) first, then the key collects."""
    from lakenorm.operators.fuse import fuse_arrays
    base = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.array(F.struct((F.col("id") % 97).alias("v"))).alias("a"))
    out = fuse_arrays(base)
    hot = out.filter(F.col("k") == 0).collect()[0]
    assert [e.v for e in hot.a] == sorted({i % 97 for i in range(0, 4000, 2)}) and out.count() == 2001
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("collect_set" in ln for ln in lines) == 0 and sum("partial_collect_list" in ln for ln in lines) == 1
    assert sum("HashAggregate(keys=[k" in ln and "functions=[]" in ln for ln in lines) >= 1


def test_awkward_names_at_every_level(jsonl):
    """Names with a back quote, a quote, a backslash, a dot and a space, at the
    root, in a struct and in array elements, colliding in case."""
    odd = ["a`b", "it's", "back\\slash", "x.y", "sp ace"]
    rec = {n: 1 for n in odd}
    rec["St"] = {n.upper(): "v" for n in odd} | {n: None for n in odd}
    rec["Arr"] = [{n: i for n in odd} for i in range(2)] * 2
    rec["A`B"] = 2
    df = jsonl([rec, rec])
    out = normalize(df)
    assert [f.name for f in out.schema.fields] == sorted(["a`b", "it's", "back\\slash", "x.y", "sp ace", "st", "arr"])
    r = out.collect()
    assert len(r) == 1
    row = r[0].asDict(recursive=True)
    assert row["a`b"] == 2 and row["it's"] == 1       # "A`B" precedes "a`b" in code-point order
    assert row["st"] == {n: "v" for n in sorted(odd)}
    assert row["arr"] == [{n: i for n in sorted(odd)} for i in range(2)]


def test_fuse_unites_nested_arrays_of_equal_parents(jsonl):
    """Two equal parents become one with the union; siblings are never paired."""
    df = normalize(jsonl([
        {"id": 1, "a": [{"k": "x", "n": [{"v": 1}], "m": [{"w": 1}]}, {"k": "x", "n": [{"v": 2}], "m": [{"w": 1}]}, {"k": "y", "n": [], "m": []}]},
        {"id": 1, "a": [{"k": "y", "n": [{"v": 7}], "m": []}]},
    ]), rows="fuse")
    (r,) = df.collect()
    assert [(e.k, [x.v for x in e.n], [x.w for x in e.m]) for e in r.a] == [("x", [1, 2], [1]), ("y", [7], [])]


def test_fuse_folds_arrays_inside_root_structs(jsonl):
    df = normalize(jsonl([
        {"id": 1, "s": {"t": {"items": [{"v": 1}]}, "c": 5}}, {"id": 1, "s": {"t": {"items": [{"v": 2}]}, "c": 5}},
        {"id": 1, "s": {"t": {"items": [{"v": 3}]}, "c": 6}}, {"id": 2, "s": None}, {"id": 2, "s": None},
    ]), rows="fuse")
    got = sorted((r.id, r.s and (r.s.c, [x.v for x in r.s.t["items"]])) for r in df.collect())
    assert got == [(1, (5, [1, 2])), (1, (6, [3])), (2, None)]
    assert df.schema["s"].dataType.simpleString() == "struct<c:bigint,t:struct<items:array<struct<v:bigint>>>>"


def test_maps_inside_arrays_of_structs_are_kept(spark):
    df = spark.createDataFrame([(1, [({"x": 1},), ({"x": 1},)])], "id int, a array<struct<m: map<string, int>>>")
    (r,) = normalize(df).collect()
    assert [e.m for e in r.a] == [{"x": 1}, {"x": 1}]


def test_unfold_refuses_two_columns_of_one_name(jsonl):
    import pytest
    from lakenorm.operators.unfold import unfold_structs
    with pytest.raises(ValueError, match="a___b"):
        unfold_structs(jsonl([{"a": {"b": 1}, "a___b": 2}]))
