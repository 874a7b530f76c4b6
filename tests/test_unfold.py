"""unfold / fold of nested frames."""

from pyspark.sql import Row

from lakenorm.operators.unfold import explode_arrays, fold_structs, unfold, unfold_structs


def test_unfold_structs_one_level(jsonl):
    df = jsonl([{"id": 1, "O": {"s": "x", "In": {"P": 2.5}}}])
    one = unfold_structs(df)
    assert one.columns == ["O___In", "O___s", "id"]
    assert unfold(df).collect() == [Row(O___In___P=2.5, O___s="x", id=1)]
    assert unfold(df, depth=1).columns == ["O___In", "O___s", "id"]


def test_explode_keeps_rows_without_elements(jsonl):
    df = jsonl([{"id": 1, "os": [{"k": 1}, {"k": 2}]}, {"id": 2, "os": []}, {"id": 3}])
    out = sorted((r.id, r.os_exploded___k) for r in unfold(df).collect())
    assert out == [(1, 1), (1, 2), (2, None), (3, None)]
    assert explode_arrays(df).count() == 4


def test_nested_array_exploded_siblings_not_crossed(jsonl):
    df = jsonl([{"id": 1, "o": [{"k": 1, "l": [{"p": 1}, {"p": 2}]}]}])
    assert unfold(df).count() == 2
    sib = jsonl([{"id": 1, "x": [{"a": 1}, {"a": 2}], "y": [{"b": 1}, {"b": 2}]}])
    out = unfold(sib)
    assert out.count() == 1 and set(out.columns) == {"id", "x", "y"}


def test_fold_inverts_unfold(jsonl):
    df = jsonl([{"id": 1, "O": {"s": "x", "In": {"P": 2.5}}}])
    back = fold_structs(unfold(df))
    assert back.collect() == [Row(O=Row(In=Row(P=2.5), s="x"), id=1)]
