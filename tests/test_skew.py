import pytest

from sparkseg.operators.skew import fits, salted_left_join


@pytest.mark.parametrize("most", [100, 0])
def test_every_row_once_whichever_way(spark, most):
    rows = [(i, "hot" if i % 3 else "k%d" % (i % 7)) for i in range(500)] + [(1000, None), (1001, "absent")]
    left = spark.createDataFrame(rows, "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), (None, 9)], "r string, v int")
    got = salted_left_join(left, right, {"k": "r"}, most=most)
    value = {"hot": 1, "k0": 2, "k3": 3}
    assert {r.i: r.v for r in got.collect()} == {i: value.get(k) for i, k in rows}
    assert got.count() == 502 and got.columns == ["i", "k", "r", "v"]
    assert salted_left_join(left, right.where("false"), {"k": "r"}, most=most).where("v IS NULL").count() == 502


def test_few_wide_rows_are_not_broadcast(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    wide = spark.createDataFrame([("a", "x" * 50_000), ("b", None)], "r string, v string")
    assert fits(wide) and not fits(wide, size=10_000) and not fits(wide, rows=1) and fits(wide.where("false"), size=0)
    assert {r.k: len(r.v or "") for r in salted_left_join(left, wide, {"k": "r"}).collect()} == {"a": 50_000, "b": 0, "c": 0}
