import random

import pytest
from pyspark.sql import functions as F

from sparkseg.operators.ordered import fold_sorted, ordered, time_bucket


@pytest.mark.parametrize("bucket", [50, 1000, 10**9])
def test_order_across_buckets(spark, bucket):
    rng = random.Random(bucket)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(1000), i, rng.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint, v int")
    out = ordered(df, ["k"], time_bucket("t", bucket), ["t", "id"], number="n", lag={"was": F.col("v")}, lead={"next": F.col("id")}, running_max={"most": F.col("v")})
    got = {r.id: (r.n, r.was, r.next, r.most) for r in out.collect()}
    for key in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(own):
            before = [x[3] for x in own[:i] if x[3] is not None]
            assert got[r[2]] == (i, own[i - 1][3] if i else None, own[i + 1][2] if i + 1 < len(own) else None, max(before) if before else None)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, t bigint")
    assert ordered(df, ["k"], time_bucket("t"), ["t"], number="n").count() == 0


def test_fold_keeps_large_numbers_and_nulls(spark):
    rows = [("a", 2**60 + 1, 1), ("a", None, 0), ("b", 5, 0), (None, 7, 0)]
    df = spark.createDataFrame(rows, "k string, v bigint, o int")

    def fold(key, group):
        yield key[0], [v for _, v, _ in group]

    got = {r.k: r.vs for r in fold_sorted(df, ["k"], ["o"], fold, "k string, vs array<bigint>").collect()}
    assert got == {"a": [None, 2**60 + 1], "b": [5], None: [7]}
