import random

import pytest

from sparkseg.operators.periods import continuous_periods

SCHEMA = "rec_id string, speaker string, start_ms bigint, end_ms bigint"


def brute(rows):
    """Periods and gaps by sorting each key's intervals."""
    groups = {}
    for rec, who, a, b in rows:
        if a is not None and b is not None and b > a:
            groups.setdefault((rec, who), []).append((a, b))
    out = []
    for key, spans in groups.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(*key, "period", a, b) for a, b in merged]
        out += [(*key, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])]
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in continuous_periods(df, ["rec_id", "speaker"], **more).collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_random_intervals_match_sorting(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        a = rng.randrange(0, 60_000)
        rows.append((rng.choice(["x", "y", None]), rng.choice(["p", "q", None]), a, a + rng.choice([1, 5, 200, 3000, 15_000, 0, -4])))
    rows += [("x", "p", None, 5), ("x", "p", 5, None)]
    assert run(spark, rows, bucket_ms=7000) == brute(rows)


def test_touching_nested_and_spanning_buckets(spark):
    rows = [("r", "s", 0, 1000), ("r", "s", 1000, 2000), ("r", "s", 100, 200), ("r", "s", 2001, 2500), ("r", "t", 0, 100_000), ("r", "t", 50_000, 60_000), ("r", "t", 99_999, 100_001)]
    assert run(spark, rows, bucket_ms=1000) == [("r", "s", "gap", 2000, 2001), ("r", "s", "period", 0, 2000), ("r", "s", "period", 2001, 2500), ("r", "t", "period", 0, 100_001)]


def test_negative_times_ties_and_repeats(spark):
    rows = [("r", "s", -5000, -4000)] * 3 + [("r", "s", -4000, 10), ("r", "s", 500, 600)]
    assert run(spark, rows, bucket_ms=1000) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([("r", "s", 0, 10, 1, 2, 3)], SCHEMA + ", b int, s int, kind int")
    assert [tuple(r) for r in continuous_periods(df, ["rec_id", "speaker"]).collect()] == [("r", "s", "period", 0, 10)]


def test_one_key_with_most_rows(spark):
    rows = [("hot", "s", 1000 * i, 1000 * i + (1000 if i % 3 else 700)) for i in range(3000)] + [("cold", "s", 0, 1)]
    assert run(spark, rows, bucket_ms=10_000) == brute(rows)
