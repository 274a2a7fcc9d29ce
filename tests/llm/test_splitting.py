import random

import pytest

from sparkseg.llm.splitting import best_cuts, on_clock, pauses, pieces_of, split_segments


def feasible(start, end, words, limit):
    """Whether cuts at some millisecond of a pause keep all pieces within the limit."""
    points = sorted({p for a, b in pauses(words, start, end) for p in range(a, b + 1)} | {start, end})
    reach = {start}
    for p in points:
        if any(0 < p - q <= limit for q in reach):
            reach.add(p)
    return end in reach


@pytest.mark.parametrize("seed", range(60))
def test_finds_natural_cuts_whenever_there_are_any(seed):
    rng = random.Random(seed)
    limit, words, at = 2000, [], 0
    while at < 9000:
        length = rng.randrange(100, 900)
        words.append((at, at + length))
        at += length + rng.choice([0, 50, 299, 300, 301, 600])
    start, end = 0, words[-1][1]
    cuts, natural = best_cuts(start, end, words, limit)
    assert natural == feasible(start, end, words, limit)
    edges = [start, *cuts, end]
    assert all(0 < b - a <= limit for a, b in zip(edges, edges[1:]))
    if natural:
        assert all(any(a <= c <= b for a, b in pauses(words, start, end)) for c in cuts)


@pytest.mark.parametrize("length", [2001, 4000, 4001, 12_345, 100_000])
def test_without_words_cuts_are_even_and_forced(length):
    cuts, natural = best_cuts(0, length, [], 2000)
    edges = [0, *cuts, length]
    sizes = [b - a for a, b in zip(edges, edges[1:])]
    assert not natural and max(sizes) <= 2000 and len(sizes) == -(-length // 2000) and max(sizes) - min(sizes) <= 1


def test_a_pause_exactly_long_enough():
    assert best_cuts(0, 3000, [(0, 1500), (1800, 3000)], 2000)[1]
    assert not best_cuts(0, 3000, [(0, 1500), (1799, 3000)], 2000)[1]


def test_pieces_overlap_and_stay_within_the_limit():
    words = [(i * 1000, i * 1000 + 600) for i in range(100)]
    pieces = pieces_of(0, 99_600, words, 30_000, 500)
    assert all(p["end_ms"] - p["start_ms"] <= 30_000 for p in pieces)
    assert all(b["start_ms"] == a["end_ms"] - 500 for a, b in zip(pieces, pieces[1:]))
    assert pieces[0]["start_ms"] == 0 and pieces[-1]["end_ms"] == 99_600 and {p["cut"] for p in pieces} == {"natural"}
    with pytest.raises(ValueError):
        pieces_of(0, 10, [], 5, 5)


def test_clocks():
    assert on_clock([(0, 10), (20, 30)], 5000, 6000) == [(5000, 5010), (5020, 5030)]
    assert on_clock([(5000, 5010)], 5000, 6000) == [(5000, 5010)]
    assert on_clock([], 5000, 6000) == []


def test_table(spark):
    words = [("w", float(i), i + 0.6) for i in range(40)]
    rows = [(1, 100.0, 140.0, [(w, a + 100, b + 100) for w, a, b in words]), (1, 100.0, 140.0, [(w, a + 100, b + 100) for w, a, b in words]), (2, 100.0, 140.0, words), (3, 0.0, 40.0, None), (4, 0.0, 40.0, []), (5, 0.0, 30.0, None), (6, None, 40.0, None), (7, 50.0, 10.0, None), (None, 0.0, 31.0, None), (8, 0.0, 40.0, [(None, None, None), ("w", None, 3.0)]), (9, 0.0, 40.0, [None])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "seg_id bigint, start double, end double, words array<struct<word:string,start:double,end:double>>, cut string, a int, piece int")
    got = split_segments(df).where("piece = 0")
    assert {r.seg_id: r.cut for r in got.collect()} == {1: "natural", 2: "natural", 3: "forced", 4: "forced", None: "forced", 8: "forced", 9: "forced"}
    assert got.count() == 7
    assert split_segments(df.where("false")).count() == 0


def test_words_of_the_first_delivery(spark):
    words = lambda at: [("a", 0.0, at), ("b", at + 1, 40.0)]
    late, early = words(25.0), words(20.0)
    schema = "seg_id bigint, start double, end double, words array<struct<word:string,start:double,end:double>>, ingested_at string"
    rows = [(1, 0.0, 40.0, late, "2025-01-02"), (1, 0.0, 40.0, early, "2025-01-01"), (1, 0.0, 40.0, late, None)]
    for some in (rows, rows[::-1]):
        got = split_segments(spark.createDataFrame(some, schema).repartition(3)).orderBy("piece").collect()
        assert len(got) == 2 and 20_000 <= got[0].end_ms <= 21_000
