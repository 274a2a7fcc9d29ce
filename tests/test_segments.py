import datetime

import pytest
from pyspark.sql import functions as F

from sparkseg.operators import folds, overlaps, segments
from sparkseg.plans import operators

DAY = datetime.datetime(2025, 1, 1)


def seg(spark, rows):
    """Rows (s, e, speaker) of one recording, ids by place."""
    return spark.createDataFrame([("r", i, s, e, who) for i, (s, e, who) in enumerate(rows)], "rec_id string, seg_id bigint, s bigint, e bigint, speaker string")


def spans(df):
    return sorted((r.s, r.e) for r in df.collect())


def test_first_delivery_with_valid_times(spark):
    raw = [(1, "r", 0.0, 1.0, "late", DAY.replace(day=2)), (1, "r", 0.0, 1.0, "first", DAY), (2, "r", 5.0, 5.0, "x", DAY), (3, "r", None, 2.0, "x", DAY), (4, "r", 0.0005, 0.0016, "x", DAY)]
    df = spark.createDataFrame(raw, "seg_id bigint, rec_id string, start double, end double, speaker string, ingested_at timestamp")
    assert sorted((r.seg_id, r.s, r.e, r.speaker) for r in segments.segments(df).collect()) == [(1, 0, 1000, "first"), (4, 1, 2, "x")]


def test_split_at_exact_multiples(spark):
    out = segments.split_long(seg(spark, [(0, 30_000, "a"), (40_000, 70_001, "a"), (100_000, 160_000, "b"), (200_000, 290_500, "b")]))
    assert spans(out) == [(0, 30_000), (40_000, 70_000), (70_000, 70_001), (100_000, 130_000), (130_000, 160_000), (200_000, 230_000), (230_000, 260_000), (260_000, 290_000), (290_000, 290_500)]
    assert sorted(r["index"] for r in out.collect()) == [f"{i:05d}" for i in range(9)]


def test_index_beyond_five_digits(spark):
    assert spark.range(1).select(segments.index_text(F.lit(123456))).first()[0] == "123456"


def test_padding(spark):
    df = seg(spark, [(100, 900, "a"), (950, 1000, "a")]).withColumn("d", F.lit(1000))
    assert spans(segments.padded(df, 0, 0, "d")) == [(100, 900), (950, 1000)]
    assert spans(segments.padded(df, -200, 300, "d")) == [(0, 1000), (750, 1000)]
    assert spans(segments.padded(df, 0, -400, "d")) == [(100, 500), (950, 950)]


def test_denesting(spark):
    df = seg(spark, [(0, 10_000, "a"), (1000, 2000, "b"), (1500, 10_000, "b"), (3000, 10_001, "a"), (20_000, 20_500, "a")])
    assert spans(segments.denested(df)) == [(0, 10_000), (3000, 10_001), (20_000, 20_500)]


def test_silences_at_the_limit(spark):
    df = seg(spark, [(300, 1000, "a"), (1299, 2000, "a"), (2300, 2500, "a")])
    durations = spark.createDataFrame([("r", 2800), ("empty", 500)], "rec_id string, duration_ms bigint")
    got = sorted((r.rec_id, r.start_ms, r.end_ms) for r in segments.silence_gaps(df, 300, durations).collect())
    assert got == [("empty", 0, 500), ("r", 0, 300), ("r", 2000, 2300), ("r", 2500, 2800)]


def test_overlaps(spark):
    rows = [(0, 1000, "a"), (1000, 2000, "a"), (1800, 2500, "b"), (1800, 1900, "b"), (1799, 5000, "a")]
    got = {(r.seg1, r.seg2): r.overlap_ms for r in overlaps.overlap_pairs(seg(spark, rows), 200, bucket_ms=100).collect()}
    assert got == {(1, 4): 201, (1, 2): 200, (4, 2): 700}
    assert overlaps.overlap_pairs(seg(spark, []), 200).count() == 0


@pytest.mark.parametrize("bucket", [70, 1000])
def test_overlaps_match_all_pairs(spark, bucket):
    import random

    rng = random.Random(bucket)
    rows = [(a, a + rng.randrange(1, 400), "x") for a in (rng.randrange(3000) for _ in range(80))]
    want = sum(min(p[1], q[1]) - max(p[0], q[0]) >= 50 for i, p in enumerate(rows) for q in rows[i + 1 :])
    assert overlaps.overlap_pairs(seg(spark, rows), 50, bucket).count() == want


def test_reference_is_the_first_free_one(spark):
    rows = [(0, 5000, "a"), (3000, 6000, "b"), (7000, 8999, "a"), (10_000, 12_000, "a"), (20_000, 30_000, "a")]
    assert [(r.speaker, r.seg_id) for r in overlaps.reference_segments(seg(spark, rows)).collect()] == [("a", 3)]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(0, 30_000, "a")], [(0, 30_000)]),
        ([(0, 30_000, "a"), (30_500, 31_000, "a")], [(0, 30_000)]),
        ([(0, 3000, "a"), (4999, 5500, "a")], [(0, 5500)]),
        ([(0, 3000, "a"), (5000, 5500, "a")], [(0, 3000)]),
        ([(0, 5000, "a"), (4000, 4500, "a")], [(0, 4500)]),
        ([(0, 2000, "a"), (2100, 3500, "a"), (3600, 4000, "b"), (4100, 4600, "a")], [(0, 3500)]),
        ([(0, 65_000, "a"), (65_500, 66_000, "a")], [(0, 30_000), (30_000, 60_000), (60_000, 66_000)]),
        ([], []),
    ],
)
def test_cut_by_speaker(spark, rows, want):
    assert spans(folds.cut_by_speaker(seg(spark, rows))) == want


def chunks(spark, total, silences, **more):
    s = spark.createDataFrame([("r", a, b) for a, b in silences], "rec_id string, start_ms bigint, end_ms bigint")
    d = spark.createDataFrame([("r", total)], "rec_id string, duration_ms bigint")
    return sorted((r.start_2ms / 2, r.end_2ms / 2) for r in folds.chunk_ranges(s, d, 1000, **more).collect())


def test_chunks(spark):
    assert chunks(spark, 1001, []) == [(0, 1001)]
    assert chunks(spark, 2500, []) == [(0, 1000), (1000, 2000), (2000, 2500)]
    assert chunks(spark, 2500, [(900, 1100), (300, 500)]) == [(0, 1000), (1000, 2500)]
    assert chunks(spark, 2500, [(900, 1100), (300, 500)], capped=True) == [(0, 1000), (1000, 2000), (2000, 2500)]
    assert chunks(spark, 2500, [(1400, 1600)]) == [(0, 1000), (1000, 1500), (1500, 2500)]
    assert chunks(spark, 0, []) == [(0, 0)]


def test_widest_gap(spark):
    assert folds.gap_parts([], 20) == []
    assert folds.gap_parts([(0, 100)], 20) == [(0, 100)]
    assert folds.gap_parts([(0, 5), (6, 12), (13, 19)], 20) == [(0, 19)]
    assert folds.gap_parts([(0, 5), (6, 12), (13, 20)], 20) == [(0, 5), (6, 20)]
    df = seg(spark, [(0, 30_000, "a"), (30_000, 40_000, "a")])
    speech = spark.createDataFrame([(0, [(0, 9000), (12_000, 30_000)])], "seg_id bigint, stamps array<struct<s:bigint,e:bigint>>")
    assert spans(folds.max_gap_split(df, speech)) == [(0, 9000), (12_000, 30_000), (30_000, 40_000)]


def test_index_dedup_keeps_nulls(spark):
    df = seg(spark, [(0, 1, "a"), (1, 2, "a"), (2, 3, "a"), (3, 4, "a")]).withColumn("index", F.when(F.col("seg_id") < 2, "00000"))
    assert sorted(r.seg_id for r in segments.first_by_index(df).collect()) == [0, 2, 3]


def test_tags_by_first_appearance(spark):
    df = seg(spark, [(0, 1, "SPEAKER_02"), (2, 3, "SPEAKER_100"), (4, 5, "SPEAKER_02"), (6, 7, None)]).withColumn("text", F.lit("x"))
    assert [r.text for r in segments.speaker_tags(df).orderBy("s").collect()] == ["[s0]x", "[s1]x", "[s0]x"]
    assert segments.tagged_text(df).first()["text"].splitlines()[-1] == "[Unknown]: x"


def test_context_and_words(spark):
    df = seg(spark, [(0, 1, "a"), (2, 3, "a"), (4, 5, "a")]).withColumn("text", F.col("seg_id").cast("string"))
    assert [r.context for r in segments.caption_context(df).orderBy("s").collect()] == [[], ["0"], ["0", "1"]]
    words = spark.createDataFrame([([("w", 0.5, 1.0)],), (None,)], "words array<struct<word:string,start:double,end:double>>")
    got = words.select(segments.word_times(F.col("words"), F.lit(2.0)).alias("w")).collect()
    assert got[0].w[0].start == 2.5 and got[1].w is None


def test_relabel(spark):
    mapping = spark.createDataFrame([("r", "a", "Ann"), ("r", "a", "Zed"), ("q", "b", "Bo")], "rec_id string, speaker string, label string")
    got = segments.relabelled(seg(spark, [(0, 1, "a"), (1, 2, "b"), (2, 3, None)]), mapping)
    assert [r.label for r in got.orderBy("s").collect()] == ["Ann", None, None]


def test_long_segments_with_empty_words_hide_nested_ones(spark, tmp_path):
    word = "array<struct<word:string,start:double,end:double>>"
    rows = [(1, "r", 0.0, 25.0, "a", [], DAY), (2, "r", 5.0, 9.0, "b", None, DAY), (3, "r", 30.0, 35.0, "a", None, DAY)]
    spark.createDataFrame(rows, f"seg_id bigint, rec_id string, start double, end double, speaker string, words {word}, ingested_at timestamp").write.parquet(str(tmp_path / "seg_result.parquet"))
    assert spans(operators.max_gap_split(spark, str(tmp_path))) == [(30_000, 35_000)]
