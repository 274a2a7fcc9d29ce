import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseg.functions import text as tx
from sparkseg.functions import vectors as vx
from sparkseg.functions.columns import hash_edge, millis
from sparkseg.functions.models import band_embedding, energy_diarizer, energy_speech, is_music, per_sound
from sparkseg.operators import quality
from sparkseg.plans import operators


def one(spark, expr, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr).first()[0]


def test_millis(spark):
    got = spark.createDataFrame([(0.0015,), (90.25699999999999,), (None,), (math.nan,)], "x double").select(millis("x")).collect()
    assert [r[0] for r in got] == [2, 90257, None, None]


@pytest.mark.parametrize(("ms", "shown", "srt"), [(0, "00:00:00.000", "00:00:00,000"), (59_999, "00:00:59.999", "00:00:59,999"), (3_600_000, "01:00:00.000", "01:00:00,000"), (86_400_000 + 61_001, "24:01:01.001", "00:01:01,001")])
def test_times(spark, ms, shown, srt):
    assert one(spark, tx.display_time("x"), ms, "bigint") == shown
    assert one(spark, tx.srt_time("x"), ms, "bigint") == srt


def test_texts(spark):
    assert one(spark, tx.char_count("x"), 'a, b。"c"\n') == 4
    assert one(spark, tx.char_count("x"), None) is None
    assert one(spark, tx.tokens("x"), " a　b\n c ") == ["a", "b", "c"]
    assert one(spark, tx.has_text("x"), " \n ") is False
    assert one(spark, tx.has_text("x"), None) is False
    assert one(spark, tx.last_line("x"), " a\nb \n") == "b"
    assert one(spark, tx.safe_name("x"), "é b/(1).x") == "é_b__1_.x"
    assert one(spark, tx.stem("x"), "/a/b.c/name.tar.gz") == "name.tar"
    assert one(spark, tx.latin_phrases("x"), "이 open mic은 it's 2") == ["open mic", "it's"]
    assert one(spark, tx.pronounced("x", str.upper), "이 open mic은") == "이 OPEN MIC은"
    assert one(spark, tx.pronounced("x", str.upper), None) is None
    assert one(spark, tx.pronounced("x", lambda p: 1 / 0), "a") == "a"


def test_jaccard(spark):
    a = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")
    assert one(spark, tx.jaccard(a("a", "b", "b"), a("b", "c"))) == pytest.approx(1 / 3)
    assert one(spark, tx.jaccard(a(), a("b"))) == 0


def test_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(y)) for y in x])
    assert one(spark, vx.cosine(v(1, 0), v(1, 1))) == pytest.approx(math.sqrt(0.5))
    assert one(spark, vx.cosine(v(0, 0), v(1, 1))) == -1
    assert one(spark, vx.cosine(F.lit(None).cast("array<double>"), v(1, 1))) == -1
    assert one(spark, vx.rms(v(3, 4))) == pytest.approx(math.sqrt(12.5))
    assert one(spark, vx.rms(F.array().cast("array<double>"))) == 0
    assert one(spark, vx.peak(v(-3, 2))) == 3
    assert one(spark, vx.amplitude_matched(v(1, -1), F.lit(3.0))) == [1, -1]
    assert one(spark, vx.amplitude_matched(v(0, 0), F.lit(3.0))) == [0, 0]
    assert one(spark, vx.normalised(v(-4, 2))) == [-1, 0.5]
    assert one(spark, vx.samples(v(*range(10)), F.lit(250), F.lit(549), 10)) == [2, 3, 4]
    assert [one(spark, vx.gain_db(F.lit(x))) for x in (-30.0, -21.0, 0.0, float("-inf"))] == [3, 1, -3, 0]


def test_scores_follow_polynomials(spark):
    for personal, table in ((False, vx.MOS_GENERAL), (True, vx.MOS_PERSONAL)):
        for kind, c in table.items():
            assert one(spark, vx.mos_corrected(F.lit(3.3), kind, personal)) == pytest.approx(np.polyval(c, 3.3))


@pytest.mark.parametrize(("ms", "want"), [(0, []), (9010, [0]), (10_500, [0]), (12_000, [0, 1000, 2000]), (4000, [0, 1000, 2000, 3000, 4000, 5000, 6000]), (9009, list(range(0, 9000, 1000)))])
def test_hops(spark, ms, want):
    assert one(spark, vx.hop_starts("x"), ms, "bigint") == want


def test_repetition(spark):
    phrase = " ".join(f"w{i}" for i in range(15))
    rows = [(1, ""), (2, None), (3, "a " * 14), (4, " ".join([phrase] * 5)), (5, " ".join([phrase] * 6)), (6, " ".join(f"{phrase} x{i}" for i in range(6))), (7, "a " * 19), (8, "a " * 20)]
    got = {r.id: r.keep for r in quality.kept_by_repetition(spark.createDataFrame(rows, "id int, text string"), "id").collect()}
    assert got == {1: False, 2: False, 3: True, 4: True, 5: False, 6: False, 7: True, 8: False}


def test_audio_limits(spark):
    rows = [(i, "x" * 10, 3.0 + i / 10) for i in range(8)] + [(8, "x", 5.0), (9, "", 5.0), (10, "x" * 10, 30.0), (11, None, 5.0), (12, "x" * 100, 30.0)]
    df = spark.createDataFrame(rows, "id int, text string, d double")
    rates = [d / len(t) for _, t, d in rows if t]
    a, b = np.percentile(rates, [25, 75])
    want = [i for i, t, d in rows if t and len(t) >= 2 and 3 <= d <= 30 and a - 1.5 * (b - a) <= d / len(t) <= b + 1.5 * (b - a)]
    assert sorted(r.id for r in quality.valid_audio(df, "d").collect()) == want
    scored = df.withColumn("q", F.when(F.col("id") < 3, 3.0).when(F.col("id") < 5, 2.9))
    assert sorted(r.id for r in quality.valid_audio(scored, "d", score="q").collect()) == [0, 1, 2]
    assert quality.valid_audio(df.where("false"), "d").count() == 0


def test_model_failures_stay_in_their_row(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [0.0])], "id int, wave array<double>")
    got = per_sound(df, lambda: (lambda x: 1 / x), lambda m, r: m(float(r["wave"][0])), "y", "double").orderBy("id").collect()
    assert got[0].y == 1 and got[0].error is None
    assert got[1].y is None and got[1].error.startswith("ZeroDivisionError")


def test_stand_ins():
    wave = np.concatenate([np.zeros(1000), np.sin(np.arange(2000)), np.zeros(1000)])
    assert len(energy_speech(wave, 1000)) == 1
    assert energy_diarizer(wave, 1000)[0].split()[2] == "speaker_1"
    assert band_embedding(wave[:100], 1000) is None and len(band_embedding(wave, 1000)) == 16


def test_music_is_strictly_above(spark):
    assert [one(spark, is_music("x"), p, "double") for p in (0.3, 0.31, None)] == [False, True, False]


def test_hash_edge(spark):
    assert hash_edge(2) == 2**63 - 1 and hash_edge(0) == -(2**63) and hash_edge(0.5) == 0
    spark.range(1).where(F.xxhash64("id") <= hash_edge(0.9999999)).count()


def test_korean_texts_without_a_label_are_pronounced(spark, tmp_path):
    rows = [(1, "이 open mic은", "ko"), (2, "이 open mic은", None), (3, "the open mic", None), (4, "이 open mic", "en"), (5, None, "ko")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text for r in operators.pronounced(spark, str(tmp_path)).collect()}
    assert got == {1: "이 <open mic>은", 2: "이 <open mic>은", 5: None}
