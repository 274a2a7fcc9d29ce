import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseg.functions import sound
from sparkseg.functions import vectors as vx
from sparkseg.operators import enrich
from sparkseg.plans import app
from sparkseg.sources import files


def write(path, x, rate=1000):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((x * 32767).astype("<i2").tobytes())


def test_done_recordings_are_passed_over(spark, tmp_path):
    (tmp_path / "in").mkdir()
    t = np.arange(3000) / 1000
    write(tmp_path / "in" / "a.wav", 0.5 * np.sin(2 * np.pi * 30 * t))
    write(tmp_path / "in" / "b.wav", np.zeros(3000))
    (tmp_path / "in" / "c.wav").write_bytes(b"x")
    out = str(tmp_path / "out")
    assert {r.rec_id: r.status for r in app.run(spark, str(tmp_path / "in"), out).collect()} == {"a": "done", "b": "empty", "c": "failed"}
    write(tmp_path / "in" / "d.wav", 0.5 * np.sin(2 * np.pi * 30 * t))
    assert {r.rec_id: r.status for r in app.run(spark, str(tmp_path / "in"), out).collect()} == {"c": "failed", "d": "done"}
    assert {r.rec_id for r in app.durations(spark, out).collect()} == {"a", "d"}


def test_standard_sound():
    x = np.sin(2 * np.pi * 5 * np.arange(1000) / 1000)
    made = sound.standardised(0.01 * np.stack([x, x], axis=1), 1000, 500)
    assert len(made["wave"]) == 500 and made["gain_db"] == 3 and np.isclose(np.abs(made["wave"]).max(), 1)
    assert np.allclose(made["wave"], x[::2], atol=0.02)
    silent = sound.standardised(np.zeros(10), 10, 10)
    assert silent["gain_db"] == 0 and not silent["wave"].any()
    assert len(sound.resampled(np.zeros(0), 10, 20)) == 0
    assert sound.mel_features(np.random.default_rng(0).standard_normal(16_000), 16_000).shape == (100, 120)


@pytest.mark.parametrize("ms", [0, 4000, 9009, 9010, 10_500, 12_000])
def test_windows_are_those_of_the_column(spark, ms):
    want = spark.createDataFrame([(ms,)], "x bigint").select(vx.hop_starts("x")).first()[0]
    assert len(sound.windows(np.ones(ms), 1000)) == len(want)


def test_captions_scores_and_noise(spark):
    rows = [("r", i, 1000 * i, 1000 * i + 900, f"t{i}", [1.0] * 10_000, 1000, i != 1) for i in range(3)]
    df = spark.createDataFrame(rows, "rec_id string, seg_id bigint, s bigint, e bigint, text string, sound array<double>, rate int, separated boolean")

    def caption(wave, rate, context):
        if context == ["t0"]:
            raise ValueError("no answer")
        return "thinking\n" + "|".join(context)

    assert [r.caption for r in enrich.captioned(df, lambda: caption, context=True).orderBy("s").collect()] == ["thinking", "", "t0|t1"]
    clean = enrich.denoised(df.withColumn("text", F.when(F.col("seg_id") > 0, F.col("text"))), lambda: (lambda w, r, t: w[:2] * 0)).orderBy("s").collect()
    assert [r.clean for r in clean] == [None, None, [0.0, 0.0]]
    got = enrich.scored(df, lambda: (lambda w, r: (3.0, 3.0, 3.0))).first().score
    assert got.num_hops == 1 and got.sig_raw == 3 and abs(got.ovr - np.polyval(vx.MOS_GENERAL["ovr"], 3.0)) < 1e-9


def test_logged_duration(spark):
    lines = spark.createDataFrame([("a", 0, "Audio duration: 12.5 seconds"), ("a", 1, "x"), ("a", 2, "Audio duration: 7 seconds"), ("b", 0, "nothing")], "log string, place int, line string")
    assert {r.log: r.seconds for r in files.logged_seconds(lines, ["log"]).collect()} == {"a": 7.0, "b": None}
