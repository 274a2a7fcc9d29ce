import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseg.functions.models import band_embedding, halves
from sparkseg.operators import separation
from sparkseg.operators.voices import Linker, centroids, link_speakers, nearest


def test_centroid_of_the_first_three(spark):
    rows = [("k", i, v) for i, v in enumerate([None, [1.0, 0.0], [3.0, 0.0], [5.0, 3.0], [100.0, 0.0]])] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "k string, o int, embedding array<double>")
    got = centroids(df, ["k"], ["o"]).collect()
    assert [(r.k, r.centroid, r.used) for r in got] == [("k", [3.0, 1.0], 3)]


def test_nearest(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([0.0, 1.0],), (None,), ([1.0, 1.0],)], "v array<double>")
    c = F.array(F.struct(F.lit("a").alias("label"), F.array(F.lit(1.0), F.lit(0.0)).alias("vector")), F.struct(F.lit("b").alias("label"), F.array(F.lit(0.0), F.lit(1.0)).alias("vector")))
    assert [r[0] for r in df.select(nearest("v", c)).collect()] == ["a", "b", "a", "a"]


def test_linking_rules():
    e = np.eye(3)
    link = Linker(0.75)
    assert [k for _, k, _ in link.chunk([("p", e[0]), ("q", e[1]), ("r", None), ("s", np.zeros(3))])] == [0, 1, 2, 3]
    assert [k for _, k, _ in link.chunk([("x", e[1]), ("y", e[1]), ("z", None)])] == [1, 4, 5]
    exactly = np.array([0.75, 0, np.sqrt(1 - 0.75**2)])
    assert [k for _, k, _ in link.chunk([("w", exactly)])] == [0]
    assert link.links[0] == 2 and np.allclose(link.centroids[0], (e[0] + exactly) / 2)


def test_oldest_of_equals():
    link = Linker(0.5)
    list(link.chunk([("a", np.array([1.0, 0])), ("b", np.array([1.0, 0]))]))
    assert [k for _, k, _ in link.chunk([("c", np.array([1.0, 0]))])] == [0]


def test_link_over_chunks(spark):
    rows = [("r", 0, 0, "speaker_0", [1.0, 0.0]), ("r", 0, 1, "speaker_1", [0.0, 1.0]), ("r", 1, 0, "speaker_0", [0.0, 1.0]), ("r", 1, 1, "speaker_1", None), ("q", 0, 0, "speaker_0", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "rec_id string, chunk int, place int, speaker string, centroid array<double>")
    got = {(r.rec_id, r.chunk, r.speaker): r.linked for r in link_speakers(df).collect()}
    assert got == {("r", 0, "speaker_0"): "SPEAKER_00", ("r", 0, "speaker_1"): "SPEAKER_01", ("r", 1, "speaker_0"): "SPEAKER_01", ("r", 1, "speaker_1"): "SPEAKER_02", ("q", 0, "speaker_0"): "SPEAKER_00"}
    assert link_speakers(df.where("false")).count() == 0


def tone(f, n, rate=1000):
    return np.sin(2 * np.pi * f * np.arange(n) / rate)


@pytest.mark.parametrize("both", [False, True])
def test_overlap_goes_to_the_right_speaker(both):
    rate = 1000
    wave = np.concatenate([tone(50, 4000), tone(400, 4000)])
    wave[3000:5000] = tone(50, 2000) + tone(400, 2000)
    solo = [(0.0, 5.0, "low"), (3.0, 8.0, "high"), (10.0, 13.0, "low"), (14.0, 17.0, "high")]
    wave = np.concatenate([wave, np.zeros(2000), tone(50, 3000), np.zeros(1000), tone(400, 3000)])
    got = separation.repair(wave, rate, solo, lambda x, r: halves(x, r)[::-1], band_embedding, both=both)
    assert [g["separated"] for g in got] == [True, True, False, False]
    power = lambda x, f: abs(np.dot(x, tone(f, len(x)))) / len(x)
    part = got[0]["sound"][3000:5000].astype(float)
    assert power(part, 50) > 20 * power(part, 400)
    part = got[1]["sound"][0:2000].astype(float)
    assert power(part, 400) > 20 * power(part, 50)
    assert [len(g["sound"]) for g in got] == [5000, 5000, 3000, 3000]


def test_music_is_taken_out_once():
    calls = []

    def vocals(x, rate):
        calls.append(len(x))
        return np.zeros_like(x)

    wave = np.ones(100)
    out, flags = separation.without_music(wave, 10, [(1, 2), (5, 6), (9.9, 9.95)], lambda x, r: 0.31, vocals, least=8)
    assert flags == [True, True, False] and calls == [100]
    assert out[5:25].sum() == 0 and out[:5].all()
    assert separation.without_music(wave, 10, [(1, 2)], lambda x, r: 0.3, vocals, least=8)[1] == [False]


def test_pieces_and_spectra_round_trip():
    x = np.random.default_rng(0).standard_normal(5000)
    assert np.allclose(separation.overlap_add(x, lambda p: p, 100, 3, 1), x)
    assert np.allclose(separation.overlap_add(x, lambda p: p, 100, 3, 1, denoise=True), x)
    assert np.allclose(separation.from_spectrum(separation.spectrum(x), len(x)), x)
    assert separation.level_outside(np.ones(10), (0, 10), [(0, 10)]) is None
    assert separation.level_outside(np.ones(10), (0, 10), [(2, 4)]) == 1
