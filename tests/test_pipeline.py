import json
import random
import sys
import wave

import numpy as np
import pytest
from pyspark import cloudpickle

from sparkseg.functions.models import Models, band_embedding, energy_diarizer, energy_speech, halves
from sparkseg.operators.separation import music_removed
from sparkseg.operators.slices import slices
from sparkseg.plans import app
from sparkseg.plans.pipeline import Settings, process
from sparkseg.sources import files

# the workers can't import the tests
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATE = 1000
SHAPE = "rec_id string, rate bigint, wave array<float>"


@pytest.mark.parametrize("seconds", [1, 7, 1000])
def test_slices_are_those_of_the_whole(spark, seconds):
    rng = random.Random(seconds)
    waves = {f"r{k}": [float(rng.randrange(100)) for _ in range(n)] for k, n in enumerate((0, 1, 999, 1000, 5003))}
    spans = [(f"r{rng.randrange(6)}", i, a, a + rng.choice([0, 1, 30, 900, 2000, 9000, -5]), "s") for i in range(120) for a in [rng.randrange(-300, 6000)]]
    df = spark.createDataFrame([(r, 100 if r == "r4" else RATE, w) for r, w in waves.items()] + [("r9", 10, None), (None, 10, [1.0])], SHAPE)
    given = spark.createDataFrame([*spans, *spans[:5], (None, 1, 0, 5, "x")], "rec_id string, seg_id bigint, s bigint, e bigint, sound_of string")
    want = {}
    for rec, i, s, e, _ in spans:
        rate = 100 if rec == "r4" else RATE
        part = waves.get(rec, [])[max(0, s) * rate // 1000 : max(0, e * rate // 1000)]
        if part:
            want[i] = part
    got = slices(df, given, ["rec_id"], seconds).collect()
    assert {r.seg_id: r.sound for r in got} == want and len(got) == len(want)
    assert slices(df, given.where("false"), ["rec_id"]).count() == 0 and slices(df.where("false"), given, ["rec_id"]).count() == 0


def tone(f, seconds, rate=RATE):
    return np.sin(2 * np.pi * f * np.arange(int(seconds * rate)) / rate)


class Named:
    """Recognizers that know planted tones, whatever their level."""

    def __init__(self, language="en"):
        self.language = language

    def __call__(self, wave, rate, language=None):
        power = lambda f: abs(np.dot(wave, tone(f, len(wave) / rate, rate)[: len(wave)])) / max(1, len(wave))
        low, high = power(20), power(400)
        text = "low" if low > 5 * high else "high" if high > 5 * low else "both low and high"
        return {"text": text, "language": self.language, "words": None}


def planted():
    """Low, high, low and a stretch that music is laid under, with silences between."""
    x = np.concatenate([tone(20, 3), np.zeros(1000), tone(400, 3), np.zeros(1000), tone(20, 3), np.zeros(1000), tone(400, 3)])
    return 0.5 * x


def test_every_step_leaves_its_mark(spark):

    def caption(wave, rate, context):
        return "thinking\n" + "|".join(context)

    models = Models(
        diarizer=lambda: energy_diarizer, detector=lambda: energy_speech, embedder=lambda: band_embedding,
        recognizers=(lambda: Named("ko"), lambda: Named("ko"), lambda: Named("ko")),
        tagger=lambda: (lambda w, r: float(np.abs(w).max() > 0.9 and len(w) > 3200)), vocals=lambda: (lambda w, r: 0.5 * np.asarray(w)),
        captioner=lambda: caption, denoiser=lambda: (lambda w, r, t: w[:3] * 0),
    )
    settings = Settings(standard_rate=RATE, music=True, music_above=0.3, overlap_ms=1000, words=True, captions=True, context=True, korean=True, denoise=True, sounds=True, least_samples=10)
    df = spark.createDataFrame([("rec", RATE, planted().tolist()), ("none", RATE, None)], SHAPE)
    order = []
    got = process(df, models, settings, lambda name, f: (order.append(name), f)[1]).orderBy("s").collect()
    assert order == ["standardisation", "vad_diarization", "music_removal", "separation", "recognition", "alignment", "captions", "denoising"]
    assert [r.text for r in got] == ["<low>", "<high>", "<low>", "<high>"]
    assert [r.speaker for r in got] == ["SPEAKER_00", "SPEAKER_01", "SPEAKER_00", "SPEAKER_01"]
    assert [r.caption for r in got] == ["thinking", "low", "low|high", "high|low"]
    assert all(abs(np.max(np.abs(r.sound)) - 1) < 0.05 for r in got)  # standardised; too short for the tagger's least samples
    assert [(r.words[0].word, round(r.words[0].start), round(r.words[-1].end)) for r in got] == [("low", 0, 3), ("high", 4, 7), ("low", 8, 11), ("high", 12, 15)]
    assert all(r.clean is None and not r.separated and not r.demucs for r in got)


def test_overlaps_are_taken_apart_and_music_is_marked(spark):
    x = planted()
    x = np.concatenate([x, np.zeros(1000), 0.5 * tone(20, 5)])
    x[16_000 + 2000 : 16_000 + 5000] += 0.5 * tone(400, 3)
    lines = ["0.000 3.000 speaker_0", "4.000 7.000 speaker_1", "8.000 11.000 speaker_0", "12.000 15.000 speaker_1", "16.000 21.000 speaker_0", "18.000 21.000 speaker_1"]
    models = Models(diarizer=lambda: (lambda w, r: lines), recognizers=(lambda: Named(),), separator=lambda: (lambda w, r: halves(w, r)[::-1]), tagger=lambda: (lambda w, r: 0.9), vocals=lambda: (lambda w, r: w), denoiser=lambda: (lambda w, r, t: w[:3] * 0))
    df = spark.createDataFrame([("rec", RATE, x.tolist())], SHAPE)
    plain = {(r.s, r.e): r.text for r in process(df, models, Settings()).collect()}
    assert plain[16_000, 21_000] == plain[18_000, 21_000] == "both low and high"
    for both in (False, True):
        got = {(r.s, r.e): r for r in process(df, models, Settings(overlap_ms=1000, both=both, denoise=True, sounds=True)).collect()}
        assert got[16_000, 21_000].text == "low" and got[18_000, 21_000].text == "high"
        assert {k for k, r in got.items() if r.separated} == {(16_000, 21_000), (18_000, 21_000)} == {k for k, r in got.items() if r.clean}
    spans = spark.createDataFrame([("rec", RATE, x.tolist(), [(1, 0, 3000, "a"), (2, 4000, 7000, "b")]), ("still", RATE, None, None)], SHAPE + ", spans array<struct<seg_id:bigint,s:bigint,e:bigint,speaker:string>>")
    made = {r.rec_id: r for r in music_removed(spans, lambda w, r: float(abs(np.dot(w[500:3500], tone(20, 3))) > 100), lambda w, r: w * 0, least=10).collect()}
    assert [(f.seg_id, f.music) for f in made["rec"].flags] == [(1, True), (2, False)] and not made["still"].flags
    assert not np.any(made["rec"].wave[:3500]) and np.allclose(made["rec"].wave[4000:7000], x[4000:7000], atol=1e-6)


def write(path, x, rate=RATE):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((x * 32767).astype("<i2").tobytes())


def test_runs_replace_what_an_ended_one_left(spark, tmp_path):
    for name in ("a.wav", "sub/a.wav"):
        write(tmp_path / "in" / name, planted())
    out, clips = str(tmp_path / "out"), str(tmp_path / "clips")
    settings = Settings(words=True, captions=True, overlap_ms=1000)
    assert {r.rec_id: r.status for r in app.run(spark, str(tmp_path / "in"), out, None, settings, True, clips).collect()} == {"a": "done", "sub/a": "done"}
    # ended before the log was written: the documents are there, the recordings are done over
    for f in (tmp_path / "out" / "done").iterdir():
        f.unlink()
    app.run(spark, str(tmp_path / "in"), out, None, settings, True, clips)
    docs = spark.read.json(out + "/documents").collect()
    assert sorted(r.rec_id for r in docs) == ["a", "sub/a"]
    about = docs[0].metadata
    assert about.audio_duration_seconds == 15.0 and about.total_segments == 4 == len(docs[0].segments)
    for name in ("vad_diarization", "separation", "recognition", "alignment", "captions"):
        assert about[name].enabled and about[name].rt_factor > 0 and abs(about[name].processing_time_seconds - about[name].rt_factor * 15) < 1e-6
    assert docs[0].segments[0].words[0].word and docs[0].segments[0].caption == ""
    assert len(list((tmp_path / "clips" / "a").glob("*.wav"))) == 4 == len(list((tmp_path / "clips" / "sub" / "a").glob("*.wav")))


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_sample_widths_and_decoders(spark, tmp_path, width):
    (tmp_path / "in").mkdir()
    values = np.array([0.0, 0.5, -0.5, 0.25])
    whole = (values * 2 ** (8 * width - 1)).astype(np.int64) + (128 if width == 1 else 0)
    with wave.open(str(tmp_path / "in" / "x.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(width)
        w.setframerate(8)
        w.writeframes(b"".join(int(v).to_bytes(width, "little", signed=width > 1) for v in whole))
    (tmp_path / "in" / "y.raw").write_bytes(bytes([1, 2, 3]))
    assert np.allclose(files.read_waves(spark, str(tmp_path / "in")).first().wave, values, atol=0.01)
    made = {r.rec_id: r for r in files.read_waves(spark, str(tmp_path / "in"), decoders={".raw": lambda b: (3, np.frombuffer(b, dtype=np.uint8))}).collect()}
    assert made["y"].wave == [1.0, 2.0, 3.0] and made["y"].rate == 3 and set(made) == {"y"}


def test_command_line(spark, tmp_path, monkeypatch):
    given = {}
    monkeypatch.setattr(app, "session", lambda *a: spark)
    monkeypatch.setattr(app, "run", lambda s, *a: (given.update(args=a), spark.createDataFrame([("a", "done", 1)], "rec_id string, status string, segments int"))[1])
    app.main(["in", "out", "--recursive", "--music", "--overlap-seconds", "0.5", "--both", "--words", "--captions", "--context", "--korean", "--denoise", "--clips", "c", "--standard-rate", "16000", "--language", "ko", "--models", "sparkseg.functions.models:Models"])
    folder, output, models, settings, recursive, clips = given["args"]
    assert (folder, output, recursive, clips) == ("in", "out", True, "c") and isinstance(models, Models)
    assert settings == Settings(standard_rate=16_000, music=True, overlap_ms=500, both=True, words=True, captions=True, context=True, korean=True, denoise=True, language="ko")
    assert json.dumps(settings.__dict__)
