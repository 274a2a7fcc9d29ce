import datetime
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkseg.functions.models import Models, spoken_digest
from sparkseg.plans.pipeline import Settings, process, settings_grid
from sparkseg.sources import files, sinks
from sparkseg.streaming import ingest

T0 = datetime.datetime(2025, 1, 1)


def listing(spark, rows):
    return spark.createDataFrame([(p, n, T0) for p, n in rows], "path string, length bigint, modificationtime timestamp_ntz")


def test_listing(spark):
    df = listing(spark, [("a/x.MP3", 5000), ("a/x.MP3", 5000), ("a/y.temp.wav", 9), ("a/z.txt", 9), ("a/w.wav", 10), ("a/v.flac", None), (None, 5), ("a_processed/u.wav", 4000)])
    assert sorted(r.path for r in files.audio_files(df).collect()) == ["a/v.flac", "a/w.wav", "a/x.MP3", "a_processed/u.wav"]
    assert sorted(r.path for r in files.audio_files(df, least_bytes=1024, skip_folders="_processed").collect()) == ["a/x.MP3"]
    assert sorted(r.path for r in files.audio_files(df, any_case=False).collect()) == ["a/v.flac", "a/w.wav", "a_processed/u.wav"]


def test_folders_and_cache(spark):
    df = listing(spark, [("a/b/x y.opus", 1), ("a/b/z.ogg", 2), ("c/x.OPUS", 3), ("d_opus_cache/x.opus", 4), ("e/x.wav", 5)])
    assert sorted(r.folder for r in files.folders_with(df).collect()) == ["a/b"]
    names = files.cache_names(df)
    got = {r.path: r.cached for r in names.collect()}
    assert got["e/x.wav"] is None and got["a/b/x y.opus"].startswith("x_y_") and len(got["a/b/z.ogg"]) == len("z_") + 16 + 4
    have = names.where("path = 'a/b/z.ogg'").select("cached", F.lit("/c/z.wav").alias("decoded"))
    assert files.decode_todo(names, have).count() == 3
    assert {r.path: r.read for r in files.decoded_paths(names, have).collect()} == {"a/b/z.ogg": "/c/z.wav", "e/x.wav": "e/x.wav"}


def test_manifest_and_resume(spark, tmp_path):
    done = spark.createDataFrame([("a",), ("b",)], "folder string")
    files.append_manifest(done, str(tmp_path / "log"))
    files.append_manifest(spark.createDataFrame([("c",)], "folder string"), str(tmp_path / "log"))
    all_ = spark.createDataFrame([("a",), ("d",), ("d",), (None,)], "folder string")
    left = files.to_do(all_, files.read_manifest(spark, str(tmp_path / "log")), "folder")
    assert sorted(str(r.folder) for r in left.collect()) == ["None", "d", "d"]


def test_config(tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_config(str(tmp_path / "no"))
    (tmp_path / "bad").write_text("{")
    with pytest.raises(TypeError):
        files.read_config(str(tmp_path / "bad"))
    (tmp_path / "good").write_text('{"a": 1}')
    assert files.read_config(str(tmp_path / "good")) == {"a": 1}


def test_diarizer_lines(spark):
    df = spark.createDataFrame([("0.5 1.25 speaker_3", 0), (" 2 3.0005 speaker_112 ", 1), ("junk", 2), (None, 3), ("x y speaker_1", 4)], "line string, place int")
    got = files.diarization_rows(df).orderBy("place").collect()
    assert [(r.s, r.e, r.speaker, r.label, r.segment) for r in got] == [(500, 1250, "SPEAKER_03", "A", "[ 00:00:00.500 --> 00:00:01.250]"), (2000, 3001, "SPEAKER_112", "B", "[ 00:00:02.000 --> 00:00:03.001]")]


def test_model_text(spark):
    raws = [None, "", "no", 'x [{"k": 1}] y', '[{"k": 1}] and [{"k": 2}]', "[broken", '```json\n[{"k": 5}]\n``` [', "[{'k': 7}]", "[{'k': None}]", "[(1,"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    kind = "array<struct<k:bigint>>"
    got = df.select("i", files.json_array("raw", kind).alias("a"), files.json_block("raw", kind).alias("b")).orderBy("i").collect()
    assert [r.a and r.a[0].k for r in got[:4]] == [None, None, None, 1] and got[5].a is None
    assert [[x.k for x in r.b] for r in got] == [[], [], [], [], [], [], [5], [7], [None], []]


def write_wave(path, x, rate=1000, channels=1):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.repeat(x, channels) * 32767).astype("<i2").tobytes())


def test_waves_and_clips(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_wave(tmp_path / "in" / "a.wav", np.full(100, 0.5), channels=2)
    (tmp_path / "in" / "b.wav").write_bytes(b"nothing")
    got = {r.rec_id: r for r in files.read_waves(spark, str(tmp_path / "in")).collect()}
    assert got["a"].rate == 1000 and len(got["a"].wave) == 100 and abs(got["a"].wave[0] - 0.5) < 1e-3
    assert got["b"].wave is None and got["b"].error
    assert files.list_files(spark, str(tmp_path / "in")).count() == 2
    clips = spark.createDataFrame([("a", "00000_S.wav", 1000, [0.0, 1.0, -2.0]), ("a", "00001_S.wav", 1000, [])], "rec_id string, name string, rate int, sound array<double>")
    sinks.write_clips(clips, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out" / "a").iterdir()] == ["00000_S.wav"]
    with wave.open(str(tmp_path / "out" / "a" / "00000_S.wav")) as w:
        assert np.frombuffer(w.readframes(3), "<i2").tolist() == [0, 32767, -32767]


def test_documents_and_subtitles(spark, tmp_path):
    rows = [("r", i, 1000 * i, 1000 * i + 500, "S", f"t{i}") for i in range(5)]
    seg = spark.createDataFrame(rows, "rec_id string, seg_id bigint, s bigint, e bigint, speaker string, text string")
    docs = sinks.result_documents(seg, ["seg_id", "text"], size=2)
    got = docs.orderBy("part").collect()
    assert [[x.text for x in r.segments] for r in got] == [["t0", "t1"], ["t2", "t3"], ["t4"]] and got[0].metadata.total_segments == 5
    sinks.write_documents(docs, str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs")).count() == 3
    line = next((tmp_path / "docs" / "rec_id=r").glob("*.json")).read_text().splitlines()[0]
    assert set(json.loads(line)) == {"part", "metadata", "segments"}
    parts = sinks.subtitles(seg, bucket_ms=2000)
    text = "".join(r.srt for r in parts.orderBy("part").collect())
    assert text.startswith("1\n00:00:00,000 --> 00:00:00,500\nS: t0\n\n2\n") and text.count("-->") == 5
    sinks.write_subtitles(parts, str(tmp_path / "srt"))


def test_pipeline_end_to_end(spark):
    rng = np.random.default_rng(0)
    rate = 1000
    speech = np.sin(2 * np.pi * 30 * np.arange(3 * rate) / rate)
    x = np.concatenate([p for _ in range(60) for p in (speech, np.zeros(rate))]) + 1e-4 * rng.standard_normal(240 * rate)
    df = spark.createDataFrame([("rec", rate, x.tolist()), ("none", rate, None)], "rec_id string, rate bigint, wave array<float>")
    three = Models(recognizers=(lambda: spoken_digest, lambda: spoken_digest, lambda: spoken_digest))
    got = process(df, three, Settings()).orderBy("s").collect()
    assert len(got) == 60 and {r.speaker for r in got} == {"SPEAKER_00"}
    assert [r["index"] for r in got] == [f"{i:05d}" for i in range(60)]
    assert all(r.text == r.hypotheses[0] or r.text for r in got) and all(abs(r.s - 4000 * i) < 100 for i, r in enumerate(got))


def test_settings(spark):
    assert settings_grid(spark, a=[1, 2], b=["x", "y", "z"]).count() == 6


def test_stream_counts_each_segment_once(spark, tmp_path):
    schema = "seg_id bigint, rec_id string, start double, end double, ingested_at timestamp"
    rows = [(1, "r", 0.0, 1.5, T0), (2, "r", 2.0, 3.0, T0), (1, "r", 0.0, 1.5, T0 + datetime.timedelta(hours=1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.arriving(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files=1)
    ingest.append_to(ingest.once(stream), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.seg_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
    ingest.append_to(ingest.once(stream), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert ingest.speech_by_window(stream).isStreaming
