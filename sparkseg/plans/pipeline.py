"""Recordings to result documents: the steps of a speech-corpus pipeline as one plan."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseg.functions.models import Lazily, Models, per_sound
from sparkseg.functions.text import pronounced
from sparkseg.operators.enrich import captioned, denoised, standard_sounds
from sparkseg.operators.ensemble import rover
from sparkseg.operators.segments import padded, split_long, word_times
from sparkseg.operators.separation import music_removed, repair_overlaps
from sparkseg.operators.slices import slices
from sparkseg.operators.voices import link_speakers
from sparkseg.sources.files import LINE, diarization_rows

#: What is done to the frame of a stage before the next one: nothing, or its being written and timed.
Stage = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Settings:
    chunk_ms: int = 120_000
    silence_ms: int = 300
    pad_onset_ms: int = 0
    pad_offset_ms: int = 0
    alike: float = 0.75
    longest_ms: int = 30_000
    least_samples: int = 160
    language: str | None = None
    #: Samples a second that recordings are brought to, with their peak at 1; None leaves them.
    standard_rate: int | None = None
    music: bool = False
    music_above: float = 0.3
    #: Overlaps of at least so many ms taken apart; None leaves them.
    overlap_ms: int | None = None
    both: bool = False
    words: bool = False
    captions: bool = False
    context: bool = False
    korean: bool = False
    denoise: bool = False
    #: Whether the segments keep rate and sound.
    sounds: bool = False


def chunked(recordings: DataFrame, models: Models, settings: Settings) -> DataFrame:
    """Rows (rec_id, chunk, offset_ms, rate, wave) of recordings cut in the middle of silences.

    The cuts need a recording's sound, which is one row; the chunks, of bounded length where there
    are silences, go their own ways from there.
    """
    make, most, least = models.detector, settings.chunk_ms, settings.silence_ms

    def cuts(wave: np.ndarray, rate: int, detect) -> list[tuple[int, int]]:
        total = len(wave)
        limit, speech = most * rate // 1000, detect(wave, rate)
        edges = [0, *(x for span in speech for x in span), total]
        middles = [(a + b) // 2 for a, b in zip(edges[::2], edges[1::2]) if b - a >= max(1, least * rate // 1000)]
        out, begin = [], 0
        while total - begin > limit + rate // 1000:
            ahead = [m for m in middles if begin < m]
            near = [m for m in ahead if m <= begin + limit]
            end = near[-1] if near else begin + limit if ahead or not middles else total
            out.append((begin, end))
            begin = end
        if begin < total or not out:
            out.append((begin, total))
        return out

    def use(detect, row) -> list[dict]:
        wave, rate = np.asarray(row["wave"], dtype=np.float64), int(row["rate"])
        return [{"offset_ms": a * 1000 // rate, "wave": wave[a:b].astype(np.float32).tolist()} for a, b in cuts(wave, rate, detect)]

    made = per_sound(recordings.select("rec_id", "rate", "wave"), make, use, "chunks", "array<struct<offset_ms:bigint,wave:array<float>>>")
    return made.select("rec_id", "rate", F.posexplode("chunks").alias("chunk", "c")).select("rec_id", F.col("chunk").cast("bigint").alias("chunk"), "rate", "c.offset_ms", "c.wave")


def diarized(chunks: DataFrame, models: Models, settings: Settings) -> DataFrame:
    """Rows (rec_id, chunk, offset_ms, place, rate, s, e, speaker, vector) of the speakers' spans of each chunk, times of the chunk.

    The stage that holds a chunk's sound diarizes it and embeds each span; only lines and vectors leave it.
    """
    diarizer, embedder, onset, offset = models.diarizer, models.embedder, settings.pad_onset_ms, settings.pad_offset_ms

    def use(both: tuple, row: dict) -> list[dict]:
        wave, rate = np.asarray(row["wave"], dtype=np.float64), int(row["rate"])
        out = []
        for line in both[0](wave, rate):
            found, vector = re.match(LINE, line), None
            if found:
                s, e = (round(float(found[i]) * 1000) for i in (1, 2))
                s, e = max(0, s + onset), min(max(0, e + offset), len(wave) * 1000 // rate)
                vector = both[1](wave[s * rate // 1000 : max(s, e) * rate // 1000], rate)
            out.append({"line": line, "vector": None if vector is None else [float(x) for x in vector]})
        return out

    made = per_sound(chunks, lambda: (diarizer(), embedder()), use, "found", "array<struct<line:string,vector:array<double>>>")
    lines = made.select("rec_id", "chunk", "offset_ms", "rate", (F.size("wave") * 1000 / F.col("rate")).cast("bigint").alias("duration_ms"), F.posexplode("found").alias("place", "f"))
    rows = diarization_rows(lines.select("rec_id", "chunk", "offset_ms", "rate", "duration_ms", "place", "f.line", "f.vector"))
    spans = padded(rows, onset, offset, "duration_ms")
    return spans.select("rec_id", "chunk", "offset_ms", "place", "rate", "s", "e", "speaker", "vector")


def linked(spans: DataFrame, settings: Settings) -> DataFrame:
    """``spans`` in times of the recording, with speakers of the recording in place of the chunk's."""
    first = F.transform(F.slice(F.sort_array(F.collect_list(F.when(F.col("vector").isNotNull(), F.struct("s", "e", "vector")))), 1, 3), lambda x: x["vector"])
    local = spans.groupBy("rec_id", "chunk", "speaker").agg(F.min("place").alias("place"), first.alias("vs"))
    total = F.aggregate("vs", F.transform(F.col("vs")[0], lambda x: F.lit(0.0)), lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    means = local.withColumn("centroid", F.when(F.size("vs") > 0, F.transform(total, lambda x: x / F.size("vs"))))
    names = link_speakers(means.select("rec_id", "chunk", "place", "speaker", "centroid"), settings.alike).withColumnsRenamed({"rec_id": "__rec", "chunk": "__chunk", "speaker": "__who"})
    joined = spans.join(names, (F.col("rec_id") == F.col("__rec")) & (F.col("chunk") == F.col("__chunk")) & (F.col("speaker") == F.col("__who")))
    return joined.select("rec_id", (F.col("s") + F.col("offset_ms")).alias("s"), (F.col("e") + F.col("offset_ms")).alias("e"), F.col("linked").alias("speaker"))


def with_spans(recordings: DataFrame, segments: DataFrame) -> DataFrame:
    """``recordings`` (rec_id, rate, wave) with ``spans``, the segments of each: a row is a recording, as its sound is."""
    spans = segments.groupBy(F.col("rec_id").alias("__rec")).agg(F.sort_array(F.collect_list(F.struct("s", "e", "seg_id", "speaker"))).alias("spans"))
    return recordings.select("rec_id", "rate", "wave").join(spans, F.col("rec_id") == F.col("__rec"), "left").drop("__rec")


def sounds_of(recordings: DataFrame, segments: DataFrame, models: Models, settings: Settings) -> DataFrame:
    """``segments`` with rate, sound and ``separated``, overlaps taken apart if the settings say so."""
    if settings.overlap_ms is None:
        return slices(recordings, segments, ["rec_id"]).withColumn("separated", F.lit(False))
    made = repair_overlaps(with_spans(recordings, segments), Lazily(models.separator), Lazily(models.embedder), settings.overlap_ms / 1000, settings.both)
    mine = made.withColumnsRenamed({"rec_id": "__rec", "seg_id": "__seg"})
    rates = recordings.select(F.col("rec_id").alias("__r"), F.col("rate").cast("bigint").alias("rate"))
    joined = segments.join(mine, (F.col("rec_id") == F.col("__rec")) & (F.col("seg_id") == F.col("__seg"))).join(rates, F.col("rec_id") == F.col("__r"))
    return joined.drop("__rec", "__seg", "__r")


def transcribed(rows: DataFrame, models: Models, settings: Settings) -> DataFrame:
    """``rows`` (with rate and sound) with hypotheses of all recognizers, text and language; sounds of under 10 ms and empty texts are left out."""
    rows = rows.where(F.size("sound") >= settings.least_samples)
    language = settings.language
    for i, make in enumerate(models.recognizers):
        rows = per_sound(rows, make, lambda m, r: {k: m(np.asarray(r["sound"], dtype=np.float64), int(r["rate"]), language)[k] for k in ("text", "language")}, f"asr{i}", "struct<text:string,language:string>").drop("error")
    n = len(models.recognizers)
    texts = F.array(*[F.coalesce(F.col(f"asr{i}.text"), F.lit("")) for i in range(n)])
    done = rows.withColumn("hypotheses", texts).withColumn("language", F.coalesce(*[F.col(f"asr{i}.language") for i in range(n)]))
    return done.withColumn("text", rover("hypotheses") if n > 1 else F.col("hypotheses")[0]).drop(*[f"asr{i}" for i in range(n)]).where("trim(text) <> ''")


def aligned(rows: DataFrame, models: Models) -> DataFrame:
    """``rows`` with ``words`` on the recording's clock; null where the aligner failed."""
    use = lambda m, r: [{"word": w, "start": float(a), "end": float(b)} for w, a, b in m(np.asarray(r["sound"], dtype=np.float64), int(r["rate"]), r["text"], r["language"])]
    made = per_sound(rows, models.aligner, use, "words", "array<struct<word:string,start:double,end:double>>").drop("error")
    return made.withColumn("words", word_times(F.col("words"), F.col("s") / 1000))


def process(recordings: DataFrame, models: Models | None = None, settings: Settings | None = None, stage: Stage = lambda name, df: df) -> DataFrame:
    """Rows (rec_id, seg_id, index, s, e, speaker, hypotheses, language, text, ...) of recordings (rec_id, rate, wave).

    Cut at silences, diarized by chunk, speakers linked across chunks, segments cut to length,
    transcribed and voted. By the settings recordings are standardised first, music is taken out (``demucs``),
    overlaps are taken apart (``separated``), words are timed (``words``), segments described (``caption``),
    Latin phrases of Korean texts pronounced, and separated sounds cleaned (``clean``). Models are plugged in; the default
    ones need no weights. ``stage`` gets each stage's frame by name and gives it back, maybe written and timed.
    """
    models, settings = models or Models(), settings or Settings()
    given = recordings.where("rec_id IS NOT NULL AND wave IS NOT NULL AND rate > 0").select("rec_id", "rate", "wave")
    if settings.standard_rate:
        made = standard_sounds(given, settings.standard_rate).where("standard IS NOT NULL")
        given = stage("standardisation", made.select("rec_id", F.col("standard.rate").cast("bigint").alias("rate"), F.col("standard.wave").alias("wave")))
    spans = linked(diarized(chunked(given, models, settings), models, settings), settings).where("e > s").distinct()
    cut = split_long(spans.withColumn("seg_id", F.xxhash64("rec_id", "s", "e", "speaker")), settings.longest_ms).drop("piece")
    segments = stage("vad_diarization", cut.withColumn("seg_id", F.xxhash64("rec_id", "s", "e", "speaker")))
    if settings.music:
        quiet = stage("music_removal", music_removed(with_spans(given, segments), Lazily(models.tagger), Lazily(models.vocals), above=settings.music_above))
        given = quiet.select("rec_id", "rate", "wave")
        flags = quiet.select(F.col("rec_id").alias("__rec"), F.inline("flags")).withColumnsRenamed({"seg_id": "__seg", "music": "__music"})
        marked = segments.join(flags, (F.col("rec_id") == F.col("__rec")) & (F.col("seg_id") == F.col("__seg")), "left")
        segments = marked.withColumn("demucs", F.coalesce("__music", F.lit(False))).drop("__rec", "__seg", "__music")
    rows = sounds_of(given, segments, models, settings)
    if settings.overlap_ms is not None:
        rows = stage("separation", rows)
    rows = stage("recognition", transcribed(rows, models, settings))
    if settings.words:
        rows = stage("alignment", aligned(rows, models))
    if settings.captions:
        rows = stage("captions", captioned(rows, models.captioner, settings.context))
    if settings.korean:
        rows = rows.withColumn("text", F.when(F.col("language") == "ko", pronounced("text", models.pronounce)).otherwise(F.col("text")))
    if settings.denoise:
        rows = stage("denoising", denoised(rows, models.denoiser))
    return rows if settings.sounds else rows.drop("sound", "rate", "clean")


def settings_grid(spark: SparkSession, **choices: list) -> DataFrame:
    """One row per combination of the choices of each setting; their number is that of the combinations given."""
    rows = [tuple(map(str, c)) for c in product(*choices.values())]
    return spark.createDataFrame(rows, ", ".join(f"`{k}` string" for k in choices))


