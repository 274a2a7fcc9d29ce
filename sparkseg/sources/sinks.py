"""Results written: documents, subtitles and clips."""

from __future__ import annotations

import os
import wave as wavfile

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.text import real_time_factor, srt_block
from sparkseg.operators.ordered import BUCKET_MS, ordered, time_bucket
from sparkseg.operators.segments import ORDER

#: Segments of a part of a document.
PART = 1000


def stage_metadata(seconds: Column, duration: Column, enabled: bool | None = None) -> Column:
    """Processing time and real-time factor of a stage, and whether it is on."""
    fields = [seconds.alias("processing_time_seconds"), real_time_factor(seconds, duration).alias("rt_factor")]
    return F.struct(*fields, *([F.lit(enabled).alias("enabled")] if enabled is not None else []))


def recording_metadata(segments: DataFrame, durations: DataFrame | None = None) -> DataFrame:
    """Rows (rec_id, total_segments, audio_duration_seconds, audio_duration_minutes).

    The duration is that of ``durations`` (rec_id, duration_ms) where it has the recording, else the last end.
    """
    about = segments.groupBy("rec_id").agg(F.count("*").alias("total_segments"), F.max("e").alias("__ms"))
    if durations is not None:
        known = durations.groupBy(F.col("rec_id").alias("__rec")).agg(F.max("duration_ms").alias("__given"))
        about = about.join(known, F.col("rec_id").eqNullSafe(F.col("__rec")), "left").withColumn("__ms", F.coalesce("__given", "__ms"))
    seconds = F.col("__ms") / 1000.0
    return about.select("rec_id", "total_segments", seconds.alias("audio_duration_seconds"), (seconds / 60).alias("audio_duration_minutes"))


def result_documents(segments: DataFrame, columns: list[str], size: int = PART, durations: DataFrame | None = None, stages: dict[str, float] | None = None) -> DataFrame:
    """Rows (rec_id, part, metadata, segments): each recording's segments in order, at most ``size`` a row.

    A recording of any length is a bounded row per part; readers that want one document join the
    parts in order. ``metadata`` is that of the whole recording in each. ``stages`` gives the real-time factor of each
    stage over all sound of a run: recordings run together, so each has the seconds of its share of the sound.
    """
    rows = ordered(segments, ["rec_id"], time_bucket("s"), ORDER, number="__i")
    parts = rows.withColumn("part", F.floor(F.col("__i") / size)).groupBy("rec_id", "part").agg(F.sort_array(F.collect_list(F.struct("__i", F.struct(*columns).alias("row")))).alias("__all"))
    seconds = F.col("audio_duration_seconds")
    blocks = [stage_metadata(seconds * factor, seconds, True).alias(name) for name, factor in (stages or {}).items()]
    about = recording_metadata(segments, durations).select(F.col("rec_id").alias("__rec"), F.struct("audio_duration_seconds", "audio_duration_minutes", *blocks, "total_segments").alias("metadata"))
    joined = parts.join(about, F.col("rec_id").eqNullSafe(F.col("__rec")))
    return joined.select("rec_id", "part", "metadata", F.transform("__all", lambda x: x["row"]).alias("segments"))


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents as JSON, a folder for each recording; recordings that are there are replaced, others stay."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rec_id").json(path)


def subtitles(segments: DataFrame, text: str = "text", bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows (rec_id, part, srt): numbered subtitles of a recording in order, a part per time bucket."""
    rows = ordered(segments, ["rec_id"], time_bucket("s", bucket_ms), ORDER, number="__i")
    block = srt_block(F.col("__i") + 1, "s", "e", "speaker", text)
    parts = rows.withColumn("part", time_bucket("s", bucket_ms)).groupBy("rec_id", "part").agg(F.sort_array(F.collect_list(F.struct("__i", block.alias("block")))).alias("all"))
    return parts.select("rec_id", "part", F.array_join(F.transform("all", lambda x: x["block"]), "").alias("srt"))


def write_subtitles(parts: DataFrame, path: str) -> None:
    """Subtitles as text, a folder for each recording and in it one for each part, so that a long recording isn't one task's."""
    parts.select("rec_id", "part", F.col("srt").alias("value")).write.mode("overwrite").partitionBy("rec_id", "part").text(path)


def clip_name(index: Column, speaker: Column, suffix: str = "wav") -> Column:
    return F.concat_ws(".", F.concat_ws("_", index, F.coalesce(speaker, F.lit("UNKNOWN"))), F.lit(suffix))


def clip_sound(denoised: Column, enhanced: Column, plain: Column) -> Column:
    """The best sound that a segment has."""
    return F.coalesce(denoised, enhanced, plain)


def write_clips(clips: DataFrame, folder: str) -> None:
    """Rows (rec_id, name, rate, sound) as 16-bit WAV files ``folder/rec_id/name``; empty sounds are left out.

    Written where the rows are, to a folder that all executors share; a repeated attempt writes
    the same files over.
    """

    def write(rows) -> None:
        for r in rows:
            if not r["sound"]:
                continue
            where = os.path.join(folder, str(r["rec_id"]))
            os.makedirs(where, exist_ok=True)
            pcm = (np.clip(np.asarray(r["sound"], dtype=np.float64), -1, 1) * 32767).astype("<i2")
            part = os.path.join(where, f".{r['name']}.part")
            with wavfile.open(part, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(int(r["rate"]))
                w.writeframes(pcm.tobytes())
            os.replace(part, os.path.join(where, r["name"]))

    clips.select("rec_id", "name", "rate", "sound").foreachPartition(write)
