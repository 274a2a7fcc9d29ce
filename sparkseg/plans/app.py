"""The pipeline over a folder of WAV files: what is done is not done again.

    python -m sparkseg INPUT OUTPUT [--recursive] [--chunk-seconds 120] [--alike 0.75] ...
"""

from __future__ import annotations

import argparse
import importlib
import logging
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseg.functions.models import Models
from sparkseg.plans.pipeline import Settings, process
from sparkseg.session import checkpointed, session, shipped
from sparkseg.sources import files, sinks

log = logging.getLogger("sparkseg")


def finished(spark: SparkSession, output: str) -> DataFrame:
    """Rows (rec_id) of the log of finished recordings; none before the first run."""
    try:
        return files.read_manifest(spark, f"{output}/done").select(F.col("folder").alias("rec_id"))
    except Exception as e:  # noqa: BLE001 - Spark's error for a missing path has several classes
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "rec_id string")


def run(spark: SparkSession, folder: str, output: str, models: Models | None = None, settings: Settings | None = None, recursive: bool = False, clips: str | None = None, decoders: dict | None = None) -> DataFrame:
    """Rows (rec_id, status, segments) of the recordings of this run: done, empty or failed.

    Recordings of the log are passed over. Documents of the others replace what an ended run may have left of them,
    and those that could be read are entered in the log; failed ones aren't, so they are tried again next time.
    Each stage is written before the next and timed; ``clips`` names a folder for the segments' sounds.
    """
    began = time.time()
    settings = settings or Settings()
    waves = files.read_waves(shipped(spark), folder, recursive, decoders)
    todo = checkpointed(files.to_do(waves, finished(spark, output), "rec_id"))
    lengths = todo.where("error IS NULL").select("rec_id", (F.size("wave") * 1000 / F.col("rate")).cast("bigint").alias("duration_ms"))
    seconds = (lengths.agg(F.sum("duration_ms").alias("ms")).first()["ms"] or 0) / 1000
    factors: dict[str, float] = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        start = time.time()
        kept = checkpointed(df)
        factors[name] = (time.time() - start) / seconds if seconds else 0.0
        log.info("%s in %.1f s", name, time.time() - start)
        return kept

    segments = checkpointed(process(todo.where("error IS NULL"), models, replace(settings, sounds=settings.sounds or clips is not None), stage))
    extra = [c for c in ("words", "caption", "demucs", "separated") if c in segments.columns]
    docs = sinks.result_documents(segments, ["index", "s", "e", "speaker", "text", "language", *extra], durations=lengths, stages=factors)
    sinks.write_documents(docs, f"{output}/documents")
    if clips is not None:
        clean = F.col("clean") if "clean" in segments.columns else F.lit(None).cast("array<float>")
        sound = sinks.clip_sound(clean, F.when(F.col("separated"), F.col("sound")), F.col("sound"))
        sinks.write_clips(segments.select("rec_id", sinks.clip_name(F.col("index"), F.col("speaker")).alias("name"), "rate", sound.alias("sound")), clips)
    counts = segments.groupBy(F.col("rec_id").alias("__rec")).agg(F.count("*").alias("segments"))
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("segments").isNull(), "empty").otherwise("done")
    result = todo.join(counts, F.col("rec_id") == F.col("__rec"), "left").select("rec_id", status.alias("status"), F.coalesce("segments", F.lit(0)).alias("segments"))
    files.append_manifest(result.where("status <> 'failed'").select(F.col("rec_id").alias("folder")), f"{output}/done")
    log.info("%d recordings in %.1f s", todo.count(), time.time() - began)
    return result


def plugged(name: str | None) -> Models | None:
    """The ``Models`` at module:attribute, called if it is no such object itself; None for no name."""
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute or "MODELS")
    return found if isinstance(found, Models) else found()


def durations(spark: SparkSession, output: str) -> DataFrame:
    """Rows (rec_id, seconds) of the documents written so far."""
    docs = spark.read.json(f"{output}/documents")
    return docs.groupBy("rec_id").agg(F.max("metadata.audio_duration_seconds").alias("seconds"))


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--recursive", action="store_true")
    p.add_argument("--master", default=None)
    p.add_argument("--chunk-seconds", type=float, default=120)
    p.add_argument("--silence-seconds", type=float, default=0.3)
    p.add_argument("--pad-onset", type=float, default=0)
    p.add_argument("--pad-offset", type=float, default=0)
    p.add_argument("--alike", type=float, default=0.75)
    p.add_argument("--longest-seconds", type=float, default=30)
    p.add_argument("--language", default=None)
    p.add_argument("--models", default=None, help="module:attribute of the models, stand-ins without; several recognizers are voted")
    p.add_argument("--standard-rate", type=int, default=None, help="samples a second to which recordings are brought")
    p.add_argument("--music", action="store_true", help="take music out")
    p.add_argument("--music-above", type=float, default=0.3)
    p.add_argument("--overlap-seconds", type=float, default=None, help="take overlaps of so many seconds apart")
    p.add_argument("--both", action="store_true", help="identify both sources of an overlap")
    p.add_argument("--words", action="store_true", help="time the words")
    p.add_argument("--captions", action="store_true")
    p.add_argument("--context", action="store_true", help="give captions the texts of the two segments before")
    p.add_argument("--korean", action="store_true", help="pronounce Latin phrases of Korean texts")
    p.add_argument("--denoise", action="store_true", help="clean separated sounds")
    p.add_argument("--clips", default=None, help="folder for the sounds of the segments")
    a = p.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    ms = lambda s: round(s * 1000)
    settings = Settings(ms(a.chunk_seconds), ms(a.silence_seconds), ms(a.pad_onset), ms(a.pad_offset), a.alike, ms(a.longest_seconds), language=a.language, standard_rate=a.standard_rate, music=a.music, music_above=a.music_above,
                        overlap_ms=None if a.overlap_seconds is None else ms(a.overlap_seconds), both=a.both, words=a.words, captions=a.captions, context=a.context, korean=a.korean, denoise=a.denoise)
    spark = session(a.master) if a.master else session()
    for r in run(spark, a.input, a.output, plugged(a.models), settings, a.recursive, a.clips).groupBy("status").agg(F.count("*").alias("n")).collect():
        log.info("%s: %d", r["status"], r["n"])


if __name__ == "__main__":
    main()
