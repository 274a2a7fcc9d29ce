"""Queries of the speech-corpus operators over the test tables, and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkseg.functions import text as tx
from sparkseg.functions import vectors as vx
from sparkseg.functions.columns import let, millis
from sparkseg.functions.models import halves, band_embedding, is_music
from sparkseg.operators import enrich, ensemble, folds, overlaps, quality, segments, separation, voices
from sparkseg.operators.ordered import ordered, time_bucket
from sparkseg.plans.pipeline import process, settings_grid
from sparkseg.sources import files, sinks
from sparkseg.session import table

RATE = 64  # samples a second of the vectors that stand in for sound


def _seg(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return segments.segments(table(spark, folder, "seg_result"), *more)


def segment_index(spark, folder):
    return segments.numbered(_seg(spark, folder)).select("rec_id", "seg_id", "index", "s", "e", "speaker")


def chunk_offsets(spark, folder):
    """Times within chunks of two minutes made times of the recording again."""
    local = _seg(spark, folder).withColumn("off", F.floor(F.col("s") / 120_000) * 120_000)
    local = local.withColumn("s", F.col("s") - F.col("off")).withColumn("e", F.col("e") - F.col("off")).withColumn("__s", F.col("s"))
    back = segments.shifted(local, "off")
    return back.select("rec_id", "seg_id", "s", "e", (F.col("off") / 120_000).cast("bigint").alias("chunk"), F.col("__s").alias("within"))


def pad_boundaries(spark, folder):
    seg = _seg(spark, folder)
    last = seg.groupBy(F.col("rec_id").alias("__rec")).agg(F.max("e").alias("duration_ms"))
    joined = seg.join(last, F.col("rec_id").eqNullSafe(F.col("__rec")))
    return segments.padded(joined, -250, 400, "duration_ms").select("rec_id", "seg_id", "s", "e")


def split_long(spark, folder):
    return segments.split_long(_seg(spark, folder)).select("rec_id", "seg_id", F.col("piece").cast("bigint").alias("piece"), "index", "s", "e")


def denest_running_max(spark, folder):
    return segments.denested(_seg(spark, folder)).select("rec_id", "seg_id", "s", "e")


def silence_gaps(spark, folder):
    seg = _seg(spark, folder)
    durations = seg.groupBy("rec_id").agg((F.max("e") + 1000).alias("duration_ms"))
    return segments.silence_gaps(seg, 300, durations)


def overlap_pairs(spark, folder):
    return overlaps.overlap_pairs(_seg(spark, folder), 200)


def reference_segments(spark, folder):
    return overlaps.reference_segments(_seg(spark, folder))


def cut_by_speaker(spark, folder):
    return folds.cut_by_speaker(_seg(spark, folder))


def chunk_ranges(spark, folder):
    seg = _seg(spark, folder)
    durations = seg.groupBy("rec_id").agg(F.max("e").alias("duration_ms"))
    return folds.chunk_ranges(segments.silence_gaps(seg), durations)


def max_gap_split(spark, folder):
    """Long segments parted at the widest gaps between their words; those without words hide what is nested in them, but have no row."""
    words = F.transform("words", lambda w: F.struct(millis(w["start"]).alias("s"), millis(w["end"]).alias("e")))
    seg = _seg(spark, folder, "words").withColumn("stamps", words)
    return folds.max_gap_split(seg.drop("words", "stamps"), seg.where("stamps IS NOT NULL").select("seg_id", "stamps")).withColumn("part", F.col("part").cast("bigint"))


def dedup_by_index(spark, folder):
    return segments.first_by_index(_seg(spark, folder, "index")).select("rec_id", "seg_id", "index")


def word_times(spark, folder):
    seg = _seg(spark, folder, "words").where("size(words) > 0")
    shifted = seg.select("seg_id", F.posexplode(segments.word_times(F.col("words"), F.col("s") / 1000)).alias("i", "w"))
    return shifted.select("seg_id", F.col("i").cast("bigint").alias("i"), "w.word", millis("w.start").alias("start_ms"), millis("w.end").alias("end_ms"))


def caption_context(spark, folder):
    rows = segments.caption_context(_seg(spark, folder, "text"))
    return rows.select("rec_id", "seg_id", F.size("context").cast("bigint").alias("n"), F.array_join("context", "|", "").alias("context"))


def speaker_tags(spark, folder):
    return segments.speaker_tags(_seg(spark, folder, "text"))


def tagged_text(spark, folder):
    return segments.tagged_text(_seg(spark, folder, "text"))


def relabel(spark, folder):
    mapping = table(spark, folder, "speaker_alias").select("rec_id", "speaker", F.col("alias").alias("label"))
    return segments.relabelled(_seg(spark, folder), mapping).select("rec_id", "seg_id", "speaker", "label")


def char_count(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.char_count("text").alias("chars"))


def display_times(spark, folder):
    return _seg(spark, folder).select("seg_id", tx.display_range("s", "e").alias("shown"), tx.srt_time("s").alias("srt"))


def srt_parts(spark, folder):
    return sinks.subtitles(_seg(spark, folder, "text"))


def repetition_filter(spark, folder):
    return quality.kept_by_repetition(table(spark, folder, "documents"), "doc_id")


def repetition_filter_segments(spark, folder):
    return quality.kept_by_repetition(_seg(spark, folder, "text"), "seg_id")


def iqr_filter(spark, folder):
    rows = quality.valid_audio(_seg(spark, folder, "text"), (F.col("e") - F.col("s")) / 1000)
    return rows.select("seg_id", "chars", (F.col("e") - F.col("s")).alias("ms"))


def jaccard_trust(spark, folder):
    """Mean similarity of each transcript to the other two."""
    seg = _seg(spark, folder, "text_whisper", "text_canary", "text_parakeet")
    w = seg.select("seg_id", *[tx.tokens(F.coalesce(c, F.lit(""))).alias(a) for a, c in (("a", "text_whisper"), ("b", "text_canary"), ("c", "text_parakeet"))])
    ab, ac, bc = (tx.jaccard(F.col(x), F.col(y)) for x, y in ("ab", "ac", "bc"))
    return w.select("seg_id", ab.alias("ab"), ac.alias("ac"), bc.alias("bc")).select("seg_id", ((F.col("ab") + F.col("ac")) / 2).alias("whisper"), ((F.col("ab") + F.col("bc")) / 2).alias("canary"), ((F.col("ac") + F.col("bc")) / 2).alias("parakeet"))


def _hypotheses(spark, folder):
    return _seg(spark, folder, "text_whisper", "text_canary", "text_parakeet").select("seg_id", F.array("text_whisper", "text_canary", "text_parakeet").alias("h"))


def rover_slots(spark, folder):
    return _hypotheses(spark, folder).select("seg_id", ensemble.rover(F.col("h")).alias("voted"))


def rover_first(spark, folder):
    return _hypotheses(spark, folder).select("seg_id", ensemble.rover(F.col("h"), by_first=True).alias("voted"))


def trusted_transcripts(spark, folder):
    """Which of the transcripts are alike enough to the others to vote, or the two most alike."""
    @F.pandas_udf("string")
    def chosen(h: pd.Series) -> pd.Series:
        return h.map(lambda ts: ",".join(map(str, sorted(ensemble.trusted([(t or "").split() for t in ts])))))

    return _hypotheses(spark, folder).select("seg_id", chosen("h").alias("trusted"))


def majority_language(spark, folder):
    """The most frequent language label of each recording, of equals the first seen."""
    seg = _seg(spark, folder, "language").where("language IS NOT NULL")
    per = seg.groupBy("rec_id", "language").agg(F.count("*").alias("n"), F.min(F.struct("s", "e", "seg_id")).alias("place"))
    rank = F.struct(-F.col("n"), "place")
    return per.groupBy("rec_id").agg(F.min_by("language", rank).alias("language"), F.max("n").alias("n"))


def _lines(spark, folder):
    """Segments as lines of a diarizer."""
    seg = segments.numbered(_seg(spark, folder)).where("speaker RLIKE '^SPEAKER_[0-9]+$'")
    seconds = lambda c: F.concat(F.floor(F.col(c) / 1000).cast("string"), F.lit("."), F.format_string("%03d", F.col(c) % 1000))
    return seg.select("rec_id", "seg_id", F.col("index").cast("int").alias("place"), F.concat_ws(" ", seconds("s"), seconds("e"), F.concat(F.lit("speaker_"), F.regexp_extract("speaker", "([0-9]+)", 1).cast("int").cast("string"))).alias("line"))


def diarization_lines(spark, folder):
    rows = files.diarization_rows(_lines(spark, folder).withColumn("place", F.pmod("place", F.lit(26))))
    return rows.select("rec_id", "seg_id", "segment", "label", "speaker", "s", "e")


def json_arrays(spark, folder):
    """Arrays in text as a model hands it over, from the events' properties."""
    raw = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("Here: ["), "props", F.lit("] done"))).when(F.col("event_id") % 4 == 1, F.concat(F.lit("["), "props", F.lit(",")) ).when(F.col("event_id") % 4 == 2, F.lit("no array")).alias("raw"))
    found = files.json_array("raw", "array<struct<k:bigint>>")
    return raw.select("event_id", found.isNotNull().alias("parsed"), found[0]["k"].alias("k"))


def json_blocks(spark, folder):
    kind = F.col("event_id") % 4
    raw = table(spark, folder, "events").select("event_id", F.when(kind == 0, F.concat(F.lit("```json\n["), "props", F.lit("]\n```"))).when(kind == 1, F.concat(F.lit("["), F.translate("props", '"', "'"), F.lit("]"))).when(kind == 2, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.lit("junk")).alias("raw"))
    found = files.json_block("raw", "array<struct<k:bigint>>")
    return raw.select("event_id", F.size(found).cast("bigint").alias("n"), F.get(found, F.lit(0))["k"].alias("k"))


def audio_listing(spark, folder):
    return files.audio_files(table(spark, folder, "audio_file"), least_bytes=files.LEAST_BYTES).select("path", "length")


def audio_folders(spark, folder):
    return files.folders_with(table(spark, folder, "audio_file"))


def cache_names(spark, folder):
    return files.cache_names(files.audio_files(table(spark, folder, "audio_file"))).select("path", "cached")


def decode_todo(spark, folder):
    """Files yet to be decoded when those of even numbers are."""
    names = files.cache_names(files.audio_files(table(spark, folder, "audio_file")))
    return files.decode_todo(names, names.where("path RLIKE '[02468][.][^.]*$'")).select("path", "cached")


def decoded_paths(spark, folder):
    names = files.cache_names(files.audio_files(table(spark, folder, "audio_file")))
    made = names.where("path RLIKE '[02468][.][^.]*$' AND cached IS NOT NULL").select("cached", F.concat(F.lit("/cache/"), "cached").alias("decoded"))
    return files.decoded_paths(names, made).select("path", "read")


def resume_todo(spark, folder):
    """Recordings of the listing without segments."""
    listed = table(spark, folder, "audio_file").where("rec_id IS NOT NULL").select("rec_id").distinct()
    return files.to_do(listed, table(spark, folder, "seg_result"), "rec_id")


def progress_running(spark, folder):
    """Files, bytes and per cent done so far, in order of time."""
    kept = files.audio_files(table(spark, folder, "audio_file")).where("modificationtime IS NOT NULL AND length IS NOT NULL")
    us = kept.withColumn("ms", F.floor(F.unix_micros(F.col("modificationtime").cast("timestamp")) / 1000))
    total = kept.agg(F.count("*").alias("total"))
    # sums run within an hour and are carried from hour to hour
    day = F.floor(F.col("ms") / 3_600_000)
    rows = ordered(us, [], day, ["ms", "path"], number="i")
    local = Window.partitionBy("d").orderBy("ms", "path").rowsBetween(Window.unboundedPreceding, 0)
    per = us.groupBy(day.alias("__d")).agg(F.sum("length").alias("sum")).withColumn("__before", F.coalesce(F.sum("sum").over(Window.orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    summed = rows.withColumn("d", day).withColumn("own", F.sum("length").over(local)).join(per.select("__d", "__before"), F.col("d") == F.col("__d"))
    return summed.crossJoin(F.broadcast(total)).select("path", (F.col("i") + 1).alias("files"), (F.col("own") + F.col("__before")).alias("bytes"), (100.0 * (F.col("i") + 1) / F.col("total")).alias("percent"))


def recording_metadata(spark, folder):
    about = sinks.recording_metadata(_seg(spark, folder))
    return about.withColumn("rt", tx.real_time_factor(F.col("total_segments") * 0.5, "audio_duration_seconds"))


def result_documents(spark, folder):
    return sinks.result_documents(_seg(spark, folder, "text"), ["seg_id", "s", "e", "speaker", "text"])


def result_document_sizes(spark, folder):
    docs = sinks.result_documents(_seg(spark, folder, "text"), ["seg_id", "s", "e", "speaker", "text"])
    return docs.select("rec_id", "part", F.size("segments").cast("bigint").alias("n"), F.col("segments")[0]["seg_id"].alias("first"), F.col("metadata.total_segments").alias("total_segments"))


def result_document_rows(spark, folder):
    """What the documents hold, a row for each of their segments."""
    docs = sinks.result_documents(_seg(spark, folder, "text"), ["seg_id", "s", "e", "speaker", "text"], size=100)
    rows = docs.select("rec_id", "part", "metadata.audio_duration_seconds", F.posexplode("segments").alias("place", "x"))
    return rows.select("rec_id", "part", F.col("place").cast("bigint").alias("place"), "x.seg_id", "x.s", "x.e", "x.speaker", "x.text", F.round("audio_duration_seconds", 3).alias("seconds"))


def clip_names(spark, folder):
    rows = segments.numbered(_seg(spark, folder))
    return rows.select("seg_id", sinks.clip_name(F.col("index"), F.col("speaker"), "mp3").alias("name"))


def separated_flags(spark, folder):
    """Segments by what was done to their sound; a missing flag is false."""
    seg = _seg(spark, folder, "demucs", "is_separated", "sepreformer", "text")
    no = lambda c: F.coalesce(c, F.lit(False))
    denoise = no("sepreformer") & no("is_separated") & tx.has_text("text")
    return seg.groupBy("rec_id").agg(F.count_if(no("demucs")).alias("demucs"), F.count_if(no("is_separated")).alias("separated"), F.count_if(denoise).alias("denoise"), F.sum(F.col("e") - F.col("s")).alias("ms"))


def cosine_neighbours(spark, folder):
    """Each vector against the next by number."""
    v = table(spark, folder, "embeddings").select("vec_id", "embedding")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(other, "vec_id").select("vec_id", F.round(vx.cosine("embedding", "other"), 6).alias("cosine"))


def _voices(spark, folder):
    return table(spark, folder, "embeddings").select(F.lit("rec").alias("rec_id"), F.floor(F.col("vec_id") / 50).alias("chunk"), F.col("vec_id").alias("place"), F.concat(F.lit("speaker_"), F.col("label").cast("string")).alias("speaker"), "embedding")


def centroids(spark, folder):
    made = voices.centroids(_voices(spark, folder), ["chunk", "speaker"], ["place"])
    return made.select("chunk", "speaker", F.posexplode("centroid").alias("i", "x"), "used").select("chunk", "speaker", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"), "used")


def nearest_speaker(spark, folder):
    """Which of the first two vectors each vector is nearer to."""
    v = table(spark, folder, "embeddings").select("vec_id", "embedding")
    two = v.where("vec_id < 2").agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("two"))
    pair = F.transform("two", lambda x: F.struct(F.concat(F.lit("v"), x["vec_id"].cast("string")).alias("label"), x["embedding"].alias("vector")))
    return v.crossJoin(F.broadcast(two.select(pair.alias("pair")))).select("vec_id", voices.nearest("embedding", "pair").alias("label"))


def link_speakers(spark, folder):
    """Speakers of chunks linked; the vectors aren't grouped by label, so the limit is low."""
    rows = _voices(spark, folder)
    made = voices.centroids(rows, ["rec_id", "chunk", "speaker"], ["place"])
    first = rows.groupBy("rec_id", "chunk", "speaker").agg(F.min("place").alias("place"))
    linked = voices.link_speakers(first.join(made, ["rec_id", "chunk", "speaker"]).drop("used"), alike=0.1)
    return linked.withColumn("similarity", F.round("similarity", 6))


def sound_levels(spark, folder):
    v = table(spark, folder, "embeddings")
    return v.select("vec_id", F.round(vx.rms("embedding"), 6).alias("rms"), F.round(vx.energy("embedding"), 6).alias("energy"), F.round(vx.peak("embedding"), 6).alias("peak"))


def gain(spark, folder):
    level = let(vx.rms("embedding"), lambda r: F.when(r > 0, 20 * F.log10(r)))
    return table(spark, folder, "embeddings").select("vec_id", F.round(vx.gain_db(level), 6).alias("db"))


def matched_level(spark, folder):
    """Sounds brought to half their peak's level and cut to the first half second."""
    v = table(spark, folder, "embeddings").select("vec_id", vx.samples(vx.amplitude_matched("embedding", F.lit(0.5)), F.lit(0), F.lit(500), RATE).alias("w"))
    return v.select("vec_id", F.size("w").cast("bigint").alias("n"), F.round(vx.rms("w"), 5).alias("rms"))


def mos_scores(spark, folder):
    q = F.col("l_quantity") / 10
    rows = table(spark, folder, "lineitem").select("l_orderkey", q.alias("sig"), (q * 0.9).alias("bak"), (q * 0.8).alias("ovr"))
    made = quality.mean_scores(rows, ["l_orderkey"])
    return made.select("l_orderkey", "num_hops", *[F.round(c, 6).alias(name) for c, name in (("OVRL_raw", "ovr_raw"), ("SIG_raw", "sig_raw"), ("BAK_raw", "bak_raw"), ("OVRL", "ovr"), ("SIG", "sig"), ("BAK", "bak"))])


def hop_windows(spark, folder):
    seg = _seg(spark, folder).select("seg_id", vx.hop_starts(F.col("e") - F.col("s")).alias("w"))
    return seg.select("seg_id", F.size("w").cast("bigint").alias("n"), F.array_max("w").alias("last"))


def music_flags(spark, folder):
    """Of events taken for probabilities of music; one in seven has none."""
    v = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("value") / 100).alias("p"))
    return v.select("event_id", is_music("p").alias("music"))


def latin_phrases(spark, folder):
    docs = table(spark, folder, "documents").where("lang = 'ko'")
    found = tx.latin_phrases("text")
    return docs.select("doc_id", F.size(found).cast("bigint").alias("n"), F.array_join(found, "|").alias("phrases"))


def pronounced(spark, folder):
    """Latin phrases of Korean texts replaced by a stand-in pronunciation; texts without a label are Korean if they have a Hangul letter."""
    docs = table(spark, folder, "documents").where(r"lang = 'ko' OR (lang IS NULL AND text RLIKE '[ᄀ-ᇿ㄰-㆏가-힣]')")
    return docs.select("doc_id", tx.pronounced("text", lambda p: "<" + p.lower() + ">").alias("text"))


def safe_names(spark, folder):
    return table(spark, folder, "audio_file").where("path IS NOT NULL").select("path", tx.safe_name(tx.stem("path")).alias("name")).distinct()


def last_lines(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.last_line("text").alias("line"))


def settings_sweep(spark, folder):
    return settings_grid(spark, voted=["on", "off"], music=["on", "off"], parted=["on", "off"], threshold=["0.5", "1.0", "1.5"])


def _sounds(spark, folder):
    """Vectors as sounds of ten seconds: each sample held for a while."""
    return table(spark, folder, "embeddings").select(F.concat(F.lit("rec_"), F.col("vec_id").cast("string")).alias("rec_id"), F.lit(RATE * 10).cast("bigint").alias("rate"), F.flatten(F.transform("embedding", lambda x: F.array_repeat(x.cast("float"), 100))).alias("wave"))


def overlap_repair(spark, folder):
    spans = F.expr("array(named_struct('seg_id', 1L, 's', 0L, 'e', 5000L, 'speaker', 'SPEAKER_00'), named_struct('seg_id', 2L, 's', 3500L, 'e', 7000L, 'speaker', 'SPEAKER_01'), named_struct('seg_id', 3L, 's', 7000L, 'e', 10000L, 'speaker', 'SPEAKER_00'))")
    made = separation.repair_overlaps(_sounds(spark, folder).withColumn("spans", spans), halves, band_embedding)
    return made.select("rec_id", "seg_id", "separated", F.size("sound").cast("bigint").alias("n"))


def pipeline_segments(spark, folder):
    """The whole pipeline over stand-in sounds with stand-in models."""
    return process(_sounds(spark, folder)).select("rec_id", "index", "s", "e", "speaker", "text")


def standard_sounds(spark, folder):
    made = enrich.standard_sounds(_sounds(spark, folder), RATE * 5)
    return made.select("rec_id", F.size("standard.wave").cast("bigint").alias("n"), F.round("standard.gain_db", 3).alias("gain_db"))


def window_scores(spark, folder):
    """Scores of sounds by a stand-in model: level, peak and their mean."""
    sounds = _sounds(spark, folder).withColumnRenamed("wave", "sound")
    made = enrich.scored(sounds, lambda: (lambda w, r: (float(abs(w).mean()), float(abs(w).max()), 1.0)))
    return made.select("rec_id", F.col("score.num_hops").cast("bigint").alias("num_hops"), F.round("score.sig_raw", 6).alias("sig_raw"), F.round("score.ovr", 6).alias("ovr"))


QUERIES = {f.__name__: f for f in (
    segment_index, chunk_offsets, pad_boundaries, split_long, denest_running_max, silence_gaps, overlap_pairs, reference_segments, cut_by_speaker, chunk_ranges, max_gap_split, dedup_by_index, word_times,
    caption_context, speaker_tags, tagged_text, relabel, char_count, display_times, srt_parts, repetition_filter, repetition_filter_segments, iqr_filter, jaccard_trust, trusted_transcripts, rover_slots, rover_first, majority_language,
    diarization_lines, json_arrays, json_blocks, audio_listing, audio_folders, cache_names, decode_todo, decoded_paths, resume_todo, progress_running, recording_metadata, result_documents, result_document_sizes, result_document_rows,
    clip_names, separated_flags, cosine_neighbours, centroids, nearest_speaker, link_speakers, sound_levels, gain, matched_level, mos_scores, hop_windows, music_flags, latin_phrases, pronounced, safe_names, last_lines,
    settings_sweep, overlap_repair, pipeline_segments, standard_sounds, window_scores,
)}
