"""Clean speaker turns from segments with messy labels and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseg.functions.columns import millis
from sparkseg.functions.speakers import label_key, speaker_name, speaker_number
from sparkseg.llm.rosters import assign_labels
from sparkseg.llm.spoken import beginning, clean, has_words, leading_name, speech, with_speech
from sparkseg.operators.skew import salted_left_join
from sparkseg.session import checkpointed

#: Length of the time buckets into which a recording is split.
BUCKET_MS = 3_600_000


def spoken_segments(df: DataFrame, alias: DataFrame, texts: bool = True) -> DataFrame:
    """Segments with valid times, a speaker and spoken words.

    ``df`` has seg_id, rec_id, start, end, speaker, text, ingested_at. Out come seg_id,
    rec_id, s, e (ms), ingested_at, who, speech, which is null unless ``texts``. The speaker is that of ``speaker``
    or, if it names none, of the label at the beginning of ``text``: by number, else by the names of the
    recording and the rosters of all transcripts. Rows with a null in a needed column have no speaker,
    time or words and are left out.

    Texts are read once: what they give is written to the shared folder, without the texts unless they are asked for,
    and both the labels and the segments come from there.
    """
    timed = df.select("seg_id", "rec_id", millis("`start`").alias("s"), millis("`end`").alias("e"), "speaker", "text", "ingested_at").where("e > s AND rec_id IS NOT NULL AND text IS NOT NULL")
    wordy = (
        with_speech(timed)
        .withColumn("number", speaker_number("speaker"))
        .withColumn("label", F.when(F.col("number").isNull(), label_key("speaker")))
        .withColumn("words", has_words(F.col("body")))
        .withColumn("words_named", F.when(F.col("lead_name").isNotNull(), has_words(F.col("body_named"))).otherwise(F.col("words")))
        .where("words")  # what a label leaves has no more words
        .drop("speaker", "text", "words")
    )
    read = checkpointed(wordy if texts else wordy.drop("body", "body_named"))
    keys = read.select("rec_id", F.explode(F.array("label", "lead_name")).alias("label"))
    who = checkpointed(assign_labels(keys, alias))  # read for both labels
    by_label = who.withColumnsRenamed({"rec_id": "r1", "label": "l1", "who": "w1"})
    by_lead = who.withColumnsRenamed({"rec_id": "r2", "label": "l2", "who": "w2"})
    joined = salted_left_join(salted_left_join(read, by_label, {"rec_id": "r1", "label": "l1"}, written=True), by_lead, {"rec_id": "r2", "lead_name": "l2"}, written=True)
    named = F.col("w2").isNotNull()
    kept = joined.where(~named | F.col("words_named")).withColumn("who", F.coalesce(speaker_name("number"), F.col("w1"), speaker_name("lead_number"), F.col("w2"))).where("who IS NOT NULL")
    said = clean(speech(F.when(named, F.col("body_named")).otherwise(F.col("body")))) if texts else F.lit(None).cast("string")
    return kept.select("seg_id", "rec_id", "s", "e", "ingested_at", "who", said.alias("speech"))


def turn_parts(segments: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows (rec_id, turn, part, who, s, e, segments): the part of each turn within a time bucket.

    ``segments`` as ``spoken_segments`` gives them. Rows are ordered by start, end and
    seg_id; equal seg_ids with equal times are one segment, the first delivered; null seg_ids
    come first and stay apart. ``turn`` is the (start bucket, number) of the turn's first part.

    Order is settled within a bucket of a recording, so a recording of any length is spread
    over many tasks; a row per bucket carries the last speaker and the last turn forward.
    """
    group = ["rec_id", "b"]
    order = Window.partitionBy(*group).orderBy(F.col("s"), F.col("e"), F.col("seg_id"), F.col("ingested_at").asc_nulls_last(), F.col("who"))
    marked = (
        segments.withColumn("b", F.floor(F.col("s") / bucket_ms))
        .withColumn("again", F.coalesce((F.lag("seg_id").over(order) == F.col("seg_id")) & (F.lag("s").over(order) == F.col("s")) & (F.lag("e").over(order) == F.col("e")), F.lit(False)))
        .withColumn("change", F.coalesce(F.lag("who").over(order) != F.col("who"), F.lit(True)).cast("int"))
        .withColumn("isle", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where("NOT again")
    )
    isles = marked.groupBy(*group, "isle").agg(F.first("who").alias("who"), F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("segments"), F.sort_array(F.collect_list(F.struct("s", "e", "seg_id", "speech"))).alias("said"))
    across = Window.partitionBy("rec_id").orderBy("b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = isles.groupBy(*group).agg(F.min_by("who", "isle").alias("first_who"), F.min("isle").alias("first_isle"), F.max("isle").alias("last_isle"), F.max_by("who", "isle").alias("last_who"))
    follows = F.coalesce(F.lag("last_who").over(across) == F.col("first_who"), F.lit(False))
    opened = F.when(~F.col("follows") | (F.col("last_isle") > F.col("first_isle")), F.struct("b", F.col("last_isle").alias("n")))
    carried = (
        edges.withColumn("follows", follows)
        .withColumn("open", F.last(opened, True).over(before))
        .select(F.col("rec_id").alias("r"), F.col("b").alias("bb"), "first_isle", "follows", "open")
    )
    joined = isles.join(carried, (F.col("rec_id") == F.col("r")) & (F.col("b") == F.col("bb")))
    own = F.struct("b", F.col("isle").alias("n"))
    return joined.withColumn("turn", F.when(F.col("follows") & (F.col("isle") == F.col("first_isle")), F.col("open")).otherwise(own)).select("rec_id", "turn", F.col("b").alias("part"), "who", "s", "e", "segments", "said")


def turns(segments: DataFrame) -> DataFrame:
    """Rows (rec_id, speaker, start_ms, end_ms) of each turn."""
    whole = turn_parts(segments).groupBy("rec_id", "turn").agg(F.first("who").alias("speaker"), F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))
    return whole.select("rec_id", "speaker", "start_ms", "end_ms")


def turn_texts(segments: DataFrame) -> DataFrame:
    """Rows (rec_id, turn_ms, part, speaker, start_ms, end_ms, segments, text) in order of turn and part.

    A turn that runs through several time buckets has one part, of bounded length, in each.
    """
    parts = turn_parts(segments)
    text = F.array_join(F.transform("said", lambda x: x["speech"]), " ")
    numbered = Window.partitionBy("rec_id", "turn").orderBy("part")
    return parts.select(
        "rec_id", F.min("s").over(Window.partitionBy("rec_id", "turn")).alias("turn_ms"), F.row_number().over(numbered).alias("part"),
        F.col("who").alias("speaker"), F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), "segments", text.alias("text"),
    )
