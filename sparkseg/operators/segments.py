"""Segments as rows (rec_id, seg_id, s, e, speaker, ...): times in whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseg.functions.columns import millis
from sparkseg.operators.ordered import BUCKET_MS, ordered, time_bucket
from sparkseg.operators.skew import salted_left_join

ORDER = ["s", "e", "seg_id"]


def segments(raw: DataFrame, *more: str) -> DataFrame:
    """Rows (rec_id, seg_id, s, e, speaker, more) of the segments with valid times.

    Redelivered rows count once, as first delivered; of rows delivered at one time, the one
    of the least speaker label. Rows with a null seg_id are one segment. An empty table gives an
    empty table; further columns are dropped.
    """
    columns = ["rec_id", millis("`start`").alias("s"), millis("`end`").alias("e"), "speaker", *more]
    kept = raw.select("seg_id", *columns, "ingested_at").where("e > s")
    first = kept.groupBy("seg_id").agg(F.min_by(F.struct("rec_id", "s", "e", "speaker", *more), F.struct("ingested_at", "speaker")).alias("r"))
    return first.select("r.rec_id", "seg_id", *[f"r.{c}" for c in ("s", "e", "speaker", *more)])


def index_text(number: Column) -> Column:
    """Number of a segment as five digits, more from 100 000 on."""
    return F.format_string("%05d", number)


def numbered(df: DataFrame, name: str = "index", bucket_ms: int = BUCKET_MS) -> DataFrame:
    """``df`` with the segments of a recording numbered in order from 00000."""
    rows = ordered(df, ["rec_id"], time_bucket("s", bucket_ms), ORDER, number="__number")
    return rows.withColumn(name, index_text(F.col("__number"))).drop("__number")


def shifted(df: DataFrame, offset_ms: Column | str) -> DataFrame:
    """Times of a chunk made times of its recording."""
    by = F.col(offset_ms) if isinstance(offset_ms, str) else offset_ms
    return df.withColumn("s", F.col("s") + by).withColumn("e", F.col("e") + by)


def padded(df: DataFrame, onset_ms: int, offset_ms: int, duration_ms: str | None = None) -> DataFrame:
    """Starts moved by ``onset_ms`` to 0 at least, ends by ``offset_ms`` into the recording, never before the start.

    Nothing changes if both are 0. Without a duration, or with one of 0 or null, ends are only
    kept from falling below 0.
    """
    if not onset_ms and not offset_ms:
        return df
    start = F.greatest(F.col("s") + onset_ms, F.lit(0))
    end = F.greatest(F.col("e") + offset_ms, F.lit(0))
    if duration_ms:
        end = F.when(F.col(duration_ms) > 0, F.least(end, F.col(duration_ms))).otherwise(end)
    return df.withColumn("s", start).withColumn("e", F.greatest("s", end))


def split_long(df: DataFrame, limit_ms: int = 30_000) -> DataFrame:
    """Segments longer than ``limit_ms`` cut every ``limit_ms``, all numbered anew.

    One of exactly the limit stays whole. Pieces keep the segment's columns and get ``piece``.
    """
    count = F.greatest(F.ceil((F.col("e") - F.col("s")) / limit_ms), F.lit(1))
    parts = df.withColumn("piece", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    start = F.col("s") + F.col("piece") * limit_ms
    cut = parts.withColumn("__s", start).withColumn("e", F.least(F.col("e"), start + limit_ms)).withColumn("s", F.col("__s")).drop("__s")
    rows = ordered(cut, ["rec_id"], time_bucket("s"), [*ORDER, "piece"], number="__number")
    return rows.withColumn("index", index_text(F.col("__number"))).drop("__number")


def denested(df: DataFrame) -> DataFrame:
    """Segments that end later than every earlier one; numbers follow from ``numbered``.

    A skipped segment never ends later than the kept ones, so the running maximum of all
    earlier ends decides exactly. Ends of 0 and less are skipped.
    """
    rows = ordered(df, ["rec_id"], time_bucket("s"), ORDER, running_max={"__reach": F.col("e")})
    return rows.where(F.col("e") > F.greatest(F.coalesce("__reach", F.lit(0)), F.lit(0))).drop("__reach")


def silence_gaps(df: DataFrame, least_ms: int = 300, durations: DataFrame | None = None) -> DataFrame:
    """Rows (rec_id, start_ms, end_ms): silences of at least ``least_ms`` around the de-nested segments.

    The stretch before the first counts from 0; given ``durations`` (rec_id, duration_ms), so
    does the one behind the last, and a recording without segments is one silence.
    """
    kept = denested(df)
    rows = ordered(kept, ["rec_id"], time_bucket("s"), ORDER, lag={"__end": F.col("e")}, lead={"__next": F.struct("s")})
    gap = rows.select("rec_id", F.coalesce("__end", F.lit(0)).alias("start_ms"), F.col("s").alias("end_ms"))
    if durations is not None:
        ends = df.groupBy("rec_id").agg(F.max("e").alias("start_ms")).withColumnRenamed("rec_id", "__rec")
        all_ = durations.join(ends, F.col("rec_id").eqNullSafe(F.col("__rec")), "left")
        gap = gap.unionByName(all_.select("rec_id", F.coalesce("start_ms", F.lit(0)).alias("start_ms"), F.col("duration_ms").alias("end_ms")))
    return gap.where(F.col("end_ms") - F.col("start_ms") >= least_ms)


def first_by_index(df: DataFrame, index: str = "index", order: tuple[str, ...] = ("s", "e", "seg_id")) -> DataFrame:
    """The first segment of each index of a recording; segments with a null index all stay."""
    keyed = df.where(F.col(index).isNotNull())
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = keyed.groupBy("rec_id", index).agg(F.min_by(row, F.struct(*order)).alias("__r")).select("__r.*")
    return first.unionByName(df.where(F.col(index).isNull()).select(*[F.col(f"`{c}`") for c in df.columns]))


def word_times(words: Column, offset: Column) -> Column:
    """Words with their times counted from the recording's start; null stays null."""
    return F.transform(words, lambda w: F.struct(w["word"].alias("word"), (w["start"] + offset).alias("start"), (w["end"] + offset).alias("end")))


def caption_context(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``context``: the texts of up to two segments before, oldest first."""
    rows = ordered(df, ["rec_id"], time_bucket("s"), ORDER, lag={"__one": F.struct(F.col(text).alias("t"))})
    # the row before the row before, by the same means
    rows = ordered(rows, ["rec_id"], time_bucket("s"), ORDER, lag={"__two": F.col("__one")})
    context = F.transform(F.filter(F.array("__two", "__one"), lambda x: x.isNotNull()), lambda x: x["t"])
    return rows.withColumn("context", context).drop("__one", "__two")


def tag_ranks(df: DataFrame) -> DataFrame:
    """Rows (rec_id, speaker, tag): speakers of a recording numbered from 0 by first appearance."""
    first = df.where("speaker IS NOT NULL").groupBy("rec_id", "speaker").agg(F.min(F.struct(*ORDER)).alias("place"))
    return first.select("rec_id", "speaker", (F.row_number().over(Window.partitionBy("rec_id").orderBy("place", "speaker")) - 1).cast("bigint").alias("tag"))


def speaker_tags(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows (rec_id, seg_id, s, e, text): each text behind the tag [s0], [s1], ... of its speaker.

    Segments without a speaker are left out. Tags are few per recording and joined with salted rows.
    """
    tags = tag_ranks(df).withColumnsRenamed({"rec_id": "__rec", "speaker": "__who"})
    tagged = salted_left_join(df.where("speaker IS NOT NULL"), tags, {"rec_id": "__rec", "speaker": "__who"})
    return tagged.select("rec_id", "seg_id", "s", "e", F.concat(F.lit("[s"), F.col("tag").cast("string"), F.lit("]"), F.coalesce(text, F.lit(""))).alias("text"))


def tagged_text(df: DataFrame, text: str = "text", bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows (rec_id, part, text): lines "[speaker]: text" in order, one part per time bucket.

    A missing speaker is Unknown, a missing text empty. Parts keep the text of one row bounded.
    """
    line = F.concat(F.lit("["), F.coalesce("speaker", F.lit("Unknown")), F.lit("]: "), F.coalesce(text, F.lit("")))
    rows = df.withColumn("part", time_bucket("s", bucket_ms)).groupBy("rec_id", "part").agg(F.sort_array(F.collect_list(F.struct(*ORDER, line.alias("line")))).alias("lines"))
    return rows.select("rec_id", "part", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))


def relabelled(df: DataFrame, mapping: DataFrame, new: str = "label") -> DataFrame:
    """``df`` with ``new``: the mapping's (rec_id, speaker, label) of its speaker, null if it has none."""
    unique = mapping.where("rec_id IS NOT NULL AND speaker IS NOT NULL").groupBy(F.col("rec_id").alias("__rec"), F.col("speaker").alias("__who")).agg(F.min("label").alias("__label"))
    return salted_left_join(df, unique, {"rec_id": "__rec", "speaker": "__who"}).withColumn(new, F.col("__label")).drop("__rec", "__who", "__label")
