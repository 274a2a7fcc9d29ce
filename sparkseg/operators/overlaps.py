"""Pairs of segments that overlap in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Length of the time buckets of the join.
BUCKET_MS = 60_000


def overlap_pairs(df: DataFrame, least_ms: int = 1000, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows (rec_id, seg1, seg2, overlap_start, overlap_end, overlap_ms) of each pair of a recording.

    ``df`` has rec_id, seg_id, s, e. seg1 is the earlier by start, end and seg_id. Pairs that
    share at least ``least_ms`` (and more than nothing) count, those of one speaker too. Null
    recordings and times without length are left out.

    An interval join by buckets of time: a segment lies in each bucket that it touches, a pair is
    kept in the bucket where its overlap begins. A recording of any length is spread over its
    buckets, and no pair is looked at that shares no bucket.
    """
    spans = df.where("rec_id IS NOT NULL AND e > s").select("rec_id", "seg_id", "s", "e", F.explode(F.sequence(F.floor(F.col("s") / bucket_ms), F.floor((F.col("e") - 1) / bucket_ms))).alias("b"))
    a, b = spans.alias("a"), spans.alias("b")
    start, end = F.greatest("a.s", "b.s"), F.least("a.e", "b.e")
    earlier = F.struct("a.s", "a.e", "a.seg_id") < F.struct("b.s", "b.e", "b.seg_id")
    joined = a.join(b, (F.col("a.rec_id") == F.col("b.rec_id")) & (F.col("a.b") == F.col("b.b")) & earlier & (end - start >= max(1, least_ms)) & (F.floor(start / bucket_ms) == F.col("a.b")))
    return joined.select(F.col("a.rec_id").alias("rec_id"), F.col("a.seg_id").alias("seg1"), F.col("b.seg_id").alias("seg2"), start.alias("overlap_start"), end.alias("overlap_end"), (end - start).alias("overlap_ms"))


def reference_segments(df: DataFrame, least_overlap_ms: int = 1000, least_ms: int = 2000) -> DataFrame:
    """Rows (rec_id, speaker, seg_id): the first segment of each speaker of at least ``least_ms`` that overlaps no other.

    Speakers without such a segment have no row.
    """
    pairs = overlap_pairs(df, least_overlap_ms)
    touched = pairs.select(F.explode(F.array("seg1", "seg2")).alias("seg_id")).distinct()
    free = df.where((F.col("e") - F.col("s") >= least_ms) & F.col("speaker").isNotNull()).join(touched, "seg_id", "left_anti")
    return free.groupBy("rec_id", "speaker").agg(F.min_by("seg_id", F.struct("s", "e", "seg_id")).alias("seg_id"))

