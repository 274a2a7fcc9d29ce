"""Overlapping, nested and gapped intervals: continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseg.session import checkpointed

#: Length of the time buckets into which the intervals of one key are split.
BUCKET_MS = 3_600_000


def continuous_periods(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms", bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows (keys, kind, start_ms, end_ms): each maximal period and each gap of a key.

    Intervals that overlap or touch belong together. Times are whole milliseconds; rows
    with a null time or without positive length are left out, rows with a null key form
    one group like any other key, repeated rows change nothing, an empty table gives an
    empty table, further columns are ignored.

    ``session_window`` with a duration of its own for each row merges within a bucket of
    time, so that no task holds a whole key; touching sessions are joined behind it. What is left of a bucket,
    disjoint stretches in order, is one row, written once. The greatest end of all earlier buckets is carried forward: a
    stretch that it reaches continues an earlier period. All periods of a bucket but the last end there,
    and the gaps behind them lead to the next stretch; the last one, what continues it and the gap to the next
    period are put together from one row of edges per bucket.
    """
    keyed = df.select(*[F.col(k) for k in keys], F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")).where("e > s")
    bucket = F.floor(F.col("s") / bucket_ms).alias("b")
    seconds = ((F.col("e") - F.col("s")) / 1000).cast("decimal(18,6)")
    window = F.session_window(F.timestamp_millis("s"), F.make_interval(secs=seconds))
    merged = keyed.select(*keys, bucket, "s", "e").groupBy(*keys, "b", window.alias("w")).agg(F.min("s").alias("s"), F.max("e").alias("e"))

    group = [*keys, "b"]
    local = Window.partitionBy(*group).orderBy("s", "e")
    # touching sessions: joined here whatever session_window makes of them
    reach = F.max("e").over(local.rowsBetween(Window.unboundedPreceding, -1))
    touched = merged.withColumn("first", F.coalesce(F.col("s") > reach, F.lit(True))).withColumn("own", F.last(F.when(F.col("first"), F.col("s")), True).over(local))
    stretches = touched.groupBy(*group, F.col("own").alias("s")).agg(F.max("e").alias("e"))
    buckets = checkpointed(stretches.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("all"), F.max("e").alias("most")))

    across = Window.partitionBy(*keys).orderBy("b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*group, F.max("most").over(before).alias("carry"))
    fresh = F.filter("all", lambda x: F.coalesce(x["s"] > F.col("carry"), F.lit(True)))
    met = _same(buckets.drop("most"), carried, group).withColumn("new", fresh).withColumn("tail", F.array_max(F.filter("all", lambda x: x["s"] <= F.col("carry"))["e"]))
    closed, following = F.slice("new", 1, F.greatest(F.size("new") - 1, F.lit(0))), F.slice("new", 2, F.greatest(F.size("new") - 1, F.lit(0)))
    row = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start_ms"), b.alias("end_ms"))
    within = F.concat(F.transform(closed, lambda x: row("period", x["s"], x["e"])), F.zip_with(closed, following, lambda x, y: row("gap", x["e"], y["s"])))

    edges = met.select(*group, "tail", F.try_element_at("new", F.lit(1))["s"].alias("next"), F.try_element_at("new", F.lit(-1)).alias("last"))
    opened = edges.withColumn("open", F.last(F.col("last.s"), True).over(before))
    pieces = F.array(
        F.struct(F.col("open").alias("p"), F.col("tail").alias("e"), F.col("next").alias("n")),
        F.struct(F.col("last.s").alias("p"), F.col("last.e").alias("e"), F.lit(None).cast("bigint").alias("n")),
    )
    ends = opened.select(*keys, F.inline(pieces)).where("p IS NOT NULL").groupBy(*keys, "p").agg(F.max("e").alias("q"), F.max("n").alias("n"))
    over = ends.select(*keys, F.inline(F.array(row("period", F.col("p"), F.col("q")), row("gap", F.col("q"), F.col("n"))))).where("end_ms IS NOT NULL")
    return met.select(*keys, F.inline(within)).unionByName(over)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which nulls are equal, without a second set of keys."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, condition).drop(*[f"__{k}" for k in keys])
