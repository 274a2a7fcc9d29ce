"""Folds over ordered segments that no window expresses."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseg.operators.ordered import fold_sorted, ordered, time_bucket
from sparkseg.operators.segments import ORDER, denested


def cut_by_speaker(df: DataFrame, gap_ms: int = 2000, least_ms: int = 3000, most_ms: int = 30_000) -> DataFrame:
    """Rows (rec_id, s, e, speaker): short segments merged into the one before, long ones cut.

    A segment of ``most_ms`` or more gives pieces of ``most_ms`` and a rest. A shorter one is
    merged into the row before it if that has the same speaker, it is shorter than ``least_ms``,
    the gap is below ``gap_ms`` and the whole stays below ``most_ms``; merging takes its end,
    even if that is earlier. Rows shorter than ``least_ms`` are left out in the end. Segments
    without a speaker are left out first.

    Whether a segment can merge at all depends on itself and its neighbour only, so runs of
    segments that can are folded by themselves: a recording of any length is spread over its runs.
    """
    able = (F.col("e") - F.col("s") < least_ms) & F.coalesce(F.col("__who") == F.col("speaker"), F.lit(False))
    rows = ordered(df.where("speaker IS NOT NULL").select("rec_id", "seg_id", "s", "e", "speaker"), ["rec_id"], time_bucket("s"), ORDER, lag={"__who": F.col("speaker")}, number="__i")
    first = F.when(~able, F.col("__i"))
    runs = ordered(rows.withColumn("__first", first), ["rec_id"], time_bucket("s"), ORDER, running_max={"__run": F.col("__first")})
    runs = runs.withColumn("__run", F.greatest(F.col("__first"), F.col("__run"))).select("rec_id", F.col("__run").alias("run"), "__i", "s", "e", "speaker")

    def fold(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        rec, _ = key
        start = end = who = None
        for _, _, _, s, e, speaker in group:
            if start is None or s - end >= gap_ms or e - start >= most_ms:
                if start is not None:
                    yield rec, start, end, who
                while e - s >= most_ms:
                    yield rec, s, s + most_ms, speaker
                    s += most_ms
                start, who = s, speaker
            end = e
        yield rec, start, end, who

    folded = fold_sorted(runs, ["rec_id", "run"], ["__i"], fold, "rec_id string, s bigint, e bigint, speaker string")
    return folded.where(F.col("e") - F.col("s") >= least_ms)


def chunk_ranges(silences: DataFrame, durations: DataFrame, most_ms: int = 120_000, capped: bool = False) -> DataFrame:
    """Rows (rec_id, chunk, start_2ms, end_2ms): each recording cut at the middles of its silences.

    ``silences`` has (rec_id, start_ms, end_ms), ``durations`` (rec_id, duration_ms). Times come
    in half milliseconds, so that middles are whole. A recording of at most ``most_ms`` (and one
    ms) is one chunk. Otherwise a chunk ends at its furthest middle within ``most_ms``; if there is
    none, at ``most_ms``, or, when no silence is left at all though there were some, at the
    end of the recording; ``capped`` cuts at ``most_ms`` there too.

    Cutting is greedy, so it streams through the sorted middles of a recording one by one.
    """
    middles = silences.select("rec_id", (F.col("start_ms") + F.col("end_ms")).alias("at")).where("rec_id IS NOT NULL")
    ends = durations.where("rec_id IS NOT NULL").select("rec_id", (2 * F.col("duration_ms")).alias("__total"))
    rows = middles.withColumn("kind", F.lit(1)).unionByName(ends.select("rec_id", F.col("__total").alias("at"), F.lit(0).alias("kind")))
    most, least = 2 * most_ms, 2

    def fold(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        (rec,) = key
        _, total, kind = next(group)
        if kind:  # silences of a recording that isn't listed
            return
        if total <= most + least:
            yield rec, 0, 0, total
            return
        begin = chunk = 0
        best, any_ = None, False

        def cut(at: int) -> tuple:
            nonlocal begin, chunk, best
            row = rec, chunk, begin, at
            begin, best, chunk = at, None, chunk + 1
            return row

        for _, at, _ in group:
            any_ = True
            while at > begin + most and begin < total - least:
                yield cut(best if best is not None else min(begin + most, total))
            if begin + least < at:
                best = at
        while begin < total - least:
            if best is not None:
                yield cut(best)
            elif any_ and not capped:
                yield cut(total)
            else:
                yield cut(min(begin + most, total))

    return fold_sorted(rows.select("rec_id", "at", "kind"), ["rec_id"], ["kind", "at"], fold, "rec_id string, chunk bigint, start_2ms bigint, end_2ms bigint")


def gap_parts(stamps: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Stretches of speech stamps, halved at their widest gap (the first of equals) until shorter than ``most``.

    A single stamp stays whole however long it is.
    """
    out = []
    todo = [(0, len(stamps) - 1)] if stamps else []
    while todo:
        a, b = todo.pop()
        if a == b or stamps[b][1] - stamps[a][0] < most:
            out.append((stamps[a][0], stamps[b][1]))
            continue
        at = max(range(a, b), key=lambda i: (stamps[i + 1][0] - stamps[i][1], -i))
        todo += [(at + 1, b), (a, at)]
    return out


def max_gap_split(df: DataFrame, speech: DataFrame, most_ms: int = 20_000) -> DataFrame:
    """Rows (rec_id, seg_id, part, s, e): de-nested segments, those above ``most_ms`` parted at gaps.

    ``speech`` has (seg_id, stamps ARRAY<STRUCT<s, e>>) in ms of the recording. A long segment
    without stamps has no row.
    """
    @F.pandas_udf("array<struct<s:bigint,e:bigint>>")
    def part(stamps: pd.Series) -> pd.Series:
        return stamps.map(lambda ss: [{"s": a, "e": b} for a, b in gap_parts(sorted((x["s"], x["e"]) for x in (ss if ss is not None else [])), most_ms)])

    kept = denested(df)
    own = F.array(F.struct("s", "e"))
    joined = kept.join(speech.select(F.col("seg_id").alias("__seg"), "stamps"), F.col("seg_id") == F.col("__seg"), "left")
    short = F.col("e") - F.col("s") <= most_ms
    parts = F.when(short, own).otherwise(part(F.when(~short, F.col("stamps"))))
    return joined.select("rec_id", "seg_id", F.posexplode(parts).alias("part", "x")).select("rec_id", "seg_id", "part", "x.s", "x.e")
