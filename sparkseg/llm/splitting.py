"""Cutting oversized segments at pauses: dynamic programming over boundary positions."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import millis

LIMIT_MS = 30_000
#: Least length of a pause.
PAUSE_MS = 300
#: A cut between words, but not in a pause, costs as much as this many pieces; one anywhere else ten times that.
WORD_CUT, HARD_CUT = 1e4, 1e5

PIECE = "array<struct<piece:int,start_ms:bigint,end_ms:bigint,cut:string>>"


def pauses(words: list[tuple[int, int]], start: int, end: int, least: int = PAUSE_MS) -> list[tuple[int, int]]:
    """Stretches of at least ``least`` ms between consecutive words, ordered by time, within the segment."""
    found = []
    for (_, a), (b, _) in zip(words, words[1:]):
        if b - a >= least and a < end and b > start:
            found.append((max(a, start), min(b, end)))
    return found


def on_clock(words: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The words in time order on the recording's clock.

    Words that begin before the segment and, counted from its start, end within it (a
    tenth of a second of slack each way) are on the segment's own clock and are moved.
    """
    words = sorted(words)
    if words and words[0][0] < start - 100 and max(w[1] for w in words) <= end - start + 100:
        return [(a + start, b + start) for a, b in words]
    return words


def best_cuts(start: int, end: int, words: list[tuple[int, int]], limit: int = LIMIT_MS, least_pause: int = PAUSE_MS) -> tuple[list[int], bool]:
    """Cut positions between ``start`` and ``end``, and whether all lie in pauses.

    Every piece lasts at most ``limit``. The cost of a plan is the sum over its cuts
    (1 in a pause, less in a longer one; more between words; most elsewhere) and over its
    pieces of the squared deviation from the mean length of the fewest pieces. Candidates
    are the edges and middles of pauses, the furthest point of a pause that a piece can
    reach from either side, the gaps between words, and a grid for stretches without any. The
    reachable points make the search exact: if any cutting within pauses exists, the one that
    always goes as far as it can exists, and all of its points are candidates.
    """
    stops = pauses(words, start, end, least_pause)
    cost: dict[int, float] = {}

    def offer(at: int, price: float) -> None:
        if start < at < end:
            cost[at] = min(price, cost.get(at, np.inf))

    for a, b in stops:
        price = 1 / (1 + (b - a) / 1000)
        for at in (a, (a + b) // 2, b):
            offer(at, price)
    for forward in (True, False):
        at = start if forward else end
        while (end - at if forward else at - start) > limit:
            if forward:
                within = [min(b, at + limit) for a, b in stops if a <= at + limit and b > at]
                step = max(within, default=None)
            else:
                within = [max(a, at - limit) for a, b in stops if b >= at - limit and a < at]
                step = min(within, default=None)
            if step is None or step == at:
                break
            offer(step, 1.0)
            at = step
    natural = _plan(start, end, cost, limit)
    if natural is not None:
        return natural, True
    for (_, a), (b, _) in zip(words, words[1:]):
        if start < a <= b < end:
            offer((a + b) // 2, WORD_CUT)
    pieces = -(-(end - start) // limit)
    for i in range(1, pieces):
        offer(start + (end - start) * i // pieces, HARD_CUT)
    points = sorted([start, *cost, end])
    for a, b in zip(points, points[1:]):
        for i in range(1, -(-(b - a) // limit)):
            offer(a + i * limit, HARD_CUT)
    # the even grid may be out of reach from a word gap; limits counted from each candidate never are
    plan = _plan(start, end, cost, limit)
    return (plan if plan is not None else [start + i * limit for i in range(1, pieces)]), False


def _plan(start: int, end: int, cost: dict[int, float], limit: int) -> list[int] | None:
    """The cheapest way from start to end in steps of at most ``limit``."""
    points = [start, *sorted(cost), end]
    target = (end - start) / max(1, -(-(end - start) // limit))
    at = np.array(points, dtype=np.float64)
    price = np.array([0.0, *(cost[p] for p in points[1:-1]), 0.0])
    best, back = np.full(len(points), np.inf), np.zeros(len(points), dtype=int)
    best[0] = 0
    for j in range(1, len(points)):
        i = bisect_left(points, points[j] - limit)
        if i == j:
            continue
        total = best[i:j] + ((at[j] - at[i:j] - target) / limit) ** 2
        k = int(np.argmin(total))
        best[j], back[j] = total[k] + price[j], i + k
    if not np.isfinite(best[-1]):
        return None
    cuts, j = [], int(back[-1])
    while j > 0:
        cuts.append(points[j])
        j = int(back[j])
    return cuts[::-1]


def pieces_of(start: int, end: int, words: list[tuple[int, int]], limit: int = LIMIT_MS, overlap: int = 0, least_pause: int = PAUSE_MS) -> list[dict]:
    """The pieces in order, each but the first begun ``overlap`` ms early and still within ``limit``.

    With an overlap the cuts are planned for ``limit - overlap``, so the overlap counts.
    """
    if overlap < 0 or overlap >= limit:
        raise ValueError("the overlap must be shorter than the limit")
    cuts, natural = best_cuts(start, end, on_clock(words, start, end), limit - overlap, least_pause)
    edges = [start, *cuts, end]
    cut = "natural" if natural else "forced"
    return [{"piece": i, "start_ms": max(start, a - overlap * (i > 0)), "end_ms": b, "cut": cut} for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def split_segments(df: DataFrame, limit_ms: int = LIMIT_MS, overlap_ms: int = 0, pause_ms: int = PAUSE_MS) -> DataFrame:
    """Rows (seg_id, piece, start_ms, end_ms, cut) of each segment longer than ``limit_ms``.

    ``df`` has seg_id, start, end (seconds) and words. Segments without valid times or not
    longer than the limit are left out; redelivered rows count once, as first delivered where there is an
    ``ingested_at``; a null seg_id is a segment of its own for each distinct row of times. Null, empty and partly null ``words``
    give no pause where they have no times; then the cut is ``forced``. Further columns are
    ignored. An empty table gives an empty table.

    Filters and the narrow columns reach the scan; only long segments meet Python.
    """
    at = F.col("ingested_at") if "ingested_at" in df.columns else F.lit(None).cast("timestamp")
    stamps = F.expr("transform(words, w -> struct(w.start AS s, w.end AS e))")
    long = (
        df.select("seg_id", millis("`start`").alias("a"), millis("`end`").alias("b"), stamps.alias("w"), at.alias("at"))
        .where(F.col("b") - F.col("a") > limit_ms)
        .groupBy("seg_id", "a", "b")
        .agg(F.min_by("w", F.struct(F.col("at").isNull(), "at", "w")).alias("w"))
    )

    @F.pandas_udf(PIECE)
    def cut(a: pd.Series, b: pd.Series, w: pd.Series) -> pd.Series:
        out = []
        for start, end, words in zip(a, b, w):
            timed = [] if words is None else [(x["s"], x["e"]) for x in words if x is not None and x["s"] is not None and x["e"] is not None]
            ms = [(round(s * 1000), round(e * 1000)) for s, e in timed if s == s and e == e]
            out.append(pieces_of(int(start), int(end), ms, limit_ms, overlap_ms, pause_ms))
        return pd.Series(out)

    return long.select("seg_id", F.inline(cut("a", "b", "w")))
