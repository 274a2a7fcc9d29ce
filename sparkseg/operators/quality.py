"""Quality of transcripts and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import col, let
from sparkseg.functions.text import char_count, has_text, tokens
from sparkseg.functions.vectors import mos_corrected

#: Length of the n-grams, and how often one may occur.
GRAM, MOST = 15, 5


def kept_by_repetition(df: DataFrame, key: str, text: str = "text", gram: int = GRAM, most: int = MOST) -> DataFrame:
    """Rows (key, keep): false for blank texts and those with a run of ``gram`` words more than ``most`` times.

    Texts of fewer words are kept; a null text is blank; repeated rows stay.

    A text is a row, so its runs are counted where it is: words are hashed (64 bits), hashes of
    runs are joined to those of runs twice as long, and of the sorted hashes of the full runs one
    that equals the one ``most`` places on occurs too often. Nothing is shuffled.
    """
    words = df.select(key, has_text(text).alias("filled"), tokens(text).alias("w"))

    def joined(r: Column, apart: int) -> Column:
        return let(r, lambda x: F.zip_with(F.slice(x, 1, F.size(x) - apart), F.slice(x, apart + 1, F.size(x) - apart), lambda p, q: F.xxhash64(p, q)))

    def often(w: Column) -> Column:
        runs, length = F.transform(w, lambda x: F.xxhash64(x)), 1
        while length < gram:
            step = min(length, gram - length)
            runs, length = joined(runs, step), length + step
        return let(F.array_sort(runs), lambda r: F.exists(F.zip_with(F.slice(r, 1, F.size(r) - most), F.slice(r, most + 1, F.size(r) - most), lambda x, y: x == y), lambda same: same))

    return words.select(key, (F.col("filled") & ~F.when(F.size("w") >= gram + most, often(F.col("w"))).otherwise(F.lit(False))).alias("keep"))


def with_duration_bounds(df: DataFrame, duration: Column | str, text: str = "text") -> DataFrame:
    """``df`` with ``chars``, ``rate`` (seconds a character, 0 without any) and the bounds ``low`` and ``high``.

    The bounds are the quartiles of all rates of texts with characters, widened by one and a half
    of their distance; without any such text they are 0 and infinity. Null texts have no characters.
    The exact quartiles are one row, joined by broadcast.
    """
    rated = df.withColumn("chars", F.coalesce(char_count(text), F.lit(0))).withColumn("rate", F.when(F.col("chars") > 0, col(duration) / F.col("chars")).otherwise(F.lit(0.0)))
    q = rated.where("chars > 0").agg(F.percentile("rate", [0.25, 0.75]).alias("q"))
    spread = F.col("q")[1] - F.col("q")[0]
    bounds = q.select(F.coalesce(F.col("q")[0] - 1.5 * spread, F.lit(0.0)).alias("low"), F.coalesce(F.col("q")[1] + 1.5 * spread, F.lit(float("inf"))).alias("high"))
    return rated.crossJoin(F.broadcast(bounds))  # a single row


def valid_audio(df: DataFrame, duration: Column | str, text: str = "text", score: str | None = None, least: float = 3.0, most: float = 30.0, least_score: float = 3.0, least_chars: int = 2) -> DataFrame:
    """The rows of ``with_duration_bounds`` within all limits, each of them included.

    Given ``score``, rows without one or below ``least_score`` are left out.
    """
    rows = with_duration_bounds(df, duration, text)
    kept = col(duration).between(least, most) & (F.col("chars") >= least_chars) & F.col("rate").between(F.col("low"), F.col("high"))
    if score:
        kept = kept & (F.col(score) >= least_score)
    return rows.where(kept)


def mean_scores(windows: DataFrame, key: list[str], personal: bool = False) -> DataFrame:
    """Mean raw and corrected scores of the analysis windows of a sound, from columns sig, bak and ovr."""
    names = {"ovr": "OVRL", "sig": "SIG", "bak": "BAK"}
    raw = [F.avg(k).alias(f"{name}_raw") for k, name in names.items()]
    return windows.groupBy(*key).agg(F.count("*").alias("num_hops"), *raw, *[F.avg(mos_corrected(k, k, personal)).alias(name) for k, name in names.items()])
