"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkseg.functions.columns import WHITE, col

# fixed value: the characters that don't count
UNCOUNTED = ",.!?\"'，。！？“”‘’ "


def char_count(text: Column | str) -> Column:
    """Code points of a text without common punctuation and spaces; null for null."""
    return F.length(F.translate(col(text), UNCOUNTED, "")).cast("bigint")


def stripped(text: Column | str) -> Column:
    """The text without white space at its ends, of any kind."""
    return F.regexp_replace(F.regexp_replace(col(text), f"^{WHITE}+", ""), f"{WHITE}+$", "")


def has_text(text: Column | str) -> Column:
    """Whether a text has more than white space; false for null."""
    return F.coalesce(col(text).rlike(WHITE.replace("[", "[^", 1)), F.lit(False))


def tokens(text: Column | str) -> Column:
    """Words between white space of any kind; none for a blank text, null for null."""
    return F.filter(F.split(col(text), f"{WHITE}+"), lambda w: w != "")


def display_time(ms: Column | str) -> Column:
    """HH:MM:SS.mmm; hours go beyond 24."""
    m = col(ms)
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(m / 3_600_000), F.floor(m / 60_000) % 60, F.floor(m / 1000) % 60, m % 1000)


def display_range(start_ms: Column | str, end_ms: Column | str) -> Column:
    return F.concat(F.lit("[ "), display_time(start_ms), F.lit(" --> "), display_time(end_ms), F.lit("]"))


def srt_time(ms: Column | str) -> Column:
    """HH:MM:SS,mmm; begins again at 24 hours."""
    m = col(ms)
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(m / 3_600_000) % 24, F.floor(m / 60_000) % 60, F.floor(m / 1000) % 60, m % 1000)


def srt_block(number: Column, start_ms: Column | str, end_ms: Column | str, speaker: Column | str, text: Column | str) -> Column:
    """One numbered subtitle, with the empty line behind it; missing texts are empty."""
    return F.concat(number.cast("string"), F.lit("\n"), srt_time(start_ms), F.lit(" --> "), srt_time(end_ms), F.lit("\n"), F.coalesce(col(speaker), F.lit("")), F.lit(": "), F.coalesce(col(text), F.lit("")), F.lit("\n\n"))


def safe_name(name: Column | str) -> Column:
    """The name with anything but letters, digits, _, - and . made _."""
    return F.regexp_replace(col(name), r"(?U)[^\w\-.]", "_")


def stem(path: Column | str) -> Column:
    """The file name of a path without its last suffix."""
    return F.regexp_replace(F.regexp_replace(col(path), r"^.*/", ""), r"(.)\.[^.]*$", "$1")


def cache_key(path: Column | str, modified: Column, length: Column | str) -> Column:
    """First 16 hexadecimal digits of the MD5 of path, time and size, joined by |."""
    return F.substring(F.md5(F.concat_ws("|", col(path), modified.cast("string"), col(length).cast("string"))), 1, 16)


def last_line(text: Column | str) -> Column:
    """The last line of a text without white space around it."""
    return stripped(F.element_at(F.split(stripped(text), "\n"), -1))


def real_time_factor(seconds: Column | str, duration: Column | str) -> Column:
    """Processing time over duration; 0 where there is no duration."""
    return F.when(col(duration) > 0, col(seconds) / col(duration)).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Share of the distinct words of two lists that both have; 0 if either is empty or null."""
    share = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), share).otherwise(F.lit(0.0))


#: Runs of Latin words.
LATIN_PHRASE = r"[A-Za-z][A-Za-z']*(?: +[A-Za-z][A-Za-z']*)*"


def latin_phrases(text: Column | str, words: bool = False) -> Column:
    """The Latin phrases of a text in order, or its single Latin words."""
    return F.regexp_extract_all(col(text), F.lit(r"[A-Za-z][A-Za-z']*" if words else LATIN_PHRASE), F.lit(0))


def pronounced(text: Column | str, pronounce: Callable[[str], str], words: bool = False) -> Column:
    """The text with each Latin phrase (or word) replaced by ``pronounce`` of it.

    Texts without Latin letters stay JVM-side results of no change: the function sees only
    the others. What ``pronounce`` fails on stays as it is.
    """
    import re

    pattern = re.compile(r"[A-Za-z][A-Za-z']*" if words else LATIN_PHRASE)

    def one(m: re.Match) -> str:
        try:
            return pronounce(m.group())
        except Exception:  # noqa: BLE001 - a plug-in's failure on one phrase must not end the job
            return m.group()

    @F.pandas_udf("string")
    def replace(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else pattern.sub(one, t))

    has = F.coalesce(col(text).rlike("[A-Za-z]"), F.lit(False))
    return F.coalesce(F.when(has, replace(F.when(has, col(text)))), col(text))
