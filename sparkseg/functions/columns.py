"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


# fixed value: white space of any kind, as a class that is faster than the Unicode one of regular expressions
WHITE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def millis(seconds: Column | str) -> Column:
    """Nearest whole millisecond; null for null and NaN."""
    c = col(seconds)
    return F.when(~F.isnan(c), F.round(c * 1000).cast("bigint"))


def valid_times(start_ms: Column | str, end_ms: Column | str) -> Column:
    """Both times given, the end later than the start."""
    return F.coalesce(col(end_ms) > col(start_ms), F.lit(False))


def collapsed(text: Column | str) -> Column:
    """White space runs made one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(col(text), f"{WHITE}+", " "), r"^ | $", "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def hash_edge(share: float) -> int:
    """The 64-bit hash up to which about ``share`` of all hashes lie; the greatest for 1 and more."""
    return min(2**63 - 1, int(min(share, 1.0) * 2.0**53) * 2**11 - 2**63)
