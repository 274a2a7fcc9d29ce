"""A bounded sample of a table of any size, the same on every run and cluster."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sparkseg.functions.columns import hash_edge


def drawn(df: DataFrame, key: str, sample: int, narrow: Callable[[DataFrame], DataFrame]) -> list[Row]:
    """At most ``sample`` rows of ``narrow``, those of the least hashes of ``key``, on the driver.

    ``narrow`` gets rows of ``df`` with their hash ``h`` and gives rows of bounded width, ``h`` first;
    of equal hashes the least rows count. A share of the table that holds them almost surely is cut
    out by hash before that, so neither the work of ``narrow`` nor the sort grows with the table;
    where it leaves too few, a larger share is cut out, in the end the whole table.
    """
    hashed = df.withColumn("h", F.xxhash64(key))
    share = (sample + 6 * math.sqrt(sample)) / max(1, df.count())
    while True:
        made = narrow(hashed.where(F.col("h") <= hash_edge(share)) if share < 1 else hashed)
        rows = made.orderBy(*made.columns).limit(sample).collect()
        if len(rows) == sample or share >= 1:
            return rows
        share *= min(16.0, 1.5 * sample / max(1, len(rows)))
