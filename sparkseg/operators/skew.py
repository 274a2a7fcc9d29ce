"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseg.session import checkpointed

#: Parts into which each key of a salted join is split.
SALTS = 8
#: Rows and bytes of them up to which the smaller table is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 32 << 20


def fits(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table, best one that is written already, is small enough to be broadcast: counted, and only few rows weighed."""
    if table.count() > rows:
        return False
    return (table.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0) <= size


def salted_left_join(left: DataFrame, right: DataFrame, on: dict[str, str], salts: int = SALTS, most: int = BROADCAST_ROWS, written: bool = False) -> DataFrame:
    """Left join of a large table with a smaller one that is unique in its key.

    ``on`` maps columns of ``left`` to those of ``right``, which must differ in name. ``right`` is
    written to the shared folder, unless it is ``written`` already, and counted. Up to ``most`` rows of ``BROADCAST_BYTES`` it is broadcast. Beyond, rows of
    ``left`` go to one of ``salts`` parts by turns, each row of ``right`` is repeated in every part,
    and both are shuffled: a hot key is spread over as many tasks.
    """
    kept = right if written else checkpointed(right)
    condition = F.lit(True)
    for a, b in on.items():
        condition = condition & (F.col(a) == F.col(b))
    if fits(kept, most):
        return left.join(F.broadcast(kept), condition, "left")
    salted = left.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    spread = kept.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return salted.join(spread, condition & (F.col("__salt") == F.col("__part")), "left").drop("__salt", "__part")
