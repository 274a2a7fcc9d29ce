"""Queries of the general training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseg.functions.columns import millis
from sparkseg.functions.speakers import resolve_speakers
from sparkseg.operators.periods import continuous_periods
from sparkseg.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Periods and gaps of each speaker over the segments of both paths.

    Redelivered rows have the times and the speaker of the first delivery, and merging is
    idempotent, so they need no step of their own.
    """
    columns = ["rec_id", "speaker", millis("`start`").alias("start_ms"), millis("`end`").alias("end_ms")]
    both = table(spark, folder, "seg_result").select(*columns).unionByName(table(spark, folder, "res_seg").select(*columns)).where("end_ms > start_ms")
    named = resolve_speakers(both, table(spark, folder, "speaker_alias"), "speaker", "who").where("who IS NOT NULL AND rec_id IS NOT NULL")
    merged = continuous_periods(named.select("rec_id", F.col("who").alias("speaker"), "start_ms", "end_ms"), ["rec_id", "speaker"])
    return merged.select("rec_id", "speaker", "kind", "start_ms", "end_ms")


QUERIES = {"p1_found": p1_found}

#: A speaker label's number or alias, for the segments of both tables.
_LABELS = r"""
named AS (
  SELECT rec_id, speaker, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM seg_result
  UNION ALL
  SELECT rec_id, speaker, CAST(round("start" * 1000) AS BIGINT), CAST(round("end" * 1000) AS BIGINT) FROM res_seg),
keyed AS (
  SELECT *, regexp_extract(trim(lower(speaker)), '^\[?(?:speaker|spkr|spk|s)[ ._#-]*0*([0-9]+)\]?$', 1) AS num,
    regexp_replace(trim(lower(speaker)), ' *\([^()]*\)$', '') AS k
  FROM named WHERE e > s),
aliases AS (SELECT rec_id, trim(lower(alias)) AS k, min(speaker) AS who FROM speaker_alias GROUP BY ALL),
usable AS (
  SELECT keyed.rec_id, s, e, CASE WHEN num <> '' THEN 'SPEAKER_' || CASE WHEN length(num) < 2 THEN '0' ELSE '' END || num ELSE who END AS speaker
  FROM keyed LEFT JOIN aliases ON keyed.rec_id = aliases.rec_id AND keyed.k = aliases.k)
"""

SQL = {
    "p1_found": f"""
WITH {_LABELS},
marked AS (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY rec_id, speaker ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
  FROM usable WHERE speaker IS NOT NULL AND rec_id IS NOT NULL),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY rec_id, speaker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM marked),
periods AS (SELECT rec_id, speaker, min(s) AS s, max(e) AS e FROM grouped GROUP BY rec_id, speaker, g),
following AS (SELECT *, lead(s) OVER (PARTITION BY rec_id, speaker ORDER BY s) AS n FROM periods)
SELECT rec_id, speaker, 'period' AS kind, s AS start_ms, e AS end_ms FROM following
UNION ALL
SELECT rec_id, speaker, 'gap', e, n FROM following WHERE n IS NOT NULL
""",
}
