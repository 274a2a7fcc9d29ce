"""Speaker labels: numbers, aliases and placeholders in whatever spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import col, collapsed
from sparkseg.operators.skew import salted_left_join

#: A label that names a speaker by number: SPEAKER_01, spk-1, [s1], S1, Speaker #1, 1; as many digits as a whole number holds.
NUMBERED = r"(?i)^[\s\[\](){}<>#*\"'.:]*(?:(?:speaker|spkr|spk|s)[\s._#:-]*)?0*(\d{1,18})[\s\[\](){}<>#*\"'.:]*$"


def label_key(label: Column | str) -> Column:
    """Lower case, single spaces, without a remark in brackets behind it."""
    return F.regexp_replace(collapsed(F.lower(col(label))), r"^(.*\S)\s*\([^()]*\)$", "$1")


def speaker_number(label: Column | str) -> Column:
    """The number that a label names, else null."""
    found = F.regexp_extract(label_key(label), NUMBERED, 1)
    return F.when(found != "", found.cast("bigint"))


def speaker_name(number: Column | str) -> Column:
    """SPEAKER_nn, at least two digits; null for null."""
    return F.when(col(number).isNotNull(), F.format_string("SPEAKER_%02d", col(number)))


def alias_keys(alias: DataFrame) -> DataFrame:
    """One row (rec_id, alias_key, alias_speaker) per name of a recording.

    Repeated rows count once; a name given to several speakers goes to the first of them;
    null or blank names and speakers without a number are left out.
    """
    return (
        alias.select("rec_id", label_key("alias").alias("alias_key"), speaker_name(speaker_number("speaker")).alias("alias_speaker"))
        .where("rec_id IS NOT NULL AND alias_key <> '' AND alias_speaker IS NOT NULL")
        .groupBy("rec_id", "alias_key")
        .agg(F.min("alias_speaker").alias("alias_speaker"))
    )


def resolve_speakers(df: DataFrame, alias: DataFrame, label: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the SPEAKER_nn that ``label`` means within ``rec_id``.

    A number wins over an alias. Null, blank and placeholder labels, and names that the
    recording doesn't have, give null. Only labels without a number are looked up, by a
    join whose rows are salted, so that one hot recording is spread over many tasks.
    """
    number = speaker_number(label)
    keyed = df.withColumn("__number", number).withColumn("__key", F.when(F.col("__number").isNull(), label_key(label)))
    names = alias_keys(alias).withColumnsRenamed({"rec_id": "__rec", "alias_key": "__alias", "alias_speaker": "__named"})
    joined = salted_left_join(keyed, names, {"rec_id": "__rec", "__key": "__alias"})
    return joined.withColumn(out, F.coalesce(speaker_name("__number"), F.col("__named"))).drop("__number", "__key", "__rec", "__alias", "__named")
