"""The sound of segments, cut out of recordings without moving a whole recording to each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slices(sounds: DataFrame, spans: DataFrame, keys: list[str], seconds: int = 30) -> DataFrame:
    """``spans`` (keys, s, e in ms, ...) with ``rate`` and ``sound``, their samples of ``sounds`` (keys, rate, wave).

    Both ends are cut down to whole samples and to the sound. Spans without samples, of null or unknown keys,
    and repeated rows beyond the first are left out. Rows of ``sounds`` must differ in their keys.

    Sounds are cut into pieces of ``seconds`` where they are; pieces and spans meet by key and number, so
    each sample moves once, and a span of a minute is put together from three pieces at most.
    """
    size = F.col("rate").cast("bigint") * seconds
    heads = sounds.select(*keys, F.col("rate").cast("bigint").alias("rate"), F.size("wave").alias("__n"))
    first, last = F.floor(F.greatest(F.col("s"), F.lit(0)) * F.col("rate") / 1000), F.least(F.floor(F.col("e") * F.col("rate") / 1000), F.col("__n"))
    columns = spans.columns
    cut = spans.distinct().join(heads, keys).withColumn("__a", first.cast("bigint")).withColumn("__b", last.cast("bigint")).where("__b > __a")
    touched = cut.withColumn("__piece", F.explode(F.sequence(F.floor(F.col("__a") / size), F.floor((F.col("__b") - 1) / size))))
    count = F.greatest(F.ceil(F.size("wave") / size), F.lit(1))
    parts = F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), lambda i: F.slice("wave", (i * size + 1).cast("int"), size.cast("int")))
    pieces = sounds.where("rate > 0 AND wave IS NOT NULL").select(*keys, F.posexplode(parts).alias("__at", "__part")).withColumn("__piece", F.col("__at").cast("bigint")).drop("__at")
    begin = F.greatest(F.col("__a") - F.col("__piece") * size, F.lit(0))
    end = F.least(F.col("__b") - F.col("__piece") * size, size)
    met = touched.join(pieces, [*keys, "__piece"]).withColumn("__part", F.slice("__part", (begin + 1).cast("int"), (end - begin).cast("int")))
    whole = met.groupBy(*[F.col(f"`{c}`") for c in columns], "rate").agg(F.sort_array(F.collect_list(F.struct("__piece", "__part"))).alias("__all"))
    return whole.select(*[F.col(f"`{c}`") for c in columns], "rate", F.flatten(F.transform("__all", lambda x: x["__part"])).alias("sound"))
