"""Functions on vectors and on sound as arrays of samples, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkseg.functions.columns import col, let


def _doubles(v: Column | str) -> Column:
    return col(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def energy(v: Column | str) -> Column:
    """Sum of squares; 0 for an empty array."""
    return F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + x * x)


def rms(v: Column | str) -> Column:
    """Root of the mean square; 0 for an empty array."""
    return F.when(F.size(v) > 0, F.sqrt(energy(v) / F.size(v))).when(F.size(v) == 0, F.lit(0.0))


def peak(v: Column | str) -> Column:
    """Greatest absolute value; null for an empty array."""
    return F.array_max(F.transform(_doubles(v), F.abs))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; -1 if either is null or has no length."""
    length = F.sqrt(energy(a)) * F.sqrt(energy(b))
    return F.coalesce(let(F.struct(dot(a, b).alias("d"), length.alias("l")), lambda x: F.when(x["l"] > 0, x["d"] / x["l"])), F.lit(-1.0))


def gain_db(level_db: Column | str, target_db: float = -20.0, most_db: float = 3.0) -> Column:
    """Decibels by which a sound of a level is raised, within ``most_db`` either way; 0 for silence."""
    level = col(level_db)
    return F.when(level.isNull() | (level == float("-inf")), F.lit(0.0)).otherwise(F.least(F.greatest(F.lit(target_db) - level, F.lit(-most_db)), F.lit(most_db)))


def normalised(v: Column | str) -> Column:
    """Samples over their peak; silence stays as it is."""
    return let(peak(v), lambda p: F.when(p > 0, F.transform(_doubles(v), lambda x: x / p)).otherwise(_doubles(v)))


#: Level below which a sound counts as silence.
SILENT = 1e-10


def amplitude_matched(source: Column | str, target_rms: Column) -> Column:
    """Samples scaled to a level and clipped to 1 either way; silence stays as it is."""
    level = F.struct(rms(source).alias("r"), target_rms.alias("t"))
    return let(level, lambda q: F.when(q["r"] < SILENT, _doubles(source)).otherwise(F.transform(_doubles(source), lambda x: F.least(F.greatest(x * (q["t"] / (q["r"] + SILENT)), F.lit(-1.0)), F.lit(1.0)))))


def samples(v: Column | str, start_ms: Column, end_ms: Column, rate: int) -> Column:
    """The samples of a stretch of time, both ends cut down to whole samples."""
    first = F.floor(F.greatest(start_ms, F.lit(0)) * rate / 1000).cast("int")
    last = F.least(F.floor(end_ms * rate / 1000).cast("int"), F.size(v))
    return F.slice(v, first + 1, F.greatest(last - first, F.lit(0)))


# fixed values: coefficients from the highest power down
MOS_GENERAL = {"sig": [-0.08397278, 1.22083953, 0.0052439], "bak": [-0.13166888, 1.60915514, -0.39604546], "ovr": [-0.06766283, 1.11546468, 0.04602535]}
MOS_PERSONAL = {"sig": [-0.01019296, 0.02751166, 1.19576786, -0.24348726], "bak": [-0.04976499, 0.44276479, -0.1644611, 0.96883132], "ovr": [-0.00533021, 0.005101, 1.18058466, -0.11236046]}


def mos_corrected(score: Column | str, kind: str, personal: bool = False) -> Column:
    """A raw quality score ("sig", "bak" or "ovr") brought to the scale of opinions."""
    value = F.lit(0.0)
    for c in (MOS_PERSONAL if personal else MOS_GENERAL)[kind]:
        value = value * col(score) + F.lit(c)
    return value


#: Analysis windows of 9.01 s every second.
WINDOW_MS, HOP_MS = 9010, 1000


def hop_starts(length_ms: Column | str, window_ms: int = WINDOW_MS, hop_ms: int = HOP_MS) -> Column:
    """Starts of the analysis windows of a sound, in ms.

    A sound shorter than a window counts as repeated by doubling until it is long enough. There
    is a window for each whole hop by which the whole seconds are longer than the window, and the first.
    """
    length = col(length_ms)
    doublings = F.greatest(F.ceil(F.log2(F.lit(float(window_ms)) / length)), F.lit(0)).cast("int")
    long = (length * F.pow(F.lit(2), doublings)).cast("bigint")
    whole = F.floor(long / 1000) * 1000
    # the count cuts towards zero and one is added, so a sound of just over nine seconds has one window
    count = ((whole - window_ms) / hop_ms).cast("int") + 1
    return F.when(length > 0, F.filter(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: (i * hop_ms).cast("bigint")), lambda s: s + window_ms <= long)).otherwise(F.array().cast("array<bigint>"))
