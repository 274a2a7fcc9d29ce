"""Audio files, listings, manifests, and what models hand over as text."""

from __future__ import annotations

import ast
import io
import json
import os
import re
import wave as wavfile
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseg.functions.columns import col
from sparkseg.functions.speakers import speaker_name
from sparkseg.functions.text import cache_key, display_range, safe_name, stem

# fixed values: suffixes of audio files
SUFFIXES = (".mp3", ".wav", ".flac", ".m4a", ".aac", ".opus", ".ogg")
ENCODED = (".opus", ".ogg")
LEAST_BYTES = 1024


def read_config(path: str) -> dict:
    """A JSON object; FileNotFoundError if there is no file, TypeError if it isn't JSON."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8") as f:
        try:
            return json.load(f)
        except ValueError as e:
            raise TypeError(f"{path} isn't JSON") from e


def _suffix(path: Column, suffixes: tuple[str, ...]) -> Column:
    return F.regexp_extract(path, r"(\.[^./]*)$", 1).isin(*suffixes)


def audio_files(listing: DataFrame, suffixes: tuple[str, ...] = SUFFIXES, any_case: bool = True, skip_folders: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Rows of a listing (path, length, ...) that are audio files, each path once.

    Temporary files (names with .temp) and, given ``skip_folders``, files below folders with that
    in their name are left out, and files below ``least_bytes`` or of unknown length if that is
    positive. Of repeated rows the one of the latest modification, then the longest, stays.
    """
    path = F.lower("path") if any_case else F.col("path")
    kept = listing.where(F.col("path").isNotNull() & _suffix(path, suffixes) & ~F.regexp_replace("path", r"^.*/", "").contains(".temp"))
    if skip_folders:
        kept = kept.where(~F.regexp_extract("path", r"^(.*/)", 1).contains(skip_folders))
    if least_bytes:
        kept = kept.where(F.col("length") >= least_bytes)
    row = F.struct(*[F.col(f"`{c}`") for c in listing.columns])
    return kept.groupBy(F.col("path").alias("__p")).agg(F.max_by(row, F.struct("modificationtime", "length")).alias("r")).select("r.*")


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Rows (path, length, modificationtime) of a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modificationtime"))


def folders_with(listing: DataFrame, suffixes: tuple[str, ...] = ENCODED, skip: str = "_opus_cache") -> DataFrame:
    """Rows (folder) that hold at least one file of the suffixes, spelled exactly so, outside skipped folders."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return listing.where(_suffix(F.col("path"), suffixes)).select(folder.alias("folder")).where(~F.col("folder").contains(skip)).distinct()


def cache_names(listing: DataFrame, suffixes: tuple[str, ...] = ENCODED) -> DataFrame:
    """``listing`` with ``cached``: the name of the decoded file of those that need decoding, else null.

    The name is the file's, made safe, and a key of its path, time and size: a changed file has another.
    """
    name = F.concat(safe_name(stem("path")), F.lit("_"), cache_key("path", F.unix_micros(F.col("modificationtime").cast("timestamp")), "length"), F.lit(".wav"))
    return listing.withColumn("cached", F.when(_suffix(F.lower("path"), suffixes), name))


def decode_todo(names: DataFrame, have: DataFrame) -> DataFrame:
    """Rows of ``cache_names`` that are yet to be decoded: not among ``have`` (cached)."""
    return names.where("cached IS NOT NULL").join(have.select("cached").distinct(), "cached", "left_anti")


def decoded_paths(names: DataFrame, decoded: DataFrame) -> DataFrame:
    """``names`` with ``read``: the decoded file (cached, decoded) if there is one, else the path.

    Files that need decoding and aren't decoded are left out.
    """
    made = decoded.groupBy(F.col("cached").alias("__c")).agg(F.max("decoded").alias("__d"))
    joined = names.join(made, F.col("cached") == F.col("__c"), "left")
    return joined.where("cached IS NULL OR __d IS NOT NULL").withColumn("read", F.coalesce("__d", "path")).drop("__c", "__d")


def decode_wave(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and samples, frames by channels, of a WAV file of 8, 16, 24 or 32 bits."""
    with wavfile.open(io.BytesIO(content)) as w:
        width, raw = w.getsampwidth(), np.frombuffer(w.readframes(w.getnframes()), dtype=np.uint8)
        if width == 1:
            pcm = (raw.astype(np.float32) - 128) / 128
        else:
            # the sample's bytes above zeros make a whole number of 32 bits
            wide = np.zeros((len(raw) // width, 4), dtype=np.uint8)
            wide[:, 4 - width :] = raw.reshape(-1, width)
            pcm = (wide.view("<i4").ravel() / 2.0**31).astype(np.float32)
        return w.getframerate(), pcm.reshape(-1, w.getnchannels())


#: What decodes the files of a suffix.
DECODERS: dict[str, Callable[[bytes], tuple[int, np.ndarray]]] = {".wav": decode_wave}


def read_waves(spark: SparkSession, folder: str, recursive: bool = False, decoders: dict[str, Callable[[bytes], tuple[int, np.ndarray]]] | None = None) -> DataFrame:
    """Rows (path, rec_id, rate, wave, error) of the sound files of a folder, channels averaged.

    ``decoders`` gives, by suffix, what makes rate and samples of a file's bytes; without them WAV files are
    read. The id is the path below the folder without its suffix, so equal names in different folders stay apart.
    A file that can't be read has an error and no wave.
    """
    by = decoders or DECODERS
    pattern = "*{" + ",".join(sorted({x for s in by for x in (s, s.upper())})) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(folder)
    root = re.sub(r"^[a-z0-9]+:/*(?=/)", "", folder).rstrip("/") + "/"

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b.path, b.content):
                rec, suffix = os.path.splitext(path.split(root, 1)[1] if root in path else os.path.basename(path))
                try:
                    rate, samples = by[suffix.lower()](content)
                    mono = np.asarray(samples, dtype=np.float32)
                    rows.append((path, rec, int(rate), (mono.mean(axis=1) if mono.ndim > 1 else mono).tolist(), None))
                except Exception as e:  # noqa: BLE001 - a bad file must not end the job
                    rows.append((path, rec, None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "rec_id", "rate", "wave", "error"]).astype({"rate": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, rec_id string, rate bigint, wave array<float>, error string")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows (folder) of a text log, one a line, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("folder")).where("folder <> ''")


def append_manifest(folders: DataFrame, path: str) -> None:
    """Finished folders written behind a log of them."""
    folders.select(F.col("folder").alias("value")).write.mode("append").text(path)


def to_do(all_: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``all_`` whose key isn't in ``done``; repeated rows and null keys stay."""
    return all_.join(done.select(F.col(key)).distinct(), key, "left_anti")


def logged_seconds(lines: DataFrame, key: list[str], line: str = "line", place: str = "place") -> DataFrame:
    """Rows (key, seconds): the last "Audio duration: x seconds" of each log, null for none."""
    found = F.regexp_extract(line, r"Audio duration:\s*([0-9.]+)\s*seconds", 1)
    return lines.groupBy(*key).agg(F.max_by(F.nullif(found, F.lit("")).try_cast("double"), F.when(found != "", F.col(place))).alias("seconds"))


#: One line of a diarizer: start, end and speaker, between white space.
LINE = r"^\s*(\S+)\s+(\S+)\s+[^_\s]*_(\d+)\s*$"


def diarization_rows(lines: DataFrame, line: str = "line", place: str = "place") -> DataFrame:
    """``lines`` with segment, label, speaker, s and e (ms) of "start end speaker_k" lines.

    ``place`` is the position within the recording, from 0; the label counts up from A by it.
    Lines that don't have that form are left out.
    """
    number = F.regexp_extract(line, LINE, 3)
    ms = [F.round(F.regexp_extract(line, LINE, i).try_cast("double") * 1000).cast("bigint") for i in (1, 2)]
    read = lines.where(F.col(line).rlike(LINE)).withColumn("s", ms[0]).withColumn("e", ms[1]).where("s IS NOT NULL AND e IS NOT NULL")
    return read.withColumn("segment", display_range("s", "e")).withColumn("label", F.char(F.lit(65) + F.col(place))).withColumn("speaker", speaker_name(number.cast("bigint")))


def _whole(text: Column, schema: str) -> Column:
    """A text that is JSON from end to end, else null."""
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {schema}", {"allowSingleQuotes": "false"})["v"]


def json_array(text: Column | str, schema: str) -> Column:
    """The array between the first [ and the last ] of a text; null if there is none or it isn't JSON."""
    return _whole(F.nullif(F.regexp_extract(col(text), r"(?s)\[.*\]", 0), F.lit("")), schema)


def json_block(text: Column | str, schema: str) -> Column:
    """The array of the first fenced json block, else of the whole text: as JSON, else as a Python literal, else empty."""
    block = F.regexp_extract(col(text), r"(?s)```json\s*(.*?)\s*```", 1)
    inner = F.when(col(text).rlike(r"(?s)```json\s*.*?\s*```"), block).otherwise(col(text))

    @F.pandas_udf("string")
    def literal(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return None if t is None else json.dumps(ast.literal_eval(t))
            except Exception:  # noqa: BLE001 - anything else isn't a literal
                return None

        return s.map(one)

    parsed = _whole(inner, schema)
    again = F.when(parsed.isNull(), inner)
    return F.coalesce(parsed, _whole(literal(again), schema), F.array().cast(T._parse_datatype_string(schema)))
