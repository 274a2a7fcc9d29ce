"""Names in labels matched with the speakers of their recording, by rosters of all transcripts."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseg.functions.speakers import alias_keys

#: Least similarity (1 - edit distance / longer length) of a label and a name.
SIMILAR = 0.8
#: Sounds of a phonetic code.
SOUNDS = 4

# fixed values: Cyrillic letters by the Latin letter of the nearest sound
_CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґў", "abvgdezziiklmnoprstufkcccchyheuaiiegu", strict=True))
# fixed values: groups of consonants that sound alike; vowels and h, w and y have no sound of their own
_ALIKE = {letter: group[0] for group in ("bfpv", "cgjkqsxz", "dt", "l", "mn", "r") for letter in group}
_SILENT = frozenset("aeiouhwy" + "اويىةهءأإآ" + "ぁあぃいぅうぇえぉおーっゃゅょ")


def sound_code(word: str) -> str:
    """What a word sounds like: its consonants by groups, at most ``SOUNDS``, a vowel only where it begins.

    Marks above and below letters don't count; Cyrillic letters are taken by their Latin counterparts, katakana as
    hiragana, Hangul by its consonants, Devanagari and Arabic without vowels; letters of other scripts are sounds of
    their own. A word without sounds is its own code.
    """
    out = ""
    for c in unicodedata.normalize("NFKD", word.lower()):
        if not unicodedata.category(c).startswith("L"):
            continue
        if "ァ" <= c <= "ヶ":
            c = chr(ord(c) - 0x60)
        c = _CYRILLIC.get(c, c)
        vowel = c in _SILENT or "ᅡ" <= c <= "ᅵ" or "ऄ" <= c <= "औ"
        sound = ("a" if not out else "") if vowel else _ALIKE.get(c, c)
        if sound and not out.endswith(sound):
            out += sound
    return out[:SOUNDS] or word


def coded(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``code``: a row for each code of the first and the last word of ``name``."""
    columns = df.columns
    at = columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [sorted({sound_code(words[0]), sound_code(words[-1])}) for words in (n.split(" ") for n in b.column(at).to_pylist())]
            of = pa.array([i for i, own in enumerate(codes) for _ in own], type=pa.int32())
            rows = [c.take(of) for c in b.columns]
            yield pa.RecordBatch.from_arrays([*rows, pa.array([c for own in codes for c in own], type=pa.string())], names=[*columns, "code"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, code string")


def nicknames(names: DataFrame) -> DataFrame:
    """Rows (full, short): names of one speaker in some transcript, the longest of them and another.

    ``names`` as ``alias_keys`` gives them. This is the roster across transcripts: a short form that one
    recording lists is known in all that have the full name.
    """
    longest = names.groupBy("rec_id", "alias_speaker").agg(F.max(F.struct(F.length("alias_key").alias("n"), F.col("alias_key").alias("k")))["k"].alias("full"))
    pairs = names.join(longest, ["rec_id", "alias_speaker"]).where("full <> alias_key")
    return pairs.select("full", F.col("alias_key").alias("short")).distinct()


def cheapest(cost: np.ndarray) -> list[int]:
    """Column of each row in the assignment of least total cost; -1 for rows left over.

    Shortest augmenting paths with potentials, O(rows squared times columns).
    """
    n, m = cost.shape
    if n > m:
        turned = cheapest(cost.T)
        out = [-1] * n
        for j, i in enumerate(turned):
            if i >= 0:
                out[i] = j
        return out
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while True:
            used[j0] = True
            free = ~used[1:]
            reduced = cost[match[j0] - 1] - u[match[j0]] - v[1:]
            better = free & (reduced < least[1:])
            least[1:][better], way[1:][better] = reduced[better], j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[1:][free] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def settled(pairs: list[tuple[str, str, str, float]]) -> list[tuple[str, str]]:
    """(label, speaker) of a block's pairs (label, name, speaker, likeness).

    Labels that are most like one name are spellings of it and stay together; one that is equally like two stays by itself.
    These groups and the speakers meet in the assignment of least total distance, one group to one speaker. A group
    left over is another spelling of the speaker that it is most like. Where two speakers are equally like and no
    group competes for the other, it is nobody's.
    """
    names: dict[str, dict[str, float]] = {}
    like: dict[str, dict[str, float]] = {}
    for label, name, who, likeness in pairs:
        for key, of in ((name, names), (who, like)):
            own = of.setdefault(label, {})
            own[key] = max(own.get(key, 0.0), likeness)
    most = lambda own: [k for k, x in own.items() if x >= max(own.values()) - 1e-9]
    groups: dict[tuple, list[str]] = {}
    for label in sorted(names):
        nearest = most(names[label])
        groups.setdefault(("name", nearest[0]) if len(nearest) == 1 else ("label", label), []).append(label)
    keys, speakers = sorted(groups), sorted({who for own in like.values() for who in own})
    cost = np.ones((len(keys), len(speakers)))
    for i, k in enumerate(keys):
        for j, who in enumerate(speakers):
            cost[i, j] = 1 - np.mean([like[label].get(who, 0.0) for label in groups[k]])
    met = {i: speakers[j] for i, j in enumerate(cheapest(cost)) if j >= 0 and cost[i, j] <= 1 - SIMILAR + 1e-9}
    out = []
    for i, k in enumerate(keys):
        taken = {who for other, who in met.items() if other != i}
        for label in groups[k]:
            best = most(like[label])
            free = [who for who in best if who not in taken]
            who = met[i] if met.get(i) in like[label] else best[0]
            if len(best) == 1 or who in best and len(free) == 1 and who == free[0] or who not in best:
                out.append((label, who))
    return out


def _assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Assignments block by block, whose pairs come together; one block is in memory at a time."""

    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(b.rec_id, b.code, b.label, b.name, b.who, b.likeness)

    for (rec, _), group in groupby(rows(), key=lambda r: r[:2]):
        yield pd.DataFrame([(rec, *r) for r in settled([r[2:] for r in group])], columns=["rec_id", "label", "who"])


def assign_labels(labels: DataFrame, alias: DataFrame) -> DataFrame:
    """Rows (rec_id, label, who): the speaker that each label of a recording means.

    ``labels`` has (rec_id, label), keys by ``label_key``; repeated rows count once. A label that is a name of
    its recording is that speaker. Any other is compared, by its phonetic codes, with the names of its recording and
    the short forms that any transcript gives for them; where a transcript lists the label itself with short forms,
    these are compared, too. Pairs of at least ``SIMILAR`` are settled block by block (``settled``), all pairs of
    a label in the first of its blocks. Labels that are like no name, or equally like two speakers, have no row.
    Null and empty labels are left out; empty tables give an empty table.

    A block is a code within a recording, so a recording with most of the rows is spread over its codes, and only
    labels that are no name of it are compared at all.
    """
    names = alias_keys(alias)
    known = nicknames(names)
    asked = labels.where("rec_id IS NOT NULL AND label <> ''").select("rec_id", "label").distinct()
    own = names.select("rec_id", F.col("alias_key").alias("label"), F.col("alias_speaker").alias("who"))
    exact = asked.join(own, ["rec_id", "label"])
    rest = asked.join(own.select("rec_id").distinct(), "rec_id", "left_semi").join(own, ["rec_id", "label"], "left_anti")
    forms = own.withColumnRenamed("label", "name")
    short = forms.join(known, F.col("name") == F.col("full")).select("rec_id", F.col("short").alias("name"), "who")
    right = coded(forms.unionByName(short).distinct(), "name")
    said = rest.withColumn("form", F.col("label"))
    shorter = rest.join(known, F.col("label") == F.col("full")).select("rec_id", "label", F.col("short").alias("form"))
    left = coded(said.unionByName(shorter), "form")
    longer = F.greatest(F.length("form"), F.length("name"))
    pairs = (
        left.join(right, ["rec_id", "code"])
        .withColumn("likeness", 1 - F.levenshtein("form", "name") / longer)
        .where(F.col("likeness") >= SIMILAR)
        .groupBy("rec_id", "label", "name", "who")
        .agg(F.max("likeness").alias("likeness"), F.min("code").alias("code"))
        .withColumn("code", F.min("code").over(Window.partitionBy("rec_id", "label")))
    )
    sorted_pairs = pairs.repartition("rec_id", "code").sortWithinPartitions("rec_id", "code", "label", "name", "who")
    return exact.unionByName(sorted_pairs.mapInPandas(_assigned, "rec_id string, label string, who string"))
