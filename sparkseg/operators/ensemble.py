"""Several transcripts of a segment made one by voting word by word."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean similarity from which a transcript is trusted.
TRUSTED = 0.3
#: Words looked back on for a word that comes too often, and how often that is.
RECENT, OFTEN = 3, 2


def similarity(a: list[str], b: list[str]) -> float:
    """Share of distinct words in common; 0 if either has none."""
    left, right = set(a), set(b)
    return len(left & right) / len(left | right) if left and right else 0.0


def trusted(words: list[list[str]]) -> set[int]:
    """Transcripts alike enough to the others; if none is, the two most alike, earlier ones first."""
    means = [sum(similarity(w, o) for j, o in enumerate(words) if j != i) / max(1, len(words) - 1) for i, w in enumerate(words)]
    enough = {i for i, m in enumerate(means) if m >= TRUSTED}
    return enough or set(sorted(range(len(words)), key=lambda i: -means[i])[:2])


def slots(words: list[list[str]]) -> list[list[str]]:
    """For each word of the longest transcript, itself and what the others have in its place.

    Of equally long ones the first is taken. Where others have fewer words, these are spread;
    where they have more, or words between, all go to the first, or nearest, place.
    """
    if len(words) < 2:
        return [[w] for w in (words[0] if words else [])]
    lead = max(range(len(words)), key=lambda i: (len(words[i]), -i))
    base = words[lead]
    net = [[w] for w in base]
    for k, other in enumerate(words):
        if k == lead or not net:
            continue
        for kind, a, b, c, d in SequenceMatcher(None, base, other).get_opcodes():
            wide, long = b - a, d - c
            if kind == "insert" or (kind == "replace" and long > wide):
                net[min(a, len(net) - 1)] += other[c:d]
            elif kind in ("equal", "replace"):
                for i in range(wide):
                    net[a + i].append(other[c + i * long // wide])
    return net


def vote_by_slots(transcripts: list[str | None]) -> str:
    """Vote of the trusted candidates in each slot, without words that come again and again.

    Blank transcripts don't count; none give an empty text, one gives itself. The first
    candidate always votes; the i-th of the others votes if transcript i is trusted. Of equal
    counts the first seen wins. A word seen ``OFTEN`` times in the last ``RECENT`` gives way to the
    runner-up, or the slot is skipped; a winner without half the votes gives way to the first
    candidate unless that one repeats.
    """
    given = [t.strip() for t in transcripts if t and t.strip()]
    if len(given) < 2:
        return given[0] if given else ""
    words = [t.split() for t in given]
    trust = trusted(words)
    out: list[str] = []

    def again(word: str) -> bool:
        return out[-RECENT:].count(word) >= OFTEN

    for slot in slots(words):
        votes = Counter(w for i, w in enumerate(slot) if i == 0 or i - 1 in trust)
        ranked = votes.most_common(2)
        word, count = ranked[0]
        if again(word):
            if len(ranked) == 1:
                continue
            word = ranked[1][0]
        if 2 * count < sum(votes.values()):
            if not again(slot[0]):
                word = slot[0]
            elif slot[0] == word:
                continue
        out.append(word)
    return " ".join(out)


def aligned(base: list[str], other: list[str]) -> list[tuple[str | None, str | None]]:
    """Pairs of words of both lists in order, None where one has no counterpart."""
    pairs: list[tuple[str | None, str | None]] = []
    for _, a, b, c, d in SequenceMatcher(None, base, other).get_opcodes():
        pairs += zip_longest(base[a:b], other[c:d])
    return pairs


def vote_by_first(transcripts: list[str | None]) -> str:
    """Vote place by place against the first transcript: two votes win, else the first's word stays.

    Places are those of each transcript's own alignment, so words put in shift what follows.
    Blank transcripts don't count; none give an empty text, one gives itself.
    """
    given = [t.strip() for t in transcripts if t and t.strip()]
    if len(given) < 2:
        return given[0] if given else ""
    base, *others = (t.split() for t in given)
    columns = [base, *([right for _, right in aligned(base, o)] for o in others)]
    out = []
    for place in zip_longest(*columns):
        votes = Counter(w for w in place if w)
        if votes:
            word, count = votes.most_common(1)[0]
            out.append(word if count > 1 or not place[0] else place[0])
    return " ".join(out)


def _voted(vote) -> object:
    @F.pandas_udf("string")
    def run(transcripts: pd.Series) -> pd.Series:
        return transcripts.map(lambda ts: "" if ts is None else vote(list(ts)))

    return run


def rover(transcripts: Column, by_first: bool = False) -> Column:
    """The voted text of an array of transcripts; Arrow batches, no shuffle.

    Null arrays give an empty text, null and blank members don't count.
    """
    return _voted(vote_by_first if by_first else vote_by_slots)(transcripts)
