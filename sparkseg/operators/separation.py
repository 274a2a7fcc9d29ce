"""Sound of overlapping segments taken apart, and music taken out, with models that are plugged in."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Separate = Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]]
Embed = Callable[[np.ndarray, int], np.ndarray | None]

SILENT = 1e-10


def level(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0


def at_level(x: np.ndarray, target: float) -> np.ndarray:
    """Samples at a level, clipped; silence as it is."""
    own = level(x)
    return x if own < SILENT else np.clip(x * (target / (own + SILENT)), -1.0, 1.0)


def alike(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return -1.0
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(np.dot(a, b) / size) if size else -1.0


def level_outside(wave: np.ndarray, span: tuple[int, int], overlaps: list[tuple[int, int]]) -> float | None:
    """Level of a span of samples without the overlaps in it; None if nothing audible is left."""
    keep = np.ones(max(0, span[1] - span[0]), dtype=bool)
    for a, b in overlaps:
        keep[max(0, a - span[0]) : max(0, b - span[0])] = False
    rest = wave[span[0] : span[1]][keep[: len(wave[span[0] : span[1]])]]
    found = level(rest)
    return found if len(rest) and found > SILENT else None


def repair(wave: np.ndarray, rate: int, spans: list[tuple[float, float, str]], separate: Separate, embed: Embed, least: float = 1.0, both: bool = False, all_separated: bool = False) -> list[dict]:
    """For each span (start, end, speaker), in order of start, its sound with overlaps taken apart.

    Each pair that shares ``least`` seconds is separated; the first source goes to the
    candidate whose reference it is more like, the other to the other one. A reference is
    the embedding of a speaker's first span of two seconds that overlaps no other. Parts are brought
    to the level of the mixture. With ``both``, each source is identified; if both are the same
    speaker's or unknown, the louder goes to the longer span; parts are brought to the speaker's
    level outside overlaps, or 0.7 of the mixture's. ``separated`` marks spans that got a part, or all
    with ``all_separated``.
    """
    cut = [(int(a * rate), int(b * rate)) for a, b, _ in spans]
    sound = [wave[a:b].astype(np.float64).copy() for a, b in cut]
    order = sorted(range(len(spans)), key=lambda i: spans[i][0])
    pairs = []
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if spans[j][0] >= spans[i][1]:
                break
            a, b = max(spans[i][0], spans[j][0]), min(spans[i][1], spans[j][1])
            if b - a >= least:
                pairs.append((i, j, int(a * rate), int(b * rate)))
    busy = {k for i, j, _, _ in pairs for k in (i, j)}
    reference: dict[str, np.ndarray] = {}
    for k, (a, b, who) in enumerate(spans):
        if k not in busy and b - a >= 2.0 and who not in reference:
            found = embed(wave[cut[k][0] : cut[k][1]], rate)
            if found is not None:
                reference[who] = found
    changed = [False] * len(spans)

    def identity(part: np.ndarray, names: tuple[str, str]) -> tuple[str, float]:
        v = embed(part, rate)
        rated = [(alike(v, reference.get(n)), -k, n) for k, n in enumerate(names)]
        sim, _, name = max(rated)
        return (name, sim) if sim > -1.0 else (names[0], -1.0)

    for i, j, a, b in pairs:
        mix = wave[a:b]
        one, two = separate(mix, rate)
        names = spans[i][2], spans[j][2]
        if both:
            (n1, s1), (n2, s2) = identity(one, names), identity(two, names)
            if n1 == n2 or min(s1, s2) <= -1.0:
                longer_first = cut[i][1] - cut[i][0] >= cut[j][1] - cut[j][0]
                louder_first = np.square(one).sum() >= np.square(two).sum()
                swap = longer_first != louder_first
            else:
                swap = n1 != names[0]
        else:
            swap = identity(one, names)[0] != names[0]
        parts = (two, one) if swap else (one, two)
        for k, part in zip((i, j), parts):
            target = level(mix)
            if both:
                own = level_outside(wave, cut[k], [(c, d) for x, y, c, d in pairs if k in (x, y)])
                target = own if own is not None else 0.7 * target
            part = at_level(part, target)
            at = a - cut[k][0]
            n = min(len(part), len(sound[k]) - at)
            if n > 0:
                sound[k][at : at + n] = part[:n]
                changed[k] = True
    return [{"sound": s.astype(np.float32), "separated": c or all_separated, "repaired": c} for s, c in zip(sound, changed)]


def repair_overlaps(recordings: DataFrame, separate: Separate, embed: Embed, least: float = 1.0, both: bool = False) -> DataFrame:
    """Rows (rec_id, seg_id, sound, separated) of each segment of recordings.

    ``recordings`` has (rec_id, rate, wave ARRAY<FLOAT>, spans ARRAY<STRUCT<seg_id, s, e,
    speaker>>) with times in ms. The sound of a recording is needed whole, so a recording is a row
    of one narrow Arrow stage; nothing is shuffled.
    """

    def run(batches):
        for b in batches:
            for rec, rate, wave, spans in zip(b.rec_id, b.rate, b.wave, b.spans):
                if wave is None or spans is None:
                    continue
                spans = [x for x in spans if x is not None]
                made = repair(np.asarray(wave, dtype=np.float64), int(rate), [(x["s"] / 1000, x["e"] / 1000, x["speaker"]) for x in spans], separate, embed, least, both)
                yield pd.DataFrame({"rec_id": rec, "seg_id": [x["seg_id"] for x in spans], "sound": [m["sound"].tolist() for m in made], "separated": [m["separated"] for m in made]})

    return recordings.select("rec_id", "rate", "wave", "spans").mapInPandas(run, "rec_id string, seg_id bigint, sound array<float>, separated boolean")


def without_music(wave: np.ndarray, rate: int, spans: list[tuple[float, float]], music: Callable[[np.ndarray, int], float], vocals: Callable[[np.ndarray, int], np.ndarray | None], pad: float = 0.5, above: float = 0.3, least: int = 16_000) -> tuple[np.ndarray, list[bool]]:
    """The wave with music taken out of the spans that have it, and which those are.

    A span is looked at with ``pad`` seconds around it, if that makes at least ``least`` samples;
    it has music if the probability is above ``above``. The voices of the whole wave are taken
    once and cut out; if that fails, span by span; if that fails too, the sound stays.
    """
    out, flags, full, tried = wave.copy(), [], None, False
    for a, b in spans:
        i, j = int(max(0.0, a - pad) * rate), min(int((b + pad) * rate), len(wave))
        part = out[i:j]
        if len(part) < least or not music(part, rate) > above:
            flags.append(False)
            continue
        if not tried:
            full, tried = vocals(out, rate), True
        clean = full[i:j] if full is not None else vocals(part, rate)
        if clean is not None and len(clean):
            n = min(len(clean), j - i)
            out[i : i + n] = clean[:n]
        flags.append(True)
    return out, flags


def music_removed(recordings: DataFrame, music: Callable[[np.ndarray, int], float], vocals: Callable[[np.ndarray, int], np.ndarray | None], pad: float = 0.5, above: float = 0.3, least: int = 16_000) -> DataFrame:
    """Rows (rec_id, rate, wave, flags ARRAY<STRUCT<seg_id, music>>) of recordings (rec_id, rate, wave, spans) as in ``repair_overlaps``.

    A row is a recording, as its voices are taken from the whole; ``without_music`` says how. A recording without sound
    or spans stays as it is, without flags.
    """

    def run(batches):
        for b in batches:
            rows = []
            for rec, rate, wave, spans in zip(b.rec_id, b.rate, b.wave, b.spans):
                found = [x for x in spans if x is not None] if spans is not None else []
                flags = []
                if wave is not None and found:
                    out, has = without_music(np.asarray(wave, dtype=np.float64), int(rate), [(x["s"] / 1000, x["e"] / 1000) for x in found], music, vocals, pad, above, least)
                    wave, flags = out.astype(np.float32).tolist(), [{"seg_id": x["seg_id"], "music": m} for x, m in zip(found, has)]
                rows.append((rec, rate, wave, flags))
            yield pd.DataFrame(rows, columns=["rec_id", "rate", "wave", "flags"])

    return recordings.select("rec_id", "rate", "wave", "spans").mapInPandas(run, "rec_id string, rate bigint, wave array<float>, flags array<struct<seg_id:bigint,music:boolean>>")


def overlap_add(wave: np.ndarray, predict: Callable[[np.ndarray], np.ndarray], rate: int, seconds: float = 15.0, margin: float = 1.0, denoise: bool = False) -> np.ndarray:
    """A model run over pieces of ``seconds`` with ``margin`` on both sides, whose margins are cut off.

    ``denoise`` takes half the difference of the model's output for the sound and for its negative.
    """
    size, side = int(seconds * rate), min(int(margin * rate), int(seconds * rate))
    run = (lambda x: 0.5 * (predict(x) - predict(-x))) if denoise else predict
    out = []
    for a in range(0, len(wave), size):
        left, right = min(side, a), min(side, max(0, len(wave) - a - size))
        piece = run(wave[a - left : min(len(wave), a + size) + right])
        out.append(piece[left : len(piece) - right])
    return np.concatenate(out) if out else wave[:0]


def spectrum(wave: np.ndarray, size: int = 1024, hop: int = 256) -> np.ndarray:
    """Short-time spectrum, frames by bins, over the wave padded by half a frame."""
    padded = np.pad(wave, size // 2, mode="reflect" if len(wave) > size // 2 else "constant")
    n = 1 + max(0, len(padded) - size) // hop
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop][:n]
    return np.fft.rfft(frames * np.hanning(size + 1)[:-1], axis=1)


def from_spectrum(frames: np.ndarray, length: int, size: int = 1024, hop: int = 256) -> np.ndarray:
    """The wave of a short-time spectrum, by overlapping and adding its frames."""
    window = np.hanning(size + 1)[:-1]
    total = np.zeros(size + hop * (len(frames) - 1))
    weight = np.zeros_like(total)
    for k, frame in enumerate(np.fft.irfft(frames, n=size, axis=1)):
        total[k * hop : k * hop + size] += frame * window
        weight[k * hop : k * hop + size] += window**2
    wave = total / np.where(weight > 1e-8, weight, 1)
    return np.pad(wave[size // 2 : size // 2 + length], (0, max(0, length - max(0, len(wave) - size // 2))))
