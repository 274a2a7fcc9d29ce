"""Models as plug-ins: what each must give, stand-ins that need no weights, and how Spark runs them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Diarizer(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> list[str]:
        """Lines "start end speaker_k" in seconds."""


class SpeechDetector(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> list[tuple[int, int]]:
        """Stretches of speech in samples."""


class Recognizer(Protocol):
    def __call__(self, wave: np.ndarray, rate: int, language: str | None) -> dict:
        """text, language and, if known, words."""


class Embedder(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> np.ndarray | None: ...


class Separator(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]: ...


class Tagger(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> float:
        """Probability of music."""


class Vocals(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> np.ndarray | None: ...


class Scorer(Protocol):
    def __call__(self, wave: np.ndarray, rate: int) -> tuple[float, float, float]:
        """Raw signal, background and overall scores of one analysis window."""


class Captioner(Protocol):
    def __call__(self, wave: np.ndarray, rate: int, context: list[str]) -> str: ...


class Aligner(Protocol):
    def __call__(self, wave: np.ndarray, rate: int, text: str, language: str | None) -> list[tuple[str, float, float]]:
        """Words with their start and end in seconds of the sound."""


class Denoiser(Protocol):
    def __call__(self, wave: np.ndarray, rate: int, text: str) -> np.ndarray: ...


def energy_speech(wave: np.ndarray, rate: int, frame: float = 0.03, floor: float = 0.01) -> list[tuple[int, int]]:
    """Stand-in speech detector: runs of frames above a level."""
    step = max(1, int(frame * rate))
    loud = [np.sqrt(np.mean(np.square(wave[i : i + step], dtype=np.float64))) > floor for i in range(0, len(wave), step)]
    out, start = [], None
    for k, on in enumerate([*loud, False]):
        if on and start is None:
            start = k * step
        elif not on and start is not None:
            out.append((start, min(k * step, len(wave))))
            start = None
    return out


def energy_diarizer(wave: np.ndarray, rate: int) -> list[str]:
    """Stand-in diarizer: stretches of speech, low and high voices as two speakers."""
    lines = []
    for a, b in energy_speech(wave, rate):
        part = wave[a:b]
        crossings = np.count_nonzero(np.diff(np.signbit(part))) / max(1, len(part))
        lines.append(f"{a / rate:.3f} {b / rate:.3f} speaker_{int(crossings > 0.05)}")
    return lines


def band_embedding(wave: np.ndarray, rate: int, bands: int = 16, least: float = 0.5, window: float = 2.0) -> np.ndarray | None:
    """Stand-in embedding: energies of frequency bands of the middle of the sound; None if it is too short."""
    if len(wave) < least * rate:
        return None
    size = int(window * rate)
    if len(wave) > size:
        a = (len(wave) - size) // 2
        wave = wave[a : a + size]
    power = np.abs(np.fft.rfft(wave)) ** 2
    return np.array([np.log1p(p.sum()) for p in np.array_split(power, bands)])


def halves(wave: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Stand-in separator: the lower and the upper half of the spectrum."""
    full = np.fft.rfft(wave)
    low, high = full.copy(), full.copy()
    low[len(full) // 2 :] = 0
    high[: len(full) // 2] = 0
    return np.fft.irfft(low, n=len(wave)), np.fft.irfft(high, n=len(wave))


def spoken_digest(wave: np.ndarray, rate: int, language: str | None = None, seed: str = "") -> dict:
    """Stand-in recognizer: words drawn by a digest of the sound, the same for the same sound."""
    digest = hashlib.md5(seed.encode() + np.asarray(wave, dtype=np.float32).tobytes()).digest()
    words = ["one", "two", "three", "four", "five", "six", "seven", "eight"]
    return {"text": " ".join(words[b % 8] for b in digest[: 2 + len(wave) // max(1, rate)]), "language": language or "en", "words": None}


def no_music(wave: np.ndarray, rate: int) -> float:
    return 0.0


def same_sound(wave: np.ndarray, rate: int) -> np.ndarray:
    return wave


def same_text_sound(wave: np.ndarray, rate: int, text: str) -> np.ndarray:
    return wave


def even_words(wave: np.ndarray, rate: int, text: str, language: str | None) -> list[tuple[str, float, float]]:
    """Stand-in aligner: the words share the sound by their lengths."""
    words = text.split()
    edges = np.cumsum([0, *map(len, words)]) / max(1, sum(map(len, words))) * len(wave) / rate
    return [(w, float(a), float(b)) for w, a, b in zip(words, edges, edges[1:])]


def spelled(phrase: str) -> str:
    """Stand-in pronunciation: small letters between marks."""
    return f"<{phrase.lower()}>"


class Lazily:
    """A model that is made by its maker in the process that first calls it, and is never sent."""

    def __init__(self, make: Callable[[], Callable]):
        self.make, self.model = make, None

    def __getstate__(self) -> dict:
        return {"make": self.make, "model": None}

    def __call__(self, *given):
        if self.model is None:
            self.model = self.make()
        return self.model(*given)


def no_caption(wave: np.ndarray, rate: int, context: list[str]) -> str:
    return ""


@dataclass(frozen=True)
class Models:
    """Makers of the models of a pipeline: each is called once in a worker, then used for all its rows."""

    diarizer: Callable[[], Diarizer] = lambda: energy_diarizer
    detector: Callable[[], SpeechDetector] = lambda: energy_speech
    recognizers: tuple[Callable[[], Recognizer], ...] = field(default_factory=lambda: (lambda: spoken_digest,))
    embedder: Callable[[], Embedder] = lambda: band_embedding
    separator: Callable[[], Separator] = lambda: halves
    tagger: Callable[[], Tagger] = lambda: no_music
    vocals: Callable[[], Vocals] = lambda: same_sound
    captioner: Callable[[], Captioner] = lambda: no_caption
    denoiser: Callable[[], Denoiser] = lambda: same_text_sound
    aligner: Callable[[], Aligner] = lambda: even_words
    pronounce: Callable[[str], str] = spelled


def per_sound(df: DataFrame, make: Callable[[], Callable], use: Callable[[Callable, dict], object], out: str, kind: str) -> DataFrame:
    """``df`` with ``out``, what ``use(model, row)`` gives for each row, and ``error``.

    The model is made once per task. A row that fails gets a null and its error, and the
    others go on. Columns of ``df`` stay.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            values, errors = [], []
            names = list(b.columns)
            for given in zip(*[b[c] for c in names]):
                try:
                    values.append(use(model, dict(zip(names, given))))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one bad sound must not end the job
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield b.assign(**{out: pd.Series(values, index=b.index, dtype=object), "error": pd.Series(errors, index=b.index, dtype=object)})

    return df.mapInPandas(run, f"{fields}, `{out}` {kind}, error string")


def is_music(probability: Column | str, above: float = 0.3) -> Column:
    """Strictly above the limit; false without a probability."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.coalesce(p > above, F.lit(False))
