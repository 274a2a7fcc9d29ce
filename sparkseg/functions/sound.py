"""Sound as NumPy arrays: resampling, standardising, mel features."""

from __future__ import annotations

import numpy as np


def resampled(wave: np.ndarray, rate: int, target: int) -> np.ndarray:
    """The wave at another rate, by its spectrum; the same wave for the same rate, nothing for nothing."""
    if rate == target or not len(wave):
        return wave
    n = max(1, round(len(wave) * target / rate))
    spectrum = np.fft.rfft(wave)
    bins = n // 2 + 1
    fitted = np.zeros(bins, dtype=complex)
    fitted[: min(bins, len(spectrum))] = spectrum[: min(bins, len(spectrum))]
    return np.fft.irfft(fitted, n=n) * (n / len(wave))


def level_db(wave: np.ndarray) -> float:
    """Level against full scale; minus infinity for silence."""
    power = np.mean(np.square(wave, dtype=np.float64)) if len(wave) else 0.0
    return float(10 * np.log10(power)) if power > 0 else float("-inf")


def standardised(wave: np.ndarray, rate: int, target: int = 16_000, level: float = -20.0, most: float = 3.0) -> dict:
    """One channel at the target rate with its peak at 1, and the gain in dB towards ``level`` that was due.

    The gain is within ``most`` either way, 0 for silence, which stays as it is. Several channels
    (columns) are averaged.
    """
    mono = wave.mean(axis=1) if wave.ndim > 1 else wave
    x = resampled(np.asarray(mono, dtype=np.float64), rate, target)
    now = level_db(x)
    gain = 0.0 if now == float("-inf") else min(max(level - now, -most), most)
    top = np.max(np.abs(x), initial=0.0)
    return {"wave": (x / top if top > 0 else x).astype(np.float32), "rate": target, "gain_db": gain}


def tiled(wave: np.ndarray, least: int) -> np.ndarray:
    """The wave repeated by doubling until it has ``least`` samples; nothing stays nothing."""
    while 0 < len(wave) < least:
        wave = np.concatenate([wave, wave])
    return wave


def windows(wave: np.ndarray, rate: int, seconds: float = 9.01) -> list[np.ndarray]:
    """Analysis windows of a wave every second, as ``vectors.hop_starts`` counts them."""
    size = int(seconds * rate)
    long = tiled(wave, size)
    count = int(np.floor(len(long) / rate) - seconds) + 1
    return [w for i in range(count) if len(w := long[i * rate : i * rate + size]) == size]


def mel_features(wave: np.ndarray, rate: int, bands: int = 120, size: int = 321, hop: int = 160) -> np.ndarray:
    """Frames by bands: decibels of mel-spaced bands below the loudest, scaled to about -1 to 1."""
    padded = np.pad(wave, size // 2)
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] if len(padded) >= size else np.zeros((0, size))
    power = np.abs(np.fft.rfft(frames * np.hanning(size), axis=1)) ** 2
    to_mel, from_mel = lambda f: 2595 * np.log10(1 + f / 700), lambda m: 700 * (10 ** (m / 2595) - 1)
    edges = from_mel(np.linspace(0, to_mel(rate / 2), bands + 2))
    f = np.fft.rfftfreq(size, 1 / rate)
    up = (f[None] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - f[None]) / np.diff(edges)[1:, None]
    mel = power @ np.maximum(0, np.minimum(up, down)).T
    db = 10 * np.log10(np.maximum(mel, 1e-10) / max(mel.max(initial=0), 1e-10))
    return (np.maximum(db, -80) + 40) / 40
