"""Segments with what models add: captions, scores, and sounds without noise."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.models import per_sound
from sparkseg.functions.sound import standardised, windows
from sparkseg.functions.text import has_text, last_line
from sparkseg.functions.vectors import MOS_GENERAL, MOS_PERSONAL
from sparkseg.operators.segments import caption_context


def captioned(df: DataFrame, make: Callable[[], Callable], context: bool = False) -> DataFrame:
    """``df`` (with sound and rate) with ``caption``: the model's last line, empty where it failed.

    With ``context``, the model is also given the texts of up to two segments before.
    """
    rows = caption_context(df) if context else df.withColumn("context", F.array().cast("array<string>"))
    made = per_sound(rows, make, lambda m, r: str(m(np.asarray(r["sound"], dtype=np.float64), int(r["rate"]), list(r["context"]))), "__caption", "string")
    return made.withColumn("caption", F.coalesce(last_line("__caption"), F.lit(""))).drop("__caption", "context", "error")


def denoised(df: DataFrame, make: Callable[[], Callable]) -> DataFrame:
    """``df`` with ``clean``: the sound without noise of separated segments with text, null of all others and where the model failed."""
    due = F.coalesce(F.col("separated"), F.lit(False)) & F.col("sound").isNotNull() & has_text("text")
    rows = df.withColumn("__due", due)
    made = per_sound(rows, make, lambda m, r: [float(x) for x in m(np.asarray(r["sound"], dtype=np.float64), int(r["rate"]), r["text"])] if r["__due"] else None, "clean", "array<float>")
    return made.drop("__due", "error")


def scored(df: DataFrame, make: Callable[[], Callable], personal: bool = False) -> DataFrame:
    """``df`` with ``score``: means of raw and corrected scores over the analysis windows of a sound; null without windows."""
    table = MOS_PERSONAL if personal else MOS_GENERAL
    kinds = ("sig", "bak", "ovr")

    def use(model: Callable, r) -> dict | None:
        wave, rate = np.asarray(r["sound"], dtype=np.float64), int(r["rate"])
        raw = np.array([model(w, rate) for w in windows(wave, rate)], dtype=np.float64)
        if not len(raw):
            return None
        out = {"len_in_sec": len(wave) / rate, "sr": rate, "num_hops": len(raw)}
        for i, k in enumerate(kinds):
            out[f"{k}_raw"] = float(raw[:, i].mean())
            out[k] = float(np.polyval(table[k], raw[:, i]).mean())
        return out

    fields = ", ".join(f"{k}_raw:double, {k}:double" for k in kinds).replace(" ", "")
    return per_sound(df, make, use, "score", f"struct<len_in_sec:double,sr:int,num_hops:int,{fields}>")


def standard_sounds(df: DataFrame, target: int = 16_000) -> DataFrame:
    """``df`` (with wave and rate) with ``standard``: wave, rate and gain of each recording, standardised."""

    def use(_: Callable, r) -> dict:
        made = standardised(np.asarray(r["wave"], dtype=np.float64), int(r["rate"]), target)
        return {**made, "wave": made["wave"].tolist()}

    return per_sound(df, lambda: (lambda: None), use, "standard", "struct<wave:array<float>,rate:int,gain_db:double>")
