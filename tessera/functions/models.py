"""Plug points for models, with stand-ins that need none.

A model is a function over a pandas Series. `plug` makes a column function of
it: the model is made once for each worker process, rows go through in Arrow
batches, and an exception on one row becomes that row's error, not the job's.
Results are handed on by their size, not when a batch is done, since a row of
text can make a row of sound of a hundred times its bytes.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


_MADE: dict[Callable, Callable] = {}


def loaded(make: Callable[[], Callable]) -> Callable:
    """make()'s model: made once for each worker process, if make is a function that a module has by name."""
    name = getattr(make, "__qualname__", "")
    if not name or getattr(sys.modules.get(make.__module__), name, None) is not make:
        return make()
    if make not in _MADE:
        _MADE[make] = make()
    return _MADE[make]


#: Numbers or characters of results that a worker holds before it hands them on; as Python's own numbers they take some 32 bytes each.
HELD = 1 << 19


def frame(values: list, errors: list) -> pd.DataFrame:
    return pd.DataFrame({"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})


def plug(make: Callable[[], Callable], kind: str):
    """A column function with result struct<value: kind, error: string>; make() loads the model."""

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loaded(make)
        for batch in batches:
            values, errors, held = [], [], 0
            for item in batch:
                try:
                    values.append(model(item))
                    errors.append(None)
                except Exception as e:  # one bad row is a failed row
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
                held += len(values[-1]) if hasattr(values[-1], "__len__") else 1
                if held >= HELD:
                    yield frame(values, errors)
                    values, errors, held = [], [], 0
            if len(values) or not len(batch):
                yield frame(values, errors)

    rows.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(rows, f"struct<value: {kind}, error: string>")


def stub_generator() -> Callable[[str], str]:
    """Lines that depend on the prompt alone."""

    def generate(prompt: str) -> str:
        words = ["alpha", "bravo", "carol", "delta", "ember", "frost", "gamma", "haven"]
        digest = hashlib.sha256(prompt.encode()).digest()
        return "\n".join(f"{i + 1}. " + " ".join(words[(digest[i] + 3 * k) % 8] for k in range(6)) for i in range(4))

    return generate


def stub_embedder(size: int = 64) -> Callable[[str], list[float]]:
    """Unit vectors of hashed words."""

    def encode(text: str) -> list[float]:
        v = np.zeros(size, dtype=np.float32)
        for w in (text or "").split():
            v[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % size] += 1
        return (v / max(float(np.linalg.norm(v)), 1e-9)).tolist()

    return encode


def stub_synthesizer(rate: int = 16000) -> Callable[[str], list[float]]:
    """A tone of 60 ms for each character."""

    def speak(text: str) -> list[float]:
        if not text:
            raise ValueError("nothing to say")
        n = int(rate * 0.06 * len(text))
        return (0.3 * np.sin(2 * np.pi * 220 * np.arange(n) / rate)).astype(np.float32).tolist()

    return speak


def stub_transcriber() -> Callable[[str], str]:
    """Hears what was meant, without its final sign."""
    return lambda text: text.rstrip(".!?")


#: What a language model answers: a label and how sure it is of it.
SAID = "struct<label: string, confidence: double>"
#: Frequent words of some languages, for the stand-in.
STOP_WORDS = {"de": {"der", "die", "und", "in", "ein"}, "en": {"the", "of", "and", "to", "is"}, "es": {"el", "que", "y", "los", "un"}, "fr": {"le", "et", "les", "des", "une"}}


def stub_language(labels: dict[str, set[str]] | None = None) -> Callable[[str], dict]:
    """The label with the most stop words in the text (ties go to the first by name), and its share of all labels' hits."""
    labels = labels or STOP_WORDS

    def vote(text: str) -> dict:
        words = text.split(" ")
        hits = {lab: sum(w in labels[lab] for w in words) for lab in sorted(labels)}
        best = max(hits, key=hits.get)
        return {"label": best, "confidence": hits[best] / max(1, sum(hits.values()))}

    return vote


def stub_speaker() -> Callable[[pd.Series], list[float]]:
    """A voice's vector: its spectrum in 32 bands, at unit length."""

    def encode(samples) -> list[float]:
        power = np.abs(np.fft.rfft(np.asarray(samples, dtype=float)))
        bands = np.array([b.sum() for b in np.array_split(power, 32)])
        return (bands / max(float(np.linalg.norm(bands)), 1e-9)).tolist()

    return encode


def looping_share(rate: int, least_lag: float, least_same: float) -> Callable[[list[float]], float]:
    """A signal's largest share, over all lags of at least least_lag seconds, of voiced frame pairs a lag apart with cepstra of a cosine over least_same.

    Frames are 25 ms long and 10 ms apart; a cepstrum is the cosine transform of
    the log energies of 26 bands, without its level. Lags go up to half the frames.
    """

    def share(samples) -> float:
        x = np.asarray(samples, dtype=float)
        size, hop = int(rate * 0.025), int(rate * 0.010)
        if len(x) < size:
            return 0.0
        frames = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
        level = np.sqrt((frames**2).mean(axis=1))
        power = np.abs(np.fft.rfft(frames * np.hanning(size), axis=1)) ** 2
        edges = np.unique(np.geomspace(1, power.shape[1] - 1, 27).astype(int))
        bands = np.log(np.add.reduceat(power, edges, axis=1) + 1e-10)
        n = bands.shape[1]
        turns = np.cos(np.pi / n * (np.arange(n) + 0.5)[:, None] * np.arange(1, 13)[None, :])
        cepstra = bands @ turns
        cepstra /= np.maximum(np.linalg.norm(cepstra, axis=1, keepdims=True), 1e-9)
        voiced, best = level > 0.1 * max(level.max(), 1e-9), 0.0
        for lag in range(max(1, int(least_lag / 0.010)), len(frames) // 2):
            both = voiced[lag:] & voiced[:-lag]
            if both.sum() >= 10:
                best = max(best, float(((cepstra[lag:] * cepstra[:-lag]).sum(axis=1)[both] > least_same).mean()))
        return best

    return share


def resample(y: np.ndarray, source: int, target: int) -> np.ndarray:
    """Band-limited enough for checks: box mean before a coarser grid, linear in between."""
    if source == target or not len(y):
        return y
    if target < source:
        width = max(1, round(source / target))
        y = np.convolve(y, np.ones(width) / width, mode="same")
    n = int(round(len(y) * target / source))
    return np.interp(np.arange(n) * source / target, np.arange(len(y)), y)
