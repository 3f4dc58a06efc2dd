"""Signals as arrays of doubles: levels, gain, frames, runs, trimming and flags, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import let

# Floors, ceilings and levels of the checks.
POWER_FLOOR, LEVEL_FLOOR = 1e-12, 1e-12
INPUT_PEAK, NEAR_SILENCE = 0.999, -50.0


def mean(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)


def to_mono(channels: Column) -> Column:
    """Mean over the channels of an array of frames."""
    return F.transform(channels, mean)


def from_int16(x: Column) -> Column:
    return F.transform(x, lambda v: v / 32768.0)


def without_offset(x: Column) -> Column:
    return let(mean(x), lambda m: F.transform(x, lambda v: v - m))


def peak(x: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(x, F.abs)), F.lit(0.0))


def rms(x: Column) -> Column:
    return F.when(F.size(x) == 0, 0.0).otherwise(F.sqrt(mean(F.transform(x, lambda v: v * v))))


def dbfs(level: Column) -> Column:
    """Decibels of a level; null for silence."""
    return F.when(level > 0, 20 * F.log10(level))


def clamped_dbfs(level: Column) -> Column:
    return 20 * F.log10(F.greatest(level, F.lit(LEVEL_FLOOR)))


def gain(x: Column, method: str, target_db: float, ceiling_db: float = -1.0) -> Column:
    """The factor that brings peak or rms to a target, held so that no sample passes the ceiling; 1 for silence."""
    level = {"peak": peak, "rms": rms}.get(method)
    if level is None:
        raise ValueError(f"unknown method {method!r}: peak or rms")
    wanted = 10 ** (target_db / 20) / level(x)
    return F.when(level(x) <= 0, 1.0).otherwise(F.least(wanted, 10 ** (ceiling_db / 20) / peak(x)))


def scaled(x: Column, factor: Column) -> Column:
    return let(factor, lambda f: F.transform(x, lambda v: v * f))


def frames(x: Column, frame: int, hop: int) -> Column:
    """Slices of frame samples each hop samples apart; a shorter signal is one frame."""
    last = lambda y: F.when(F.size(y) < frame, 0).otherwise(F.floor((F.size(y) - frame) / hop)).cast("int")
    return let(x, lambda y: F.transform(F.sequence(F.lit(0), last(y)), lambda i: F.slice(y, i * hop + 1, frame)))


def frame_rms(x: Column, frame: int, hop: int, floor: float = POWER_FLOOR) -> Column:
    return F.transform(frames(x, frame, hop), lambda f: F.sqrt(mean(F.transform(f, lambda v: v * v)) + floor))


def active_share(levels: Column, floor_db: float = -45.0) -> Column:
    """Share of the frames over a tenth of the loudest one and over the floor."""
    bar = F.greatest(F.array_max(levels) * 0.1, F.lit(10 ** (floor_db / 20)))
    return let(bar, lambda b: F.size(F.filter(levels, lambda v: v > b)) / F.size(levels))


def longest_run(x: Column, level: float) -> Column:
    """Longest run of samples at or over a level."""
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, v: Column) -> Column:
        run = F.when(F.abs(v) >= level, acc["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(x, start, step, lambda acc: acc["best"])


def clipped_share(x: Column, level: float) -> Column:
    return F.size(F.filter(x, lambda v: F.abs(v) >= level)) / F.size(x)


def percentile(x: Column, share: float) -> Column:
    """Linear interpolation between the two nearest ranks."""

    def pick(s: Column) -> Column:
        at = (F.size(s) - 1) * F.lit(share)
        low = F.floor(at).cast("int")
        a, b = F.get(s, low), F.get(s, F.least(low + 1, F.size(s) - 1))
        return a + (b - a) * (at - low)

    return let(F.array_sort(x), pick)


def tail_ratio(levels: Column, tail: int = 6) -> Column:
    """Mean level of the last frames over the 95th percentile of all; null for fewer than three frames."""
    last = F.slice(levels, F.greatest(F.size(levels) - tail + 1, F.lit(1)), tail)
    return F.when(F.size(levels) >= 3, mean(last) / (percentile(levels, 0.95) + 1e-12))


def loud_span(x: Column, frame: int = 1024, hop: int = 256, below_db: float = 40.0) -> Column:
    """struct(first, last): samples from the first to the last loud frame; all of a signal without any."""
    whole = F.struct(F.lit(0).alias("first"), F.size(x).alias("last"))

    def span(levels: Column) -> Column:
        bar = F.array_max(levels) * 10 ** (-below_db / 20)
        loud = let(bar, lambda b: F.filter(F.sequence(F.lit(0), F.size(levels) - 1), lambda i: F.get(levels, i) >= b))
        cut = let(loud, lambda k: F.struct((F.array_min(k) * hop).alias("first"), F.least(F.size(x), F.array_max(k) * hop + frame).alias("last")))
        return F.when(F.array_max(levels) <= 0, whole).otherwise(cut)

    return F.when(F.size(x) < frame, whole).otherwise(let(frame_rms(x, frame, hop, 0.0), span))


def clip_flags(raw_peak: Column, source_rate: Column, target_rate: int, seconds: Column, most_seconds: float, level_db: Column) -> Column:
    """What was noticed or done to a clip; level_db is measured before any gain, null for silence."""
    return F.array_compact(F.array(
        F.when(raw_peak >= INPUT_PEAK, "input_clipped"),
        F.when(source_rate < target_rate, "resampled_up").when(source_rate > target_rate, "resampled_down"),
        F.when(F.lit(most_seconds > 0) & (seconds > most_seconds), "truncated_to_max"),
        F.when(F.coalesce(level_db < NEAR_SILENCE, F.lit(True)), "near_silence"),
    ))


def sound_ok(x: Column) -> Column:
    """Post-conditions of a written clip: samples, finite, within full scale."""
    return (F.size(x) > 0) & F.forall(x, lambda v: ~F.isnan(v) & (F.abs(v) <= 1 + 1e-6))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)
