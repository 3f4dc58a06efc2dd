"""Settings of the stages, as dataclasses, and the rules that a settings file must keep.

All faults are reported at once. Keys that no stage knows are warnings.
"""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field, fields
from typing import Any

NUMBER = (int, float)

# Defaults, bounds and choices of the settings.
LANGUAGES = {"hi": ["Hindi", "Devanagari"], "ml": ["Malayalam", "Malayalam"], "ta": ["Tamil", "Tamil"]}
LANG_MAP = {"hi": "hindi", "ml": "malayalam", "ta": "tamil"}


def bounded(default: Any, low: float | None = None, high: float | None = None, choices: tuple = (), filled: bool = False, kind: Any = None):
    about = {"low": low, "high": high, "choices": choices, "filled": filled, "kind": kind or (NUMBER if isinstance(default, float) else type(default))}
    if isinstance(default, (list, dict)):
        return field(default_factory=lambda: type(default)(default), metadata=about)
    return field(default=default, metadata=about)


@dataclass
class Acquisition:
    source: str = bounded("local", choices=("hf", "local"))
    local_dir: str = bounded("")
    repo_id: str = bounded("")
    split: str = bounded("valid")
    languages: list = bounded(["hindi", "malayalam", "tamil"], filled=True)
    speakers_per_language: int = bounded(10, 1)
    clips_per_speaker: int = bounded(4, 1)
    min_total_speakers: int = bounded(15, 1)
    gender_balance: bool = bounded(True)
    ref_min_dur: float = bounded(3.0, 0)
    ref_max_dur: float = bounded(15.0, 0)
    hf_token: str = bounded("")
    max_retries: int = bounded(3, 0)
    retry_backoff: float = bounded(2.0, 0)
    force_catalog: bool = bounded(False)


@dataclass
class Audio:
    target_sr: int = bounded(24000, 1)
    norm: str = bounded("peak", choices=("peak", "rms"))  # loudness in LUFS isn't measured here
    peak_dbfs: float = bounded(-1.0, high=0)
    rms_dbfs: float = bounded(-20.0, high=0)
    trim: bool = bounded(False)
    max_ref_sec: float = bounded(15.0, 0)


@dataclass
class Sentences:
    languages: dict = bounded(LANGUAGES, filled=True)
    topics: list = bounded(["daily life", "travel"], filled=True)
    sentence_types: list = bounded(["statement", "question"], filled=True)
    per_cell_quota: int = bounded(13, 1)
    sentences_per_call: int = bounded(12, 1)
    max_attempts_per_cell: int = bounded(8, 1)
    min_words: int = bounded(5, 1)
    max_words: int = bounded(20, 1)
    script_min_ratio: float = bounded(0.90, 0, 1)
    min_type_token_ratio: float = bounded(0.55, 0, 1)
    near_dup_threshold: float = bounded(0.92, 0, 1)
    langid_min_conf: float = bounded(0.50, 0, 1)
    reject_unnormalized_numbers: bool = bounded(True)
    base_seed: int = bounded(1234, 0)


@dataclass
class Speech:
    target_sr: int = bounded(24000, 1)
    max_chars: int = bounded(300, 1)
    lang_map: dict = bounded(LANG_MAP, filled=True)


@dataclass
class Quality:
    cer_max: float = bounded(0.15, 0, 1)
    spk_cos_min: float = bounded(0.60, -1, 1)
    dur_per_char_min: float = bounded(0.04, 0)
    dur_per_char_max: float = bounded(0.30, 0)
    silence_rms_dbfs: float = bounded(-45.0, high=0)
    silence_active_frac_min: float = bounded(0.10, 0, 1)
    clip_sample_thresh: float = bounded(0.99, 0, 1)
    clip_frac_max: float = bounded(1e-3, 0, 1)
    clip_run_max: int = bounded(8, 0)
    trunc_tail_ms: float = bounded(60.0, 0)
    trunc_tail_ratio: float = bounded(0.60, 0)
    loop_min_lag_s: float = bounded(0.30, 0)
    loop_pair_sim: float = bounded(0.99, 0, 1)
    loop_band_frac: float = bounded(1.01, 0)  # over 1 turns the check off
    text_repeat_ngram: int = bounded(3, 1)
    run_asr: bool = bounded(True)
    run_speaker: bool = bounded(True)


SECTIONS = {
    "data_acquisition": Acquisition, "audio_engineering": Audio, "sentence_generation": Sentences, "tts_generation": Speech, "quality_control": Quality,
}
#: (section, smaller, larger, may they be equal)
ORDERED = [
    ("data_acquisition", "ref_min_dur", "ref_max_dur", False), ("quality_control", "dur_per_char_min", "dur_per_char_max", False),
    ("sentence_generation", "min_words", "max_words", True),
]


def is_kind(value: Any, kind: Any) -> bool:
    """A truth value is a number to Python, but not to a setting."""
    return isinstance(value, kind) and (kind is bool or not isinstance(value, bool))


def faults(raw: dict[str, Any]) -> tuple[list[str], list[str]]:
    """All errors and warnings of a settings document."""
    errors, warnings = [], []
    if "seed" in raw and not (is_kind(raw["seed"], int) and raw["seed"] >= 0):
        errors.append("seed: must be a whole number of at least 0")
    for name, section in raw.items():
        if name in ("seed", "out_dir"):
            continue
        if name not in SECTIONS or not isinstance(section, dict):
            warnings.append(f"{name}: no such section")
            continue
        known = {f.name: f.metadata for f in fields(SECTIONS[name])}
        warnings += [f"{name}.{k}: unknown" for k in section if k not in known and not (name == "sentence_generation" and k == "seed")]
        for key, value in section.items():
            about = known.get(key)
            if about is None or value is None:
                continue
            where = f"{name}.{key}"
            if not is_kind(value, about["kind"]):
                errors.append(f"{where}: {type(value).__name__} isn't allowed")
                continue
            if about["low"] is not None and value < about["low"]:
                errors.append(f"{where}: {value} is below {about['low']}")
            if about["high"] is not None and value > about["high"]:
                errors.append(f"{where}: {value} is above {about['high']}")
            if about["choices"] and value not in about["choices"]:
                errors.append(f"{where}: {value!r} isn't one of {list(about['choices'])}")
            if about["filled"] and not value:
                errors.append(f"{where}: must not be empty")
    sections = {k: v for k, v in raw.items() if isinstance(v, dict)}
    for name, low, high, equal in ORDERED:
        a, b = (sections.get(name, {}).get(k) for k in (low, high))
        if is_kind(a, NUMBER) and is_kind(b, NUMBER) and (a > b or a == b and not equal):
            errors.append(f"{name}.{low} ({a}) must be {'at most' if equal else 'under'} {high} ({b})")
    codes = sections.get("tts_generation", {}).get("lang_map")
    if isinstance(codes, dict) and len(set(codes.values())) < len(codes):
        errors.append("tts_generation.lang_map: two codes have one name")
    return errors, warnings


def stage(raw: dict[str, Any], name: str):
    """A section's settings: known keys that aren't null over the defaults."""
    kind, given = SECTIONS[name], dict(raw.get(name) or {})
    if name == "sentence_generation":
        given.setdefault("base_seed", given.pop("seed", None) or raw.get("seed"))
    known = {f.name for f in fields(kind)}
    out = kind(**{k: v for k, v in given.items() if k in known and v is not None})
    if name == "data_acquisition" and not out.hf_token:
        out.hf_token = os.environ.get("HF_TOKEN", "")
    return out


def public(settings: Any) -> dict[str, Any]:
    """Settings to show; secrets are masked."""
    return {k: ("***" if k.endswith("token") and v else v) for k, v in asdict(settings).items()}


def load(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
