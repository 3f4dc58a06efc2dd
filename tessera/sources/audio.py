"""Audio as columns: PCM WAV bytes to samples and back, in Arrow functions."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.models import resample

DECODED = T.StructType([
    T.StructField("samples", T.ArrayType(T.ArrayType(T.DoubleType()))), T.StructField("rate", T.IntegerType()),
    T.StructField("channels", T.IntegerType()), T.StructField("error", T.StringType()),
])


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Samples as (frames, channels) in -1 to 1, and their rate."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        data = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        data = (((b[:, 2] << 24) | (b[:, 1] << 16) | (b[:, 0] << 8)) >> 8) / float(1 << 23)
    else:
        data = np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))
    return data.reshape(-1, channels), rate


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit WAV; refuses what a listener would notice."""
    if not len(samples) or not np.isfinite(samples).all() or np.abs(samples).max() > 1 + 1e-6:
        raise ValueError("no samples, or samples that aren't finite or within full scale")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


@F.pandas_udf(DECODED)
def decoded(contents: pd.Series) -> pd.DataFrame:
    """Samples of WAV bytes; what can't be decoded has its error instead."""
    rows = []
    for content in contents:
        try:
            data, rate = decode_wav(content)
            if not len(data):
                raise ValueError("no samples")
            rows.append((data.tolist(), rate, data.shape[1], None))
        except Exception as e:  # the row fails, not the job
            rows.append((None, None, None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["samples", "rate", "channels", "error"])


def write_blobs(rows: DataFrame, folder: str, name: str, content: str, out: str) -> DataFrame:
    """Write each row's bytes to folder under its name, in place of column content; out is the file's path, null without bytes.

    folder must be one that driver and executors share; a task that runs again writes the same files again.
    """
    kept = [f for f in rows.schema.fields if f.name != content]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        fs.create_dir(root, recursive=True)
        for b in batches:
            paths = []
            for own, data in zip(b[name], b[content]):
                if data is not None:
                    with fs.open_output_stream(f"{root}/{own}") as target:
                        target.write(bytes(data))
                paths.append(None if data is None else f"{folder}/{own}")
            yield b[[f.name for f in kept]].assign(**{out: paths})

    return rows.mapInPandas(write, T.StructType([*kept, T.StructField(out, T.StringType())]))


def with_wav(rows: DataFrame, samples: str, own: str, rate: int, out: str) -> DataFrame:
    """Replace samples at their own rate by WAV bytes at rate, in column out; null if a clip isn't fit to write."""
    kept = [f for f in rows.schema.fields if f.name not in (samples, own)]

    def content(x, r):
        try:
            made = encode_wav(resample(np.asarray(x, dtype=float), int(r), rate), rate)
            with wave.open(io.BytesIO(made)) as back:
                return made if (back.getframerate(), back.getnchannels()) == (rate, 1) else None
        except (ValueError, TypeError):  # the row fails, not the job
            return None

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[f.name for f in kept]].assign(**{out: [content(x, r) for x, r in zip(b[samples], b[own])]})

    return rows.mapInPandas(write, T.StructType([*kept, T.StructField(out, T.BinaryType())]))
