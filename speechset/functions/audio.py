"""Audio columns: ``struct<array: array<float>, sampling_rate: int>``."""

from __future__ import annotations

import functools
import io
import math
import struct
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import Array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from speechset.constants import OUTPUT_RATE

AUDIO_TYPE = "struct<array: array<float>, sampling_rate: int>"


def audio_value(array: Column, rate: Column) -> Column:
    """Samples and rate as one value; null unless both are there."""
    value = F.struct(array.cast("array<float>").alias("array"), rate.cast("int").alias("sampling_rate"))
    return F.when(array.isNotNull() & rate.isNotNull(), value)


def extract_audio(df: DataFrame, column: str = "audio", rate_column: str | None = None) -> Column:
    """One audio value from either layout: a struct column, or an array column plus a rate column.

    A column of any other shape, or no column at all, gives null.
    """
    null = F.lit(None).cast(AUDIO_TYPE)
    if column not in df.columns:
        return null
    kind = df.schema[column].dataType
    if isinstance(kind, StructType) and {"array", "sampling_rate"} <= set(kind.names):
        return audio_value(_flat(F.col(column)["array"], kind["array"].dataType), F.col(column)["sampling_rate"])
    if isinstance(kind, ArrayType) and rate_column in df.columns:
        return audio_value(_flat(F.col(column), kind), F.col(rate_column))
    return null


def _flat(array: Column, kind: ArrayType) -> Column:
    """Samples as one list; a list of one channel is unpacked, and one of several is no clip."""
    nested = isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType)
    return F.when(F.size(array) == 1, mono(array)) if nested else array


def mono(channels: Column) -> Column:
    """``[[samples]]`` -> ``[samples]`` for one-channel audio."""
    return F.flatten(channels)


def sample_count(audio: Column) -> Column:
    """Samples in a clip, null for a missing one."""
    return F.when(audio["array"].isNotNull(), F.size(audio["array"])).cast("bigint")


def has_samples(audio: Column) -> Column:
    return F.coalesce((F.size(audio["array"]) > 0) & audio["sampling_rate"].isNotNull(), F.lit(False))


def clip_seconds(audio: Column) -> Column:
    return sample_count(audio) / audio["sampling_rate"]


def pad_missing(audio: Column, rate: int = OUTPUT_RATE) -> Column:
    """A single zero sample where there is no clip."""
    silence = F.struct(
        F.array(F.lit(0.0)).cast("array<float>").alias("array"), F.lit(rate).cast("int").alias("sampling_rate")
    )
    return F.coalesce(audio, silence)


def declare_audio(df: DataFrame, column: str, rate: int | None = None) -> DataFrame:
    """Cast a column to the audio type and note its rate in the column metadata."""
    typed = df.withColumn(column, F.col(column).cast(AUDIO_TYPE))
    return typed.withMetadata(column, {"audio": True, "sampling_rate": rate} if rate else {"audio": True})


def resampled_length(n: Column, rate: Column, target: int) -> Column:
    return F.ceil(n * F.lit(target) / rate).cast("bigint")


# Output samples of one matrix product: its windows are copied, so this bounds the memory of a long clip.
RESAMPLE_STEP = 1 << 14


@functools.lru_cache(maxsize=16)
def _polyphase(rate: int, target: int, zero_crossings: int) -> tuple[int, int, int, np.ndarray]:
    """``up, down, half`` and a Hann-windowed sinc filter of ``2 * half`` taps for each of ``up`` phases. Output sample i sits
    at input position i * down / up; all i with the same i % up share one filter."""
    g = math.gcd(rate, target)
    up, down = target // g, rate // g
    cutoff = min(1.0, target / rate)
    half = math.ceil(zero_crossings / cutoff)
    frac = (np.arange(up) * down % up / up)[:, None]
    t = np.arange(-half + 1, half + 1)[None, :] - frac
    taps = cutoff * np.sinc(cutoff * t) * (0.5 + 0.5 * np.cos(np.pi * t / half))
    return up, down, half, taps / taps.sum(axis=1, keepdims=True)


def resample_margin(rate: int, target: int, zero_crossings: int = 32) -> int:
    """Input samples on either side of a block that its output samples need."""
    return _polyphase(rate, target, zero_crossings)[2] + 1


def resampled_bounds(first: int, count: int, rate: int, target: int) -> tuple[int, int]:
    """The output samples that sit at the input samples ``first`` up to ``first + count``."""
    g = math.gcd(rate, target)
    up, down = target // g, rate // g
    return -(-first * up // down), -(-(first + count) * up // down)


def resample_span(
    x: np.ndarray, offset: int, start: int, stop: int, rate: int, target: int, zero_crossings: int = 32
) -> np.ndarray:
    """Output samples ``start`` up to ``stop`` of a clip, from a block of it that begins at input sample ``offset``; what
    the block lacks counts as silence."""
    up, down, half, taps = _polyphase(rate, target, zero_crossings)
    x = np.asarray(x)
    out = np.empty(max(stop - start, 0), np.float32)
    for at in range(start, stop, max(RESAMPLE_STEP, up)):
        end = min(stop, at + max(RESAMPLE_STEP, up))
        low, high = at * down // up - half + 1, (end - 1) * down // up + half + 1
        piece = np.zeros(high - low)
        a, b = max(low, offset), min(high, offset + len(x))
        if a < b:
            piece[a - low : b - low] = x[a - offset : b - offset]
        windows = np.lib.stride_tricks.sliding_window_view(piece, 2 * half)
        for phase in range(up):
            first = at + (phase - at) % up
            if first >= end:
                continue
            count = len(range(first, end, up))
            begin = first * down // up - half + 1 - low
            out[first - start : end - start : up] = windows[begin : begin + (count - 1) * down + 1 : down] @ taps[phase]
    return out


def resample_samples(x: np.ndarray, rate: int, target: int, zero_crossings: int = 32) -> np.ndarray:
    """Hann-windowed sinc interpolation; output length is ``ceil(len * target / rate)``."""
    x = np.asarray(x, dtype=np.float32)
    if rate == target or len(x) == 0:
        return x
    return resample_span(x, 0, *resampled_bounds(0, len(x), rate, target), rate, target, zero_crossings)


def resample_audio(audio: Column, target: int) -> Column:
    """Bring a clip to ``target`` Hz. Clips that have it already never leave the JVM."""

    @F.arrow_udf("array<float>")
    def resample(arrays: Array, rates: Array) -> Array:
        changed = [
            resample_samples(clip.values.to_numpy(zero_copy_only=False), rate.as_py(), target) if clip.is_valid else None
            for clip, rate in zip(arrays, rates)
        ]
        return pa.array(changed, type=pa.list_(pa.float32()))

    differs = audio["sampling_rate"] != target
    changed = resample(F.when(differs, audio["array"]), F.when(differs, audio["sampling_rate"]))
    array = F.when(differs, changed).otherwise(audio["array"])
    return audio_value(array, F.when(audio["sampling_rate"].isNotNull(), F.lit(target)))


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit PCM; samples beyond full scale are clipped."""
    pcm = np.rint(np.clip(np.asarray(samples, dtype=np.float64), -1.0, 1.0) * 32767).astype("<i2")
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as out:
        out.setnchannels(1)
        out.setsampwidth(2)
        out.setframerate(int(rate))
        out.writeframes(pcm.tobytes())
    return buffer.getvalue()


def _wav_chunks(content: bytes) -> tuple[bytes, bytes]:
    """The format and the data chunk of a WAV file."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise wave.Error("not a WAV file")
    found, at = {}, 12
    while at + 8 <= len(content) and not {b"fmt ", b"data"} <= found.keys():
        name, size = content[at : at + 4], int.from_bytes(content[at + 4 : at + 8], "little")
        found[name] = content[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if not {b"fmt ", b"data"} <= found.keys():
        raise wave.Error("a WAV file without format or data")
    return found[b"fmt "], found[b"data"]


def decode_wav(content: bytes, mix: bool = True) -> tuple[np.ndarray, int, int]:
    """Samples in -1..1, rate and channel count of a WAV file of whole numbers or floats, plain or
    extensible. Several channels are mixed to their mean, or with ``mix=False`` stay side by side as
    rows of (frames, channels)."""
    head, raw = _wav_chunks(content)
    kind, channels, rate, bits = wav_format(head)
    return decode_frames(raw, kind, channels, bits, mix), rate, channels


def wav_format(head: bytes) -> tuple[int, int, int, int]:
    """Kind of values, channels, rate and bits a value from a format chunk."""
    kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", head)
    if kind == 0xFFFE:  # extensible: the real format stands first in the sub-format
        kind = int.from_bytes(head[24:26], "little")
    if not channels or not rate or bits < 8:
        raise wave.Error(f"WAV format of {channels} channels, {rate} Hz and {bits} bits")
    return kind, channels, rate, bits


def decode_frames(raw: bytes, kind: int, channels: int, bits: int, mix: bool = True) -> np.ndarray:
    """Samples in -1..1 of whole frames."""
    width = bits // 8
    raw = raw[: len(raw) // (width * channels) * (width * channels)]
    if kind == 3 and width in (4, 8):
        values = np.frombuffer(raw, f"<f{width}").astype(np.float32)
    elif kind != 1 or width not in (1, 2, 3, 4):
        raise wave.Error(f"WAV format {kind} with {bits} bits")
    elif width == 1:
        values = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128.0) / 128.0
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        signed = (parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16) << 8 >> 8
        values = signed.astype(np.float32) / float(1 << 23)
    else:
        values = np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    if channels > 1:
        values = values.reshape(-1, channels)
        values = values.mean(axis=1, dtype=np.float64).astype(np.float32) if mix else values
    return values.astype(np.float32)


def decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path, content`` -> ``path, array, sampling_rate, channels, error``; a bad file becomes an
    error, not a failure."""
    for batch in batches:
        arrays, rates, channels, errors = [], [], [], []
        for content in batch.column("content"):
            try:
                samples, rate, n_channels, error = *decode_wav(content.as_py()), ""
            except Exception as failure:
                samples, rate, n_channels, error = None, None, None, f"{type(failure).__name__}: {failure}"
            arrays.append(samples)
            rates.append(rate)
            channels.append(n_channels)
            errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("path"),
                pa.array(arrays, pa.list_(pa.float32())),
                pa.array(rates, pa.int32()),
                pa.array(channels, pa.int32()),
                pa.array(errors, pa.string()),
            ],
            names=["path", "array", "sampling_rate", "channels", "error"],
        )
