"""Facts from headers, files in blocks and resampling in pieces."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechset.functions import audio
from speechset.functions.audio import encode_wav, extract_audio, resample_margin, resample_samples, resample_span, resampled_bounds
from speechset.sources.audio_blocks import read_audio_blocks, read_audio_headers
from speechset.sources.files import read_audio_files
from tests.conftest import rows


def _wav(values, rate, channels=1, kind=1, bits=16, before=b"", size=None):
    raw = values.tobytes()
    form = struct.pack("<HHIIHH", kind, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    body = b"WAVEfmt " + struct.pack("<I", 16) + form + before + b"data" + struct.pack("<I", len(raw) if size is None else size) + raw
    return b"RIFF" + struct.pack("<I", len(body)) + body


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(1)
    long = rng.uniform(-1, 1, 700_000).astype(np.float32)
    files = {
        "deep/long.wav": encode_wav(long, 24000),
        "stereo.wav": _wav(rng.integers(-9000, 9000, 2 * 5000).astype("<i2"), 16000, 2),
        "float.wav": _wav(rng.uniform(-1, 1, 4001).astype("<f4"), 48000, 1, 3, 32),
        "list.wav": _wav(np.zeros(90, "<i2"), 8000, before=b"LIST" + struct.pack("<I", 100_001) + b"x" * 100_002),
        "open.wav": _wav(np.zeros(70, "<i2"), 8000, size=0xFFFFFFFF),
        "cut.wav": _wav(np.zeros(70, "<i2"), 8000, size=1000),
        "empty.wav": encode_wav(np.zeros(0), 24000),
        "text.wav": b"hello, this is no audio at all",
        "no data.wav": _wav(np.zeros(0, "<i2"), 8000)[:36],
        "no rate.wav": _wav(np.zeros(9, "<i2"), 0),
    }
    for name, content in files.items():
        path = tmp_path / "clips" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "clips")


def test_headers_tell_lengths_without_samples(spark, folder):
    got = {r.path: r for r in read_audio_headers(spark, folder, tasks=3).collect()}
    facts = {p: (r.sampling_rate, r.channels, r.bits, r.n_frames) for p, r in got.items() if not r.error}
    assert facts == {
        "deep/long.wav": (24000, 1, 16, 700_000), "stereo.wav": (16000, 2, 16, 5000), "float.wav": (48000, 1, 32, 4001), "list.wav": (8000, 1, 16, 90),
        "open.wav": (8000, 1, 16, 70), "cut.wav": (8000, 1, 16, 70), "empty.wav": (24000, 1, 16, 0),
    }
    assert got["deep/long.wav"].seconds == 700_000 / 24000
    assert max(r.header_bytes for r in got.values()) < 100 < 1_000_000 < got["deep/long.wav"].length
    assert {p for p, r in got.items() if r.error} == {"text.wav", "no data.wav", "no rate.wav"}
    assert "not a WAV file" in got["text.wav"].error and got["text.wav"].n_frames is None


@pytest.mark.parametrize("target", [None, 16000])
def test_blocks_are_the_whole_clip(spark, folder, target):
    blocks = read_audio_blocks(spark, folder, target, block_frames=30_000, tasks=4)
    whole = {r.path: r.audio for r in read_audio_files(spark, folder).where("audio IS NOT NULL").collect()}
    got = {}
    for r in sorted(blocks.where("error = ''").collect(), key=lambda r: (r.path, r.block)):
        at, parts = got.setdefault(r.path, (r.sampling_rate, []))
        assert r.first == sum(map(len, parts)) and at == r.sampling_rate
        parts.append(r.array)
    assert len(got["deep/long.wav"][1]) == 24 and got["empty.wav"][1] == [[]]
    for path in got:  # a clip whose size is wrong is read by headers only
        if path in whole:
            expected = np.asarray(whole[path].array, np.float32)
            expected = resample_samples(expected, whole[path].sampling_rate, target) if target else expected
            assert np.allclose(np.concatenate(got[path][1]), expected, atol=1e-6)
    assert set(whole) - set(got) == set()
    assert blocks.where("error <> ''").select("path").distinct().count() == 3
    assert blocks.where("error <> '' AND array IS NOT NULL").count() == 0


@pytest.mark.parametrize(("rate", "target"), [(24000, 16000), (44100, 16000), (16000, 24000), (8000, 44100)])
def test_spans_make_up_a_clip(rate, target, monkeypatch):
    x = np.random.default_rng(2).uniform(-1, 1, 5000).astype(np.float32)
    whole, parts = resample_samples(x, rate, target), []
    margin = resample_margin(rate, target)
    for first in range(0, 5000, 999):
        count = min(999, 5000 - first)
        low, high = max(0, first - margin), min(5000, first + count + margin)
        parts.append(resample_span(x[low:high], low, *resampled_bounds(first, count, rate, target), rate, target))
    assert np.allclose(np.concatenate(parts), whole, atol=1e-7)
    monkeypatch.setattr(audio, "RESAMPLE_STEP", 100)
    assert np.allclose(resample_samples(x, rate, target), whole, atol=1e-7)


def test_nested_channels_are_unpacked(spark):
    kind = "struct<array: array<array<float>>, sampling_rate: int>"
    df = spark.createDataFrame([(1, ([[0.5, 0.25]], 8000)), (2, ([[0.5], [0.25]], 8000)), (3, None)], f"k int, audio {kind}")
    got = df.select("k", extract_audio(df).alias("a"))
    assert rows(got.select("k", F.col("a.array"))) == [(1, [0.5, 0.25]), (2, None), (3, None)]
