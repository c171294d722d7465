import io
import struct
import wave

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechset.constants import ERROR_NO_AUDIO, ERROR_NO_TEXT
from speechset.functions.audio import (
    AUDIO_TYPE,
    declare_audio,
    decode_wav,
    encode_wav,
    extract_audio,
    mono,
    pad_missing,
    resample_audio,
    resample_samples,
    sample_count,
)
from speechset.functions.tokens import clone_prompt, count_codes, format_codes, guard_reference, parse_codes
from speechset.operators.validity import mark_errors
from tests.conftest import rows


def _audio(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, audio {AUDIO_TYPE}")


def test_validity_order_and_texts(spark):
    good = ([0.1], 24000)
    df = spark.createDataFrame(
        [(0, good, "x"), (1, None, ""), (2, ([], 24000), "x"), (3, (None, 24000), "x"), (4, ([0.1], None), "x"),
         (5, good, None), (6, good, "  \n"), (7, good, "")],
        f"i int, audio {AUDIO_TYPE}, text_fr string",
    )
    errors = dict(rows(mark_errors(df), "i", "error"))
    assert errors == {0: "", **{i: ERROR_NO_AUDIO for i in (1, 2, 3, 4)}, **{i: ERROR_NO_TEXT for i in (5, 6, 7)}}


def test_extract_other_shapes(spark):
    doubles = spark.createDataFrame([([0.5, 0.25], 8000)], "a array<double>, r bigint")
    assert doubles.select(extract_audio(doubles, "a", "r").alias("x")).schema["x"].dataType.simpleString() == "struct<array:array<float>,sampling_rate:int>"
    assert doubles.select(extract_audio(doubles, "a")).first()[0] is None
    text = spark.createDataFrame([("path.wav",)], "audio string")
    assert text.select(extract_audio(text)).first()[0] is None


def test_pad_and_count(spark):
    df = _audio(spark, ([0.1, 0.2], 16000), None, ([], 16000))
    assert rows(df.select("i", sample_count(F.col("audio")))) == [(0, 2), (1, None), (2, 0)]
    padded = df.select("i", pad_missing(F.col("audio")).alias("a")).select("i", F.size("a.array"), "a.sampling_rate")
    assert rows(padded) == [(0, 2, 16000), (1, 1, 24000), (2, 0, 16000)]


def test_declared_rate_is_in_the_metadata(spark):
    typed = declare_audio(_audio(spark, None), "audio", 24000)
    assert typed.schema["audio"].metadata == {"audio": True, "sampling_rate": 24000}


def test_mono(spark):
    df = spark.createDataFrame([([[1.0, 2.0]],)], "c array<array<float>>")
    assert rows(df.select(mono(F.col("c")))) == [([1.0, 2.0],)]


@pytest.mark.parametrize("rate,target", [(24000, 16000), (16000, 24000), (22050, 16000), (44100, 24000), (8000, 24000)])
def test_resampling_keeps_a_tone(rate, target):
    n = rate // 4
    tone = np.sin(2 * np.pi * 440 * np.arange(n) / rate).astype(np.float32)
    out = resample_samples(tone, rate, target)
    assert len(out) == -(-n * target // rate) and out.dtype == np.float32
    expected = np.sin(2 * np.pi * 440 * np.arange(len(out)) / target)
    inner = slice(len(out) // 10, -len(out) // 10)
    assert np.abs(out - expected)[inner].max() < 2e-3


def test_resampling_removes_what_the_target_cannot_hold():
    tone = np.sin(2 * np.pi * 11000 * np.arange(24000) / 24000).astype(np.float32)
    out = resample_samples(tone, 24000, 16000)
    assert np.abs(out[1000:-1000]).max() < 1e-2


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 400), st.sampled_from([8000, 16000, 22050, 24000, 44100]), st.sampled_from([16000, 24000]))
def test_resampled_length(n, rate, target):
    assert len(resample_samples(np.ones(n, np.float32), rate, target)) == -(-n * target // rate)


def test_resample_column(spark):
    df = _audio(spark, ([1.0] * 30, 24000), ([0.5, 0.25], 16000), None, ([], 24000))
    got = df.select("i", resample_audio(F.col("audio"), 16000).alias("a")).orderBy("i").collect()
    assert len(got[0].a.array) == 20 and got[0].a.sampling_rate == 16000
    assert tuple(got[1].a) == ([0.5, 0.25], 16000)
    assert got[2].a is None and got[3].a.array == []


def test_wav_round_trip():
    samples = np.array([0.0, 0.5, -0.5, 1.0, -1.0, 1.7, -3.0], np.float32)
    back, rate, channels = decode_wav(encode_wav(samples, 22050))
    assert (rate, channels) == (22050, 1)
    assert np.abs(back - np.clip(samples, -1, 1)).max() <= 1 / 32768


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_sample_widths_and_channels(width):
    values = np.array([-1.0, -0.5, 0.0, 0.5])
    full = 1 << (8 * width - 1)
    ints = (values * full).astype(np.int64)
    raw = b"".join(int(v + 128).to_bytes(1, "little") if width == 1 else int(v).to_bytes(width, "little", signed=True) for v in ints)
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as out:
        out.setnchannels(2)
        out.setsampwidth(width)
        out.setframerate(8000)
        out.writeframes(raw)
    samples, rate, channels = decode_wav(buffer.getvalue(), mix=False)
    assert samples.ravel().tolist() == values.tolist() and (rate, channels) == (8000, 2)
    mixed, _, _ = decode_wav(buffer.getvalue())
    assert mixed.tolist() == [-0.75, 0.25]


@pytest.mark.parametrize("extensible", [False, True])
@pytest.mark.parametrize("kind", ["<f4", "<f8"])
def test_float_files(kind, extensible):
    values = np.array([0.25, -1.0, 0.5], kind)
    width = values.itemsize
    head = struct.pack("<HHIIHH", 0xFFFE if extensible else 3, 1, 16000, 16000 * width, width, 8 * width)
    if extensible:
        head += struct.pack("<HHI", 22, 8 * width, 4) + struct.pack("<H", 3) + bytes(14)
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"data" + struct.pack("<I", values.nbytes) + values.tobytes()
    samples, rate, channels = decode_wav(b"RIFF" + struct.pack("<I", len(body)) + body)
    assert samples.tolist() == [0.25, -1.0, 0.5] and (rate, channels) == (16000, 1)


def test_parse_codes(spark):
    texts = [
        "<|im_start|>a<|speech_start|><|s_1|><|im_end|><|im_start|>b<|speech_start|><|s_2|><|s_3|>",
        "<|s_4|><|s_5|>",
        "a<|speech_start|>no codes",
        "",
        None,
        "<|speech_start|><|s_9|> then <|speech_start|>",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", parse_codes(F.col("t")), parse_codes(F.col("t"), strict=False))
    assert rows(got) == [(0, [2, 3], [2, 3]), (1, None, [4, 5]), (2, None, None), (3, None, None), (4, None, None), (5, None, None)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 70000), min_size=1, max_size=8), min_size=1, max_size=6))
def test_format_and_parse_are_inverse(spark, lists):
    df = spark.createDataFrame([(i, codes) for i, codes in enumerate(lists)], "i int, c array<int>")
    text = F.concat(F.lit("<|speech_start|>"), format_codes(F.col("c")))
    assert rows(df.select("i", parse_codes(text), count_codes(text))) == [(i, codes, len(codes)) for i, codes in enumerate(lists)]


def test_prompt(spark):
    df = spark.createDataFrame([("ref", "<|s_1|>", "ziel")], "r string, t string, x string")
    assert df.select(clone_prompt(F.col("r"), F.col("t"), F.col("x"))).first()[0] == (
        "<|im_start|>ref<|speech_start|><|s_1|><|im_end|><|im_start|>ziel<|speech_start|>"
    )


def test_guard(spark):
    df = spark.createDataFrame([(8000, 60000), (8001, 60000), (9000, 10)], "n int, size int")
    samples = F.array_repeat(F.lit(0.0).cast("float"), F.col("size"))
    kept = df.select("n", "size", F.size(guard_reference(samples, F.col("n"))))
    assert rows(kept) == [(8000, 60000, 60000), (8001, 60000, 48000), (9000, 10, 10)]
