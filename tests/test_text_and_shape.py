from pyspark.sql import functions as F

from speechset.constants import CLIP_COLUMNS
from speechset.functions.naming import (
    cloned_clip_name,
    file_key,
    indexed_clip_name,
    indexed_source_name,
    resume_key,
    source_clip_name,
    speaker_id,
    voice_clip_name,
)
from speechset.functions.text import first_existing, is_blank, is_empty, split_list, strip
from speechset.operators.shape import (
    MULTILINGUAL_SOURCE,
    PAIRED_SOURCE,
    audio_path_columns,
    canonical_metadata,
    clip_record,
    pair_order,
    publishable,
    put_first,
    rename_over,
    select_profile,
    union_splits,
)
from speechset.plans.repair import repair_metadata
from tests.conftest import rows

# Every character that Python's str.strip removes.
SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_blank_agrees_with_python_strip(spark):
    texts = SPACES + [None, "", "".join(SPACES), " x ", "​", "x\n", "\n\nx", " x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", is_blank(F.col("t")), is_empty(F.col("t")), strip(F.col("t"))).collect()
    for i, blank, empty, stripped in got:
        text = texts[i]
        assert blank == (not (text or "").strip()), repr(text)
        assert empty == (not text)
        assert stripped == (None if text is None else text.strip()), repr(text)


def test_split_list(spark):
    df = spark.createDataFrame([(" fr, de ,zh",), ("en",)], "s string")
    assert [r[0] for r in df.select(split_list(F.col("s"))).collect()] == [["fr", "de", "zh"], ["en"]]


def test_names(spark):
    df = spark.createDataFrame([("dev", 107, 3, "Sofia", "fr"), ("eval", 100000, None, "Leo", "en")], "s string, i bigint, n int, v string, l string")
    key = resume_key(F.col("s"), F.col("i"))
    got = df.select(
        key, file_key(key), source_clip_name(key), cloned_clip_name(key), indexed_source_name(F.col("i")),
        indexed_clip_name(F.col("i"), F.col("l")), voice_clip_name(F.col("v"), F.col("l"), F.col("i")), speaker_id(F.col("n")),
    )
    assert rows(got) == [
        ("dev:107", "dev_107", "original_dev_107_en.wav", "cloned_dev_107_fr.wav", "original_00107.wav",
         "cloned_00107_fr.wav", "sofia_fr_00107.wav", "speaker_03"),
        ("eval:100000", "eval_100000", "original_eval_100000_en.wav", "cloned_eval_100000_fr.wav", "original_100000.wav",
         "cloned_100000_en.wav", "leo_en_100000.wav", "speaker_unknown"),
    ]


def test_first_existing_tries_names_not_values(spark):
    df = spark.createDataFrame([(None, "b")], "x string, y string")
    assert rows(df.select(first_existing(df, "absent", "x", "y"))) == [(None,)]
    assert rows(df.select(first_existing(df, "absent"))) == [(None,)]


def test_rename_over(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename_over(df, {"a": "b"}).columns == ["b", "c"]
    assert rows(rename_over(df, {"a": "b"})) == [(1, 3)]
    assert rename_over(df, {"absent": "c", "b": "b"}).columns == ["a", "b", "c"]


def test_profiles(spark):
    paired = spark.createDataFrame(
        [("7", "spk", "en text", "ar text", None)],
        "sample_id string, speaker_id string, reference_text_en string, target_text_ar string, target_text_fr string",
    )
    logical = select_profile(paired, PAIRED_SOURCE)
    assert logical.columns == ["row_id", "speaker_id", "reference_text", "text_ar", "text_fr"]
    assert rows(logical) == [("7", "spk", "en text", "ar text", None)]
    wide = spark.createDataFrame([(1, "hello", "bonjour")], "index int, text_en string, text_fr string")
    assert rows(select_profile(wide, MULTILINGUAL_SOURCE)) == [(1, "", "hello", "hello", "bonjour")]
    assert PAIRED_SOURCE.languages() == ["en", "ar", "fr"] and len(MULTILINGUAL_SOURCE.languages()) == 11


def test_canonical_metadata(spark):
    df = spark.createDataFrame(
        [("k", "hi", None, "v_ar", "sal", None)],
        "note string, source_text_en string, cloned_voice_fr string, voice_ar string, text_ar string, text_fr string",
    )
    new = canonical_metadata(df, ["en", "ar", "fr"])
    assert new.columns == [*pair_order(["en", "ar", "fr"]), "note"]
    assert rows(new) == [("hi", "", "sal", "v_ar", "", "", "k")]


def test_repair_by_position(spark):
    old = spark.createDataFrame([(20, "two", "a.wav"), (10, "one", None), (30, "three", "c.wav")], "i int, source_text_en string, cloned_voice_fr string")
    sources = spark.createDataFrame([(5, "x"), (9, "y")], "s int, name string")
    fixed = repair_metadata(old, sources, "i", "s")
    assert fixed.columns[:6] == pair_order(["en", "ar", "fr"])
    assert rows(fixed, "i", "name", "text_en", "voice_en", "voice_fr") == [
        (10, "x", "one", "cloned_audio/en/original_00000.wav", ""),
        (20, "y", "two", "cloned_audio/en/original_00001.wav", "a.wav"),
        (30, None, "three", "", "c.wav"),
    ]


def test_clip_record_defaults(spark):
    df = spark.createDataFrame([("dev:0", 0, None)], "_key string, original_index int, text_fr string")
    record = clip_record(df)
    assert record.columns == CLIP_COLUMNS
    assert record.schema["original_index"].dataType.simpleString() == "bigint"
    assert rows(record) == [("dev:0", "", "", "", 0, "", "", "", "", "")]


def test_publishable(spark):
    df = spark.createDataFrame(
        [("k", "NA", "a/b.wav", 12, None), ("l", None, "  ", None, "x.wav")],
        "_key string, text string, cloned_audio_fr string, audio_length_samples bigint, auido_old string",
    )
    assert audio_path_columns(df) == ["cloned_audio_fr", "auido_old"]
    new = publishable(df, "/out/train")
    assert new.columns == ["text", "cloned_audio_fr", "audio_length_samples", "auido_old"]
    assert rows(new) == [("", None, "", "/out/train/x.wav"), ("NA", "/out/train/a/b.wav", "12", None)]


def test_union_splits_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, t string"), spark.createDataFrame([(2,)], "i int")
    assert rows(union_splits({"train": a, "test": b})) == [(1, "x", "train"), (2, None, "test")]


def test_put_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert put_first(df, ["c", "absent", "a"]).columns == ["c", "a", "b"]
