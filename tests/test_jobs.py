import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from speechset.constants import CLIP_COLUMNS, ERROR_NO_AUDIO, ERROR_NO_TEXT
from speechset.functions.audio import AUDIO_TYPE
from speechset.operators import jobs
from speechset.operators.jobs import apply_job, cfg_weight, spread, synthesize
from speechset.operators.shape import SourceProfile
from speechset.plans.build_clips import build_clips, build_split
from speechset.plans.multilingual import clone_rows, multilingual_clips
from speechset.plans.sampled_test_set import sampled_test_set
from speechset.sinks.metadata import write_metadata_csv
from speechset.sources.files import list_files
from speechset.sources.metadata import read_prior_metadata
from speechset.streaming.incremental import build_arrivals, compact, first_of_keys
from tests.conftest import rows


def open_echo():
    def speak(text, *rest):
        if "fail" in text:
            raise RuntimeError(f"cannot say {text}")
        return np.full((1, len(text)), 0.25), 24000

    return speak


def test_errors_stay_in_their_row(spark):
    df = spark.createDataFrame([(1, "abc", ""), (2, "fail", ""), (3, "abcd", "earlier"), (4, "", None)], "k int, text string, error string")
    got = {r.k: r for r in synthesize(df, open_echo, ["text"]).collect()}
    assert (len(got[1].out_array), got[1].out_rate, got[1].error) == (3, 24000, "")
    assert got[2].out_array is None and "RuntimeError: cannot say fail" in got[2].error and "Traceback" in got[2].error
    assert got[3].out_array is None and got[3].error == "earlier"
    assert got[4].out_array == [] and got[4].error == ""


def test_columns_travel_unchanged(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(big, None, [1.5], "x"), (None, big, None, "y")], "a bigint, b bigint, c array<double>, text string")
    made = synthesize(df, open_echo, ["text"], drop=["text"])
    assert made.columns == ["a", "b", "c", "out_array", "out_rate", "error"]
    assert rows(made, "a", "b", "c") == sorted([(big, None, [1.5]), (None, big, None)], key=repr)


def test_the_model_is_opened_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def open_counting():
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return lambda k: (os.getpid(),)

    df = spark.range(0, 400, 1, 20)
    out = StructType([StructField("pid", IntegerType())])
    pids = apply_job(df, open_counting, ["id"], out).select("pid").distinct().count()
    assert len(os.listdir(folder)) == pids <= 20


def test_output_batches_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(jobs, "OUTPUT_BYTES", 1000)
    df = spark.range(0, 50, 1, 1).selectExpr("id", "repeat('x', 100) AS text")
    made = synthesize(df, open_echo, ["text"])
    assert made.where("size(out_array) = 100").count() == 50
    assert rows(made.select("id")) == sorted([(i,) for i in range(50)], key=repr)


def test_spread_and_cfg(spark):
    df = spark.createDataFrame([(0.0, 1), (0.5, 2)], "w double, k int")
    assert rows(df.select(cfg_weight(F.col("w")))) == [(0.001,), (0.5,)]
    assert spread(df, 3, "k").rdd.getNumPartitions() == 3 and spread(df, None) is df


def _utterances(spark):
    good = ([0.5, 0.25], 16000)
    return spark.createDataFrame(
        [("dev:0", 0, "speaker_01", "hello", "bonjour", good), ("dev:1", 1, "speaker_01", "x", "fail", good),
         ("dev:2", 2, "speaker_01", None, "salut", None), ("dev:3", 3, "speaker_02", "y", "  ", good),
         ("dev:4", 4, "speaker_02", "z", "déjà", good)],
        f"_key string, original_index bigint, speaker_id string, text_en string, text_fr string, audio {AUDIO_TYPE}",
    ).withColumns({"original_split": F.lit("dev"), "speaker_name": F.lit("E")})


def test_build_and_resume(spark, tmp_path):
    folder = str(tmp_path / "run1")
    built = build_clips(_utterances(spark), open_echo, folder=folder, single_files=True)
    got = {r._key: r for r in built.metadata.collect()}
    assert built.metadata.columns == CLIP_COLUMNS
    assert got["dev:0"].audio_en == "original_audio_en/original_dev_0_en.wav"
    assert got["dev:0"].cloned_audio_fr == "cloned_audio_fr/cloned_dev_0_fr.wav" and got["dev:0"].error == ""
    assert got["dev:1"].audio_en and got["dev:1"].cloned_audio_fr == "" and "cannot say fail" in got["dev:1"].error
    assert (got["dev:2"].error, got["dev:2"].audio_en, got["dev:2"].text_en) == (ERROR_NO_AUDIO, "", "")
    assert (got["dev:3"].error, got["dev:3"].audio_en) == (ERROR_NO_TEXT, "")
    files = {r.path for r in list_files(spark, folder, "*.wav").collect()}
    assert files == {f"original_audio_en/original_dev_{i}_en.wav" for i in (0, 1, 4)} | {f"cloned_audio_fr/cloned_dev_{i}_fr.wav" for i in (0, 4)}

    write_metadata_csv(built.metadata, f"{folder}/metadata.csv", ["original_index"])
    os.remove(f"{folder}/cloned_audio_fr/cloned_dev_4_fr.wav")
    prior = read_prior_metadata(spark, f"{folder}/metadata.csv", CLIP_COLUMNS)
    present = list_files(spark, folder, "cloned_*.wav").select(F.col("path").alias("cloned_audio_fr"))

    def open_second():
        return lambda text, *rest: (np.zeros(7), 24000)

    again = build_clips(_utterances(spark), open_second, prior, present, folder=str(tmp_path / "run2"), tasks=3)
    assert rows(again.clips, "_key") == [("dev:1",), ("dev:2",), ("dev:3",), ("dev:4",)]
    merged = {r._key: r for r in again.metadata.collect()}
    assert len(merged) == 5 and merged["dev:1"].cloned_audio_fr == "cloned_audio_fr/cloned_dev_1_fr.wav"
    assert again.metadata.schema["original_index"].dataType.simpleString() == "bigint"
    assert merged["dev:0"].original_index == 0 and merged["dev:0"].text_fr == "bonjour"


@pytest.mark.parametrize("single_files", [False, True])
def test_a_split_is_built_over_several_runs(spark, tmp_path, single_files):
    folder = str(tmp_path / "train")
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def open_logged():
        import uuid

        def speak(text, *rest):
            open(f"{calls}/{uuid.uuid4().hex}", "w").close()
            if text == "fail" and len(os.listdir(calls)) < 4:
                raise RuntimeError("busy")
            return np.zeros(len(text)), 24000

        return speak

    def run():
        return rows(build_split(_utterances(spark), open_logged, folder, single_files))

    assert run() == [(2, 3, 5)] and len(os.listdir(calls)) == 3
    first = {r._key: r for r in read_prior_metadata(spark, f"{folder}/metadata.csv", CLIP_COLUMNS).collect()}
    assert run() == [(3, 2, 5)] and len(os.listdir(calls)) == 4
    assert run() == [(3, 2, 5)] and len(os.listdir(calls)) == 4
    last = {r._key: r for r in read_prior_metadata(spark, f"{folder}/metadata.csv", CLIP_COLUMNS).collect()}
    assert last["dev:0"] == first["dev:0"] and set(last) == {f"dev:{i}" for i in range(5)}
    assert spark.read.json(f"{folder}/metadata.json").count() == 5
    if single_files:
        os.remove(f"{folder}/cloned_audio_fr/cloned_dev_0_fr.wav")
        assert run() == [(3, 2, 5)] and len(os.listdir(calls)) == 5


def test_empty_result_gives_a_blank_path(spark):
    built = build_clips(_utterances(spark).where("_key = 'dev:0'"), lambda: lambda *a: (np.zeros(0), 24000))
    row = built.metadata.first()
    assert row.cloned_audio_fr == "" and row.error == ""


def test_multilingual(spark, tmp_path):
    good = ([0.5, 0.25, 0.1], 24000)
    df = spark.createDataFrame(
        [(0, "r0", good, "un", "eins"), (1, "r1", good, None, "fail"), (2, "r2", None, "deux", "zwei"), (3, "r3", ([0.1], 1), "x", "y")],
        f"pos bigint, body string, clip {AUDIO_TYPE}, fr string, de string",
    )
    profile = SourceProfile(audio="clip", reference_text="body", texts={"fr": "fr", "de": "de"})
    log = str(tmp_path)

    def open_encoder():
        def encode(samples, rate):
            import uuid

            open(f"{log}/{uuid.uuid4().hex}", "w").close()
            if rate == 1:
                raise ValueError("bad rate")
            return [len(samples)]

        return encode

    def open_model():
        def speak(prompt, lang):
            if "fail" in prompt:
                raise ValueError("cannot")
            assert prompt.startswith("<|im_start|>r0<|speech_start|><|s_3|><|im_end|><|im_start|>"), prompt
            return np.ones(5), 24000

        return speak

    folder = str(tmp_path / "out")
    os.mkdir(f"{log}/log")
    log = f"{log}/log"
    made = multilingual_clips(df, profile, ["fr", "de"], open_encoder, open_model, tasks=3, folder=folder, single_files=True)
    files = {r.path for r in list_files(spark, folder, "*.wav").collect()}
    assert files == {f"cloned_audio/en/original_0000{i}.wav" for i in (0, 1, 3)} | {f"cloned_audio/{x}/cloned_00000_{x}.wav" for x in ("fr", "de")}
    assert len(os.listdir(log)) == 3  # once per usable row, not per language
    assert [c for c in made.metadata.columns][:6] == ["voice_en", "text_fr", "voice_fr", "text_de", "voice_de", "pos"]
    got = {r.pos: r for r in made.metadata.collect()}
    assert got[0].voice_fr == "cloned_audio/fr/cloned_00000_fr.wav" and got[0].voice_de_ok and got[0].error == ""
    assert (got[1].voice_fr, got[1].voice_de, got[1].voice_fr_ok) == ("", "", False) and "cannot" in got[1].error
    assert got[2].error == ERROR_NO_AUDIO and got[2].voice_en == ""
    assert "bad rate" in got[3].error and got[3].voice_en == "cloned_audio/en/original_00003.wav"
    assert rows(made.coverage) == [("de", 1, 4), ("fr", 1, 4)]
    with pytest.raises(ValueError, match="not available"):
        multilingual_clips(df, profile, ["fr", "xx"], open_encoder, open_model)


def test_sampled_test_set(spark):
    df = spark.range(50).selectExpr("concat('dev:', id) AS _key", "id AS original_index", "if(id % 2 = 0, repeat('a', int(id)), null) AS text_fr", "'en' AS text_en")
    made = sampled_test_set(df, open_echo, n=20)
    got = made.collect()
    assert sorted(r.selected_id for r in got) == list(range(20))
    for r in got:
        size = r.original_index if r.original_index % 2 == 0 else 0
        assert r.cloned_length_fr == size and r.error == ""
        assert r.cloned_voice_fr == (f"cloned_audio_fr_test/cloned_{r.selected_id:05d}_fr.wav" if size else "")


SCHEMA = "_key string, text string"


def _arrive(spark, folder, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_incremental_runs(spark, tmp_path):
    arrivals, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    calls = []

    def build(batch):
        return synthesize(batch, open_echo, ["text"]).select("_key", F.size("out_array").alias("n"), "error")

    def publish(df, batch_id):
        calls.append((batch_id, df.count()))
        if batch_id == 1:
            raise OSError("hub is down")

    def run():
        build_arrivals(spark, arrivals, SCHEMA, output, checkpoint, build, files_per_batch=1, done="error = ''", publish=publish)

    _arrive(spark, arrivals, ("a", "x"), ("b", "fail"), ("a", "x"))
    run()
    assert rows(spark.read.parquet(output), "_key", "batch_id") == [("a", 0), ("b", 0)]
    run()
    assert len(calls) == 1
    _arrive(spark, arrivals, ("a", "x"), ("b", "better"), ("c", "y"))
    run()
    _arrive(spark, arrivals, ("d", "fail"))
    run()
    assert rows(spark.read.parquet(output), "_key", "batch_id") == [("a", 0), ("b", 0), ("b", 1), ("c", 1), ("d", 2)]
    log = rows(spark.read.json(f"{output}_publish_log"), "batch_id", "report")
    assert log == [(0, "published"), (1, "OSError: hub is down"), (2, "published")]
    final = compact(spark, output, str(tmp_path / "final"), done="error = ''")
    assert [(r._key, r.n) for r in final.orderBy("_key").collect()] == [("a", 1), ("b", 6), ("c", 1), ("d", None)]


def test_a_failed_batch_is_repeated_once(spark, tmp_path):
    arrivals, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    state = {"fail": True}

    def build(batch):
        built = batch.select("_key", F.length("text").alias("n"))
        if state.pop("fail", False):
            built.write.parquet(f"{output}/batch_id=0")
            raise RuntimeError("driver lost after writing")
        return built

    _arrive(spark, arrivals, ("a", "x"), ("b", "yy"))
    with pytest.raises(Exception, match="driver lost"):
        build_arrivals(spark, arrivals, SCHEMA, output, checkpoint, build)
    build_arrivals(spark, arrivals, SCHEMA, output, checkpoint, build)
    assert rows(spark.read.parquet(output), "_key", "n") == [("a", 1), ("b", 2)]


def test_compact_prefers_finished_rows(spark, tmp_path):
    output = str(tmp_path / "out")
    spark.createDataFrame([("a", ""), ("b", "bad"), ("c", None)], "_key string, error string").write.parquet(f"{output}/batch_id=0")
    spark.createDataFrame([("a", "bad"), ("b", "worse"), ("c", "bad")], "_key string, error string").write.parquet(f"{output}/batch_id=1")
    final = compact(spark, output, str(tmp_path / "final"), done="error = ''")
    assert rows(final) == [("a", ""), ("b", "worse"), ("c", "bad")]


def test_one_opener_is_opened_once_in_a_worker(spark, tmp_path):
    log = str(tmp_path)

    def open_counted():
        import uuid

        open(f"{log}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda text: (len(text),)

    df = spark.createDataFrame([("a",), ("bb",)], "text string").coalesce(1)
    schema = StructType.fromDDL("n bigint")
    for _ in range(4):
        assert sorted(r.n for r in apply_job(df, open_counted, ["text"], schema).collect()) == [1, 2]
    opened = [name.split("-")[0] for name in os.listdir(log)]
    assert len(opened) == len(set(opened))


def test_a_function_can_take_batches(spark):
    def open_lengths():
        def lengths(given):
            if any(text == "bad" for (text,) in given):
                raise ValueError("bad batch")
            return [(len(text),) for (text,) in given]

        return lengths

    df = spark.createDataFrame([(i, "x" * i) for i in range(5)] + [(5, "bad")], "i int, text string").coalesce(1).orderBy("i")
    made = apply_job(df, open_lengths, ["text"], StructType.fromDDL("n bigint"), batch=2)
    got = {r.i: (r.n, "bad batch" in r.error) for r in made.collect()}
    assert got == {0: (0, False), 1: (1, False), 2: (2, False), 3: (3, False), 4: (None, True), 5: (None, True)}


def test_stream_batches_choose_among_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3), ("b", 4)], "_key string, n int")
    once, again = rows(first_of_keys(df, "_key")), rows(first_of_keys(df.orderBy(F.desc("n")), "_key"))
    assert once == again and len(once) == 4 and once.count((None, 3)) == 2


def test_a_language_without_texts_has_blank_voices(spark):
    audio = F.struct(F.array(F.lit(0.5)).cast("array<float>").alias("array"), F.lit(8000).alias("sampling_rate"))
    df = spark.createDataFrame([(0, "hi", "salut")], "pos bigint, reference_text string, text_fr string").withColumn("audio", audio)
    made = clone_rows(df, ["fr", "de"], lambda: lambda s, r: [1], lambda: lambda prompt, lang: (np.zeros(3), 8000))
    assert rows(made, "lang", "path", "error") == [("de", "", ""), ("fr", "cloned_audio/fr/cloned_00000_fr.wav", "")]
