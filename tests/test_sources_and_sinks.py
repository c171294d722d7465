import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechset.functions.audio import AUDIO_TYPE, encode_wav
from speechset.plans.publish import load_published_form, publish_dataset
from speechset.session import bounded_list, materialize, qualified, shared_root
from speechset.sinks.audio_files import open_filesystem, put_file, require_written, write_audio_files
from speechset.sinks.metadata import write_metadata_csv, write_metadata_json
from speechset.sinks.publish import embed_audio, write_dataset
from speechset.sources.files import discover_splits, list_files, read_audio_files
from speechset.sources.metadata import (
    read_catalogue,
    read_metadata_csv,
    read_metadata_json,
    read_prior_metadata,
    read_typed_csv,
)
from speechset.sources.tables import load_split, load_splits
from tests.conftest import plan, rows

HARD_TEXTS = ["plain", 'quo"te', "comma, here", "line\nbreak", "cr\r\nlf", " outer ", "back\\slash", '\\"', "NA", "null", "",
              "é漢😀", '"', "tab\there", "#comment", "a'b"]


def test_csv_keeps_every_text(spark, tmp_path):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(HARD_TEXTS)] + [("null", None)], "_key string, text string")
    path = str(tmp_path / "metadata.csv")
    write_metadata_csv(df, path, ["_key"])
    back = read_metadata_csv(spark, path)
    assert rows(back) == sorted([(str(i), t) for i, t in enumerate(HARD_TEXTS)] + [("null", "")], key=repr)
    assert rows(read_metadata_csv(spark, path, ["_key", "text"])) == rows(back)


def test_csv_files_follow_the_order(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    write_metadata_csv(spark.range(0, 100, 1, 5).orderBy(F.rand(1)), path, ["id"])
    names = sorted(n for n in os.listdir(path) if n.endswith(".csv"))
    ids = [int(line) for n in names for line in open(f"{path}/{n}").read().split()[1:]]
    assert ids == list(range(100))


def test_a_single_plain_csv_file_is_read_too(spark, tmp_path):
    path = tmp_path / "metadata.csv"
    path.write_text('_key,text_fr,error\ndev:0,"a ""b""\nc",\ndev:1,NA,\n', encoding="utf-8")
    assert rows(read_metadata_csv(spark, str(path))) == [("dev:0", 'a "b"\nc', ""), ("dev:1", "NA", "")]


def test_inferred_and_declared_types(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    write_metadata_csv(spark.createDataFrame([(7, "x")], "n bigint, t string"), path)
    assert read_typed_csv(spark, path).schema["n"].dataType.simpleString() == "int"
    assert read_typed_csv(spark, path, "n bigint, t string").schema["n"].dataType.simpleString() == "bigint"


def test_json_keeps_nulls_and_utf8(spark, tmp_path):
    path = str(tmp_path / "m.json")
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(HARD_TEXTS)] + [("null", None)], "_key string, text string")
    write_metadata_json(df, path)
    assert rows(read_metadata_json(spark, path, "_key string, text string")) == rows(df)
    content = "".join(open(f"{path}/{n}", encoding="utf-8").read() for n in os.listdir(path) if n.endswith(".json"))
    assert "é漢" in content and '{"_key":"null","text":null}' in content


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "metadata.json"
    path.write_text(json.dumps([{"_key": "a", "text": "é"}, {"_key": "b", "text": None}], ensure_ascii=False, indent=2), encoding="utf-8")
    assert rows(read_metadata_json(spark, str(path), "_key string, text string", array=True)) == [("a", "é"), ("b", None)]


def test_unusable_prior_run_gives_an_empty_table(spark, tmp_path, caplog):
    columns = ["_key", "cloned_audio_fr", "error"]
    assert read_prior_metadata(spark, str(tmp_path / "absent"), columns).count() == 0
    bad = tmp_path / "bad.csv"
    bad.write_bytes(b"\x00\x01binary")
    empty = read_prior_metadata(spark, str(bad), columns)
    assert empty.count() == 0 and empty.columns == columns
    assert "starting fresh" in caplog.text


def test_catalogue(spark, tmp_path):
    path = tmp_path / "texts.json"
    path.write_text(json.dumps({"fr": ["un", "deux é"], "en": ["one"], "zh": []}, ensure_ascii=False, indent=2), encoding="utf-8")
    assert rows(read_catalogue(spark, str(path))) == [("en", 0, "one"), ("fr", 0, "un"), ("fr", 1, "deux é")]
    default = spark.createDataFrame([("de", 0, "eins")], "lang string, sample_index bigint, text string")
    assert rows(read_catalogue(spark, str(tmp_path / "none.json"), default)) == [("de", 0, "eins")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_catalogue(spark, str(tmp_path / "none.json"))


def _listing(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_split_discovery(spark):
    found = discover_splits(_listing(
        spark, "train/metadata.csv", "train/metadata_cloned.csv", "test/metadata.csv/part-0.csv", "test/metadata.csv/part-1.csv",
        "audio/x.wav", "metadata_cloned.csv", "deep/er/metadata.csv",
    ))
    assert [tuple(r) for r in found.collect()] == [("test", "test", "metadata.csv"), ("train", "train", "metadata_cloned.csv")]
    root = discover_splits(_listing(spark, "metadata.csv/part-0.csv", "metadata_fr_test.csv", "audio/x.wav"))
    assert rows(root) == [("train", "", "metadata_fr_test.csv")]
    assert discover_splits(_listing(spark, "audio/x.wav")).count() == 0


def test_split_pruning(spark, tmp_path):
    root = str(tmp_path / "data")
    write_dataset(spark.range(10).selectExpr("id", "if(id < 7, 'dev', 'eval') AS split"), root)
    dev = load_split(spark, root, "dev")
    assert dev.count() == 7 and "PartitionFilters: [isnotnull(split" in plan(dev)
    assert load_splits(spark, root, ["eval"]).count() == 3


def test_published_dataset(spark, tmp_path):
    out = tmp_path / "out"
    (out / "train" / "cloned_audio").mkdir(parents=True)
    (out / "test").mkdir()
    (out / "notes").mkdir()
    (out / "train" / "metadata_cloned.csv").write_text("_key,text_fr,voice_fr\na,NA,cloned_audio/a.wav\nb,,  \n")
    (out / "train" / "metadata.csv").write_text("_key,text_fr,voice_fr\nwrong,x,y\n")
    (out / "test" / "metadata.csv").write_text("_key,text_fr,error\nc,trois,bad\n")
    dataset = load_published_form(spark, str(out))
    assert set(dataset.columns) == {"text_fr", "voice_fr", "split", "error"}
    assert rows(dataset, "split", "text_fr", "voice_fr", "error") == [
        ("test", "trois", None, "bad"), ("train", "", None, None), ("train", "NA", f"{out}/train/cloned_audio/a.wav", None),
    ]
    manifest = publish_dataset(spark, str(out), str(tmp_path / "published"))
    assert rows(manifest, "split", "n_rows", "n_voice_fr") == [("test", 1, 0), ("train", 2, 1)]
    assert sorted(os.listdir(tmp_path / "published" / "data"))[-2:] == ["split=test", "split=train"]


def test_root_metadata_is_the_train_split(spark, tmp_path):
    (tmp_path / "metadata.csv").write_text("_key,text\na,x\n")
    assert rows(load_published_form(spark, str(tmp_path))) == [("x", "train")]


def test_nothing_to_publish(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_published_form(spark, str(tmp_path))


def test_audio_files(spark, tmp_path):
    clips = spark.createDataFrame(
        [("a/x.wav", ([0.5, -0.5], 8000)), ("a/y.wav", ([], 16000)), ("b/none.wav", None)], f"path string, audio {AUDIO_TYPE}"
    )
    folder = str(tmp_path / "clips")
    report = write_audio_files(clips, folder)
    expected = [("a/x.wav", 2, ""), ("a/y.wav", 0, ""), ("b/none.wav", None, "")]
    assert rows(report, "path", "n_samples", "error") == expected
    assert rows(report, "path", "n_samples", "error") == expected  # written again, same files
    assert sorted(os.listdir(f"{folder}/a")) == ["x.wav", "y.wav"]
    assert rows(list_files(spark, folder, "*.wav")) == [("a/x.wav", 48), ("a/y.wav", 44)]
    (tmp_path / "clips" / "a" / "broken.wav").write_bytes(b"no audio")
    back = read_audio_files(spark, folder)
    by_path = {r.path: r for r in back.collect()}
    assert np.allclose(by_path["a/x.wav"].audio.array, [0.5, -0.5], atol=1e-4) and by_path["a/x.wav"].audio.sampling_rate == 8000
    assert by_path["a/y.wav"].audio.array == [] and by_path["a/broken.wav"].audio is None
    assert by_path["a/broken.wav"].error.startswith("Error")


def test_embedding_a_missing_file_and_a_null(spark, tmp_path):
    clip = spark.createDataFrame([("ok.wav", ([0.25], 8000))], f"path string, audio {AUDIO_TYPE}")
    write_audio_files(clip, str(tmp_path)).collect()
    df = spark.createDataFrame([("hello", f"{tmp_path}/ok.wav"), ("world", f"{tmp_path}/none.wav"), ("nil", None)], "text string, voice string")
    got = {r.text: r for r in embed_audio(df, "voice").collect()}
    assert got["hello"].voice.sampling_rate == 8000 and got["hello"].voice_error == ""
    assert got["world"].voice is None and "FileNotFoundError" in got["world"].voice_error
    assert got["nil"].voice is None and got["nil"].voice_error == ""


def test_unwritable_files_are_reported(spark, tmp_path):
    (tmp_path / "a").write_text("a file where a folder is needed")
    clips = spark.createDataFrame([("a/x.wav", ([0.5], 8000)), ("b/y.wav", ([0.5], 8000))], f"path string, audio {AUDIO_TYPE}")
    with pytest.raises(RuntimeError, match="1 clips not written, such as a/x.wav"):
        require_written(write_audio_files(clips, str(tmp_path)))
    assert (tmp_path / "b" / "y.wav").exists()


def test_put_file_replaces(tmp_path):
    for folder in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        store, base = open_filesystem(folder)
        put_file(store, f"{base}/d/f.bin", b"old")
        put_file(store, f"{base}/d/f.bin", b"new")
        assert (tmp_path / "d" / "f.bin").read_bytes() == b"new" and os.listdir(tmp_path / "d") == ["f.bin"]


def test_shared_root_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    path = materialize(spark.range(3), "kept").inputFiles()[0]
    assert shared_root(spark) in path


def test_bounded_list_never_cuts(spark):
    assert bounded_list(spark.range(3), "id", 3) == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 2 rows"):
        bounded_list(spark.range(3), "id", 2)


@pytest.mark.parametrize("home", ["clips/clips", "a#b", "with space"])
def test_relative_paths_of_odd_roots(spark, tmp_path, home):
    root = tmp_path / home
    (root / "clips").mkdir(parents=True)
    (root / "clips" / "a.wav").write_bytes(encode_wav(np.zeros(2), 8000))
    assert rows(list_files(spark, str(root), "*.wav"), "path") == [("clips/a.wav",)]
    assert rows(read_audio_files(spark, str(root)), "path") == [("clips/a.wav",)]


def test_a_folder_without_a_scheme_is_on_the_default_file_system(spark):
    assert qualified("/tmp/x/") == "file:/tmp/x"
    assert qualified("file:///tmp/x") == "file:/tmp/x"
