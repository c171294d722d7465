"""Jobs that keep their results, the prompt guard, and warnings as rows."""

import json
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import speechset.plans.build_clips
import speechset.plans.publish_versions
import suite
import suite.jobs
import suite.steps
from speechset.functions.audio import AUDIO_TYPE
from speechset.operators.languages import also_in, not_in
from speechset.operators.positions import dense_positions
from speechset.operators.shape import SourceProfile, publishable
from speechset.plans.build_clips import build_split, last_records
from speechset.plans.multilingual import clone_rows, multilingual_clips
from speechset.plans.sampled_test_set import build_test_set
from speechset.plans.stored_job import results_of, run_stored, stored_results
from speechset.plans.voice_grid import build_grid
from speechset.sinks.metadata import store_in_order, write_metadata
from speechset.sinks.pieces import PIECE, in_place, pieces_for, pieces_of_keys, place_numbered, store_in_pieces
from tests.conftest import DATA, plan, rows
from tests.test_build_steps import _utterances, open_easy


def _work(spark, texts):
    return spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "k int, text string, input_id string")


def _make(log, fail=()):
    def make(todo):
        log.append(sorted(r.k for r in todo.select("k").collect()))
        return todo.select("k", "input_id", F.upper("text").alias("said"), F.when(F.col("text").isin(*fail), "busy").otherwise("").alias("error"))

    return make


def test_only_what_is_missing_is_made(spark, tmp_path):
    folder, log = str(tmp_path / "job"), []
    assert stored_results(spark, folder) is None
    assert rows(run_stored(_work(spark, "abc"), ["k"], _make(log, ["b"]), folder), "k", "said", "error") == [(0, "A", ""), (1, "B", "busy"), (2, "C", "")]
    assert rows(run_stored(_work(spark, "abd"), ["k"], _make(log), folder), "k", "said", "error") == [(0, "A", ""), (1, "B", ""), (2, "D", "")]
    assert rows(run_stored(_work(spark, "ab"), ["k"], _make(log), folder), "k", "said") == [(0, "A"), (1, "B")]
    assert log == [[0, 1, 2], [1, 2], []]
    # A failed attempt never hides a finished one, and an older input's result is found again.
    run_stored(_work(spark, "xyz"), ["k"], _make(log, ["x"]), folder)
    assert rows(results_of(_work(spark, "abc"), ["k"], folder), "said") == [("A",), ("B",), ("C",)]


def test_sampled_sets_are_kept(spark, tmp_path):
    folder = str(tmp_path / "sample")
    clip = F.struct(F.concat(F.lit("in/"), "id").alias("path"), F.array(F.lit(0.5)).alias("array"))
    df = spark.range(40).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("original_index"), F.lit("en").alias("text_en"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("fr"), "id")).alias("text_fr"), F.when(F.col("id") % 5 > 0, clip).alias("audio"),
    )
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def open_counting():
        import uuid

        def say(text):
            open(f"{calls}/{uuid.uuid4().hex}", "w").close()
            return np.zeros(len(text)), 8000

        return say

    first = build_test_set(df, open_counting, folder, key="k", n=20)
    made = len(os.listdir(calls))
    assert made == first.where("cloned_voice_fr <> ''").count() > 0
    again = build_test_set(df, open_counting, folder, key="k", n=20)
    assert len(os.listdir(calls)) == made and rows(again.drop("clip")) == rows(first.drop("clip"))
    assert {(r.source_audio_path, int(r.original_index) % 5 == 0) for r in again.collect()} >= {("", True)}
    assert all(r.source_audio_path == f"in/{r.original_index}" for r in again.where("source_audio_path <> ''").collect())
    changed = df.withColumn("text_fr", F.when(F.col("k") < 20, F.lit("new text")).otherwise(F.col("text_fr")))
    build_test_set(changed, open_counting, folder, key="k", n=20)
    assert made < len(os.listdir(calls)) < 2 * made + 10
    read = spark.read.option("header", True).csv(f"{folder}/metadata_fr_test.csv")
    assert read.count() == 20 and "source_audio_path" in read.columns


def test_grids_warn_of_languages_without_sentences(spark, tmp_path):
    folder = str(tmp_path / "grid")
    catalogue = spark.createDataFrame([("en", 0, "a"), ("en", 1, "b"), ("fr", 0, "")], "lang string, sample_index int, text string")
    grid = build_grid(catalogue, ["en", "fr", "de"], lambda: lambda text, lang, voice: (np.zeros(2), 8000), folder)
    assert grid.where("language = 'en' AND error = ''").count() == 10
    warned = spark.read.json(f"{folder}/warnings/grid")
    assert rows(warned, "message") == [("no texts available for language de",), ("no texts available for language fr",)]


_PROFILE = SourceProfile(audio="clip", reference_text="ref", texts={"fr": "text_fr", "de": "text_de"}, speaker="who", row_id="id")


def _references(spark, n=4):
    clip = F.struct(F.array_repeat(F.lit(0.5), F.when(F.col("id") == 1, 400).otherwise(20).cast("int")).alias("array"), F.lit(50).alias("sampling_rate"))
    return spark.range(n).select(
        "id", F.col("id").alias("pos"), F.lit("w").alias("who"), F.lit("ref").alias("ref"), F.lit("bonjour").alias("text_fr"),
        F.when(F.col("id") != 2, "hallo").alias("text_de"), clip.cast(AUDIO_TYPE).alias("clip"),
    )


def open_code_per_sample():
    return lambda samples, rate: np.zeros(len(samples), np.int64)


def open_prompt_length():
    return lambda prompt, lang: (np.zeros(prompt.count("<|s_0|>")), 8000)


def test_long_prompts_are_guarded_and_marked(spark, tmp_path):
    job = multilingual_clips(
        _references(spark), _PROFILE, ["fr", "de"], open_code_per_sample, open_prompt_length,
        folder=str(tmp_path / "m"), count_tokens=lambda p: F.regexp_count(p, F.lit(r"s_0")), token_limit=200,
    )
    got = {(r.pos, r.lang): (r.trimmed, r.clip and len(r.clip.array)) for r in job.clips.collect()}
    # 400 samples are over the limit: the first three seconds of 50 Hz are 150.
    assert got == {(0, "fr"): (False, 20), (0, "de"): (False, 20), (1, "fr"): (True, 150), (1, "de"): (True, 150),
                   (2, "fr"): (False, 20), (2, "de"): (False, None), (3, "fr"): (False, 20), (3, "de"): (False, 20)}
    free = multilingual_clips(_references(spark), _PROFILE, ["fr"], open_code_per_sample, open_prompt_length)
    assert {(r.pos, r.trimmed, len(r.clip.array)) for r in free.clips.collect()} == {(0, False, 20), (1, False, 400), (2, False, 20), (3, False, 20)}


def test_a_second_action_calls_nothing(spark, tmp_path):
    folder = str(tmp_path / "m")

    def refuse():
        def call(*args):
            raise RuntimeError("called")

        return call

    multilingual_clips(_references(spark, 3), _PROFILE, ["fr", "de"], open_code_per_sample, open_prompt_length, folder=folder, shared=["en", "fr"])
    again = multilingual_clips(_references(spark, 3), _PROFILE, ["fr", "de"], refuse, refuse, folder=folder, shared=["en", "fr"])
    assert again.clips.where("error <> ''").count() == 0 and again.clips.count() == 6
    assert again.warnings and "de" in spark.read.json(f"{folder}/warnings/multilingual").first().message
    assert spark.read.option("header", True).csv(f"{folder}/metadata_cloned.csv").count() == 3
    more = multilingual_clips(_references(spark, 4), _PROFILE, ["fr", "de"], refuse, refuse, folder=folder)
    assert more.clips.where("error <> ''").select("pos").distinct().count() == 1 and not more.warnings


def test_an_unreadable_earlier_run_is_a_warning_row(spark, tmp_path):
    folder = tmp_path / "split"
    folder.mkdir()
    (folder / "metadata.csv").write_text("something,else\n1,2\n")
    build_split(_utterances(spark, 2), open_easy, str(folder))
    assert "starting fresh" in spark.read.json(f"{folder}/warnings/resume").first().message
    other = str(tmp_path / "fresh")
    build_split(_utterances(spark, 2), open_easy, other)
    assert not os.path.exists(f"{other}/warnings") and last_records(spark, other).count() == 2


def test_published_paths_are_absolute(spark):
    df = spark.createDataFrame([("a/b.wav",), ("",), (None,)], "cloned_audio_fr string")
    got = [r[0] for r in publishable(df, "some/folder").collect()]
    assert got == [f"{os.getcwd()}/some/folder/a/b.wav", None, None]
    assert publishable(df, "hdfs://h/x").first()[0] == "hdfs://h/x/a/b.wav"


def test_sets_of_any_size(spark):
    asked = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "v string")
    there = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(also_in(asked, there, "v")) == [("a",)]
    assert rows(not_in(asked, there, "v")) == sorted([("z",), (None,)], key=repr)
    with pytest.raises(Exception):
        also_in(asked, there, "w")


def test_both_exports_come_from_one_sorted_table(spark, tmp_path):
    df = spark.range(0, 300, 1, 6).orderBy(F.rand(3)).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit('a "b"\n'), "id")).alias("text"))
    stored = store_in_order(df, str(tmp_path / "stored"), ["id"])
    assert "Exchange" not in plan(stored) and "Sort" not in plan(stored)
    assert [r.id for r in stored.collect()] == list(range(300))
    write_metadata(df, str(tmp_path), "m", ["id"])
    lines = [line for name in sorted(os.listdir(tmp_path / "m.json")) if name.startswith("part-") for line in open(tmp_path / "m.json" / name)]
    assert [json.loads(line)["id"] for line in lines] == list(range(300))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "m.csv"))
    assert sorted(int(r.id) for r in back.collect()) == list(range(300)) and back.where("text IS NOT NULL").count() == df.where("text IS NOT NULL").count()
    write_metadata(df.limit(0), str(tmp_path), "none", ["id"])
    assert spark.read.schema("id bigint").json(str(tmp_path / "none.json")).count() == 0


def test_what_is_left_travels_with_the_reference(spark, tmp_path):
    """The languages of a row, with their prompts, meet no list of keys: only the reference's own row is joined, and nothing before the first run."""
    folder, langs = str(tmp_path / "m"), ["fr", "de"]
    given = _references(spark).select("pos", F.col("clip").alias("audio"), F.col("ref").alias("reference_text"), "text_fr", "text_de")
    first = clone_rows(given, langs, open_code_per_sample, open_prompt_length, folder=folder)
    assert "Join" not in plan(first)
    first.where("pos <> 3 OR lang = 'fr'").write.parquet(f"{folder}/results/run=1")
    again = clone_rows(given, langs, open_code_per_sample, open_prompt_length, folder=folder)
    assert plan(again).split("== Physical Plan ==")[1].count("Join") == 1
    assert rows(again, "pos", "lang") == [(3, "de")]


def test_a_stored_job_moves_no_text_for_its_exports(spark, tmp_path, monkeypatch):
    """What is written after the input is stored shuffles positions, paths and errors, and keeps no sorted copy of the texts."""
    moved = set()

    def watched(write):
        def call(writer, path, *args, **kw):
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            said = writer._df._jdf.queryExecution().explainString(mode)
            moved.update(re.findall(r"(\w+)#\d+", "".join(re.findall(r"\) Exchange\nInput[^\n]*", said))))
            return write(writer, path, *args, **kw)

        return call

    for name in ("parquet", "csv", "json"):
        monkeypatch.setattr(DataFrameWriter, name, watched(getattr(DataFrameWriter, name)))
    before, limit = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for encoder in (open_code_per_sample, suite.jobs.open_no_model):
            job = multilingual_clips(_references(spark, 9), _PROFILE, ["fr", "de"], encoder, suite.jobs.open_no_model, folder=str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert job.clips.where("error LIKE '%a model was called%'").count() == 17 and "pos" in moved
    assert not moved & {"clip", "audio", "reference_text", "ref", "text_fr", "text_de"}
    assert not [name for name in set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before if name.startswith("metadata_cloned")]


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_exports_of_a_stored_job_are_in_order(spark, tmp_path, limit):
    folder, before = str(tmp_path / "m"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        given = _references(spark, 300).orderBy(F.rand(3)).withColumn("ref", F.when(F.col("id") % 7 > 0, "a \"b\"\n"))
        job = multilingual_clips(given, _PROFILE, ["fr", "de"], open_code_per_sample, open_prompt_length, folder=folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    for kind, take in (("csv", lambda path: [int(r.pos) for r in read.csv(path).collect()]), ("json", lambda path: [json.loads(line)["pos"] for line in open(path)])):
        parts = sorted(name for name in os.listdir(f"{folder}/metadata_cloned.{kind}") if name.startswith("part-"))
        assert [pos for name in parts for pos in take(f"{folder}/metadata_cloned.{kind}/{name}")] == list(range(300))
    plain = spark.read.json(f"{folder}/metadata_cloned.json")
    columns = sorted(set(plain.columns))
    assert columns == sorted(c for c in job.metadata.columns if not c.endswith("_ok")) and rows(plain, *columns) == rows(job.metadata, *columns)


def test_pieces_ascend_and_take_odd_positions(spark, tmp_path):
    positions = [None, -3, 0, 1, 1, 49, 50, 51, 99, 10_000]
    df = spark.createDataFrame([(p, f"t{i}") for i, p in enumerate(positions)], "pos bigint, t string")
    pieces = pieces_for(spark, 100)
    stored = store_in_pieces(df, str(tmp_path / "p"), pieces)
    assert len(set(pieces.labels)) == len(pieces.labels) > 1
    values = spark.createDataFrame([(p, f"v{p}") for p in (-3, 0, 1, 50, 51, 10_000)], "pos bigint, v string")
    with in_place(spark):
        joined = pieces.join(stored, values, "left")
        assert plan(joined).split("== Physical Plan ==")[1].count("Exchange") == 1
        got = [(r.pos, r.v) for r in joined.collect()]
    assert got == [(p, f"v{p}" if p in (-3, 0, 1, 50, 51, 10_000) else None) for p in positions]
    assert rows(stored.drop(PIECE)) == rows(df) and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    none = store_in_pieces(df.limit(0), str(tmp_path / "none"), pieces_for(spark, 0))
    assert none.count() == 0 and none.columns == ["pos", "t", PIECE]


def test_rows_are_numbered_where_they_lie(spark):
    """Repeated keys, also over the edges of pieces, and rows without a key get one position each; the rows are shuffled once."""
    ids = [None] * 30 + [5] * 40 + list(range(-20, 30)) + [10**12]
    df = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(ids)], "k bigint, t string").orderBy(F.rand(1))
    keys = dense_positions(df.select("k"), "k")
    pieces, by_key = pieces_of_keys(keys, "k")
    with in_place(spark):
        numbered = place_numbered(df, keys, "k", by_key)
        assert plan(numbered).split("== Physical Plan ==")[1].count("REPARTITION_BY_NUM") == 2 and numbered.columns == ["k", "t", "pos", PIECE]
        got = numbered.withColumn("again", pieces.of(F.col("pos"))).collect()
    assert sorted(r.t for r in got) == sorted(f"t{i}" for i in range(len(ids))) and all(r.again == r[PIECE] for r in got)
    in_order = [r.k for r in sorted(got, key=lambda r: r.pos)]
    assert sorted(r.pos for r in got) == list(range(len(ids))) and in_order == sorted(ids, key=lambda k: (k is not None, k or 0))
    none = pieces_of_keys(keys.limit(0), "k")[1]
    assert place_numbered(df.limit(0), keys.limit(0), "k", none).count() == 0


@pytest.mark.parametrize("query", ["q_job_restart", "q_job_publish_built", "q_publish_versions"])
def test_the_joined_input_is_stored_before_it_is_read_again(spark, monkeypatch, query):
    class Stored(Exception):
        pass

    def stop(df, name="table"):
        if name == "utterances":
            raise Stored(sorted(df.columns))
        raise AssertionError(f"{name} is made before the input is stored")

    for module in (suite.jobs, suite.steps, speechset.plans.build_clips, speechset.plans.publish_versions):
        monkeypatch.setattr(module, "materialize", stop)
    with pytest.raises(Stored) as stored:
        suite.QUERIES[query](spark, DATA)
    assert "audio" in stored.value.args[0] and ("language" in stored.value.args[0] or query != "q_job_publish_built")
