import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechset.constants import CORPUS_LANGUAGES, LANGUAGE_NAMES, SHARED_LANGUAGES, VOICE_IDS
from speechset.operators.languages import (
    collapse_languages,
    expand_languages,
    first_sentences,
    language_coverage,
    language_warnings,
    languages_without_text,
    require_known,
    voice_grid,
)
from speechset.operators.reports import run_summary, split_counts
from speechset.operators.resume import completed_rows, merge_runs, pending_rows, resume_progress
from speechset.plans.voice_grid import speaker_language_grid
from suite.models import open_text_model
from tests.conftest import plan, rows


def test_require_known():
    require_known(["fr", "de"], CORPUS_LANGUAGES)
    with pytest.raises(ValueError, match=r"languages \['xx'\] not available"):
        require_known(["fr", "xx"], CORPUS_LANGUAGES)
    with pytest.raises(ValueError, match="voices"):
        require_known(["Nobody"], list(VOICE_IDS), "voices")


def test_language_warnings():
    assert language_warnings(["de", "fr"], CORPUS_LANGUAGES, SHARED_LANGUAGES) == []
    messages = language_warnings(["es", "ar", "fr"], CORPUS_LANGUAGES, SHARED_LANGUAGES)
    assert messages[0] == "no text column for ['es']" and "['es', 'ar']" in messages[1]


def test_expand_and_collapse(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "", "b")], "k int, text_fr string, text_de string")
    long = expand_languages(df, {"fr": "text_fr", "de": "text_de"}, ["k"])
    assert rows(long) == [(1, "de", ""), (1, "fr", "a"), (2, "de", "b"), (2, "fr", "")]
    assert "Exchange" not in plan(long)
    wide = collapse_languages(long, ["k"], ["fr", "de"], "text", "text_")
    assert rows(wide, "k", "text_fr", "text_de") == [(1, "a", ""), (2, "", "b")]
    assert plan(wide).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert rows(language_coverage(df, {"fr": "text_fr", "de": "text_de"})) == [("de", 1, 2), ("fr", 1, 2)]


def test_grid(spark):
    catalogue = spark.createDataFrame([("fr", i, f"t{i}") for i in range(4)] + [("en", 0, "x")], "lang string, sample_index bigint, text string")
    assert rows(languages_without_text(catalogue, ["en", "zh"])) == [("zh",)]
    three = first_sentences(catalogue.withColumnRenamed("sample_index", "o"), ["fr", "en", "zh"], 3, "o")
    grid = voice_grid(three, ["Leo", "Aria"], LANGUAGE_NAMES)
    assert grid.count() == 8
    assert ("Aria", "French", "audio/fr/aria_fr_00002.wav") in rows(grid, "speaker", "language_name", "audio_path")
    made = speaker_language_grid(catalogue, ["fr", "en", "zh"], open_text_model, ["Leo"], n=2)
    assert rows(made, "language", "text", "audio_length_samples", "error") == [("en", "x", 1, ""), ("fr", "t0", 2, ""), ("fr", "t1", 2, "")]
    with pytest.raises(ValueError, match="voices"):
        speaker_language_grid(catalogue, ["fr"], open_text_model, ["Nobody"])


def _prior(spark, data):
    return spark.createDataFrame(data, "_key string, cloned_audio_fr string, run int")


def test_completed_needs_path_and_file(spark):
    prior = _prior(spark, [("a", "a.wav", 1), ("b", "b.wav", 1), ("c", "", 1), ("d", None, 1), ("a", "", 2), ("a", "a2.wav", 3), ("a", "lost.wav", 4)])
    files = spark.createDataFrame([("a.wav",), ("a2.wav",), ("other.wav",)], "cloned_audio_fr string")
    assert rows(completed_rows(prior, files, order="run")) == [("a", "a2.wav", 3)]
    assert rows(completed_rows(prior, None, order="run")) == [("a", "lost.wav", 4), ("b", "b.wav", 1)]
    assert rows(completed_rows(prior.where("run = 1"), files)) == [("a", "a.wav", 1)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.booleans()), max_size=12))
def test_completed_and_pending_make_up_the_input(spark, attempts):
    keys = spark.createDataFrame([(k,) for k in "abcdefgh"], "_key string")
    prior = _prior(spark, [(k, f"{k}{n}.wav" if ok else "", n) for n, (k, ok) in enumerate(attempts)])
    done = completed_rows(prior, None, order="run")
    finished = {k for k, ok in attempts if ok}
    assert {r._key for r in done.collect()} == finished
    assert {r._key for r in pending_rows(keys, done).collect()} == set("abcdefgh") - finished
    last = {k: f"{k}{n}.wav" for n, (k, ok) in enumerate(attempts) if ok}
    new = pending_rows(keys, done).withColumn("cloned_audio_fr", F.lit("new.wav"))
    merged = {r._key: r.cloned_audio_fr for r in merge_runs(done, new).collect()}
    assert merged == {k: last.get(k, "new.wav") for k in "abcdefgh"}
    again = merge_runs(completed_rows(merge_runs(done, new).withColumn("run", F.lit(99)), None, order="run"), new)
    assert {r._key: r.cloned_audio_fr for r in again.collect()} == merged
    assert rows(resume_progress(keys, done)) == [(len(finished), 8, 8 - len(finished))]


def test_run_summary_and_counts(spark):
    df = spark.createDataFrame([("t", "a", ""), ("t", "", "bad"), ("t", None, None), ("u", "b", "")], "split string, cloned_audio_fr string, error string")
    assert rows(run_summary(df)) == [("t", 1, 1, 3), ("u", 1, 0, 1)]
    assert set(rows(split_counts(df))) == {("t", 3), ("u", 1), (None, 4)}
