"""Bucketed tables, committed steps and resume without moving audio."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechset.constants import ERROR_NO_TEXT
from speechset.functions.audio import AUDIO_TYPE
from speechset.operators.resume import pending_rows
from speechset.plans.build_steps import (
    build_in_steps, current_clips, last_attempts, pending_by_step, step_commits, step_work, store_utterances,
)
from speechset.sinks.bucketed import append_bucketed, create_bucketed, read_bucketed, read_layout, store_bucketed
from tests.conftest import plan, rows


class Stop(BaseException):
    pass


def _utterances(spark, n=60):
    return spark.range(n).select(
        F.format_string("dev:%d", "id").alias("_key"), F.col("id").alias("original_index"), F.lit("dev").alias("original_split"),
        F.lit("speaker_01").alias("speaker_id"), F.lit("E").alias("speaker_name"), F.lit("hello").alias("text_en"),
        F.when(F.col("id") % 10 == 3, "  ").when(F.col("id") % 10 == 4, "fail").otherwise("bonjour").alias("text_fr"),
        F.struct(F.array(F.lit(0.5)).alias("array"), F.lit(16000).alias("sampling_rate")).cast(AUDIO_TYPE).alias("audio"),
    )


def open_strict():
    def speak(text, *rest):
        if text == "fail":
            raise RuntimeError("busy")
        return np.zeros(len(text)), 24000

    return speak


def open_easy():
    return lambda text, *rest: (np.ones(3), 24000)


def test_bucketed_tables_come_back_in_a_new_catalogue(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), (None, 3, 1)], "k string, v int, `odd name` int")
    store_bucketed(df, folder, "k", 3, ["odd name"])
    assert read_layout(spark, folder).buckets == 3
    spark.sql(f"DROP TABLE {read_layout(spark, folder).name}")
    assert rows(read_bucketed(spark, folder), "k", "v", "odd name") == sorted([("a", 1, 0), ("b", 2, 1), (None, 3, 1)], key=repr)
    append_bucketed(df.where("v = 1").withColumn("odd name", F.lit(7)), folder)
    assert read_bucketed(spark, folder).count() == 4
    store_bucketed(df.limit(0), folder, "k", 2)
    assert read_bucketed(spark, folder).count() == 0 and read_layout(spark, folder).buckets == 2
    assert read_bucketed(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        append_bucketed(df, str(tmp_path / "none"))


def test_an_empty_table_can_be_created_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    schema = spark.createDataFrame([], "k string, run string").schema
    for buckets in (2, 5):
        create_bucketed(spark, folder, schema, "k", buckets, ["run"])
    assert read_layout(spark, folder).buckets == 2 and read_bucketed(spark, folder).count() == 0


def test_resume_moves_no_audio(spark, tmp_path):
    """Both key lists are long and nothing may be broadcast: the audio still goes through no exchange."""
    corpus, split = str(tmp_path / "corpus"), str(tmp_path / "split")
    store_utterances(_utterances(spark), corpus, step_rows=20, buckets=4)
    build_in_steps(spark, corpus, open_strict, split)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        utterances, clips = read_bucketed(spark, corpus), read_bucketed(spark, f"{split}/clips")
        work, now = step_work(utterances, clips, 1), current_clips(utterances, clips)
        both = pending_rows(utterances, clips.where("cloned_audio_fr <> ''").select("_key").hint("shuffle_hash"), "_key")
        for df in (work, both, now, last_attempts(utterances, clips)):
            shown = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in shown and "Bucketed: true" in shown, shown
        assert work.count() > 0 and both.count() == 12 and now.count() == 60
        assert "PartitionFilters: [isnotnull(_step" in plan(work)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_stop_costs_one_step(spark, tmp_path):
    corpus, split, calls = str(tmp_path / "corpus"), str(tmp_path / "split"), str(tmp_path / "calls")
    os.mkdir(calls)
    store_utterances(_utterances(spark), corpus, step_rows=12, buckets=2)
    steps = [r["_step"] for r in pending_by_step(read_bucketed(spark, corpus), None).orderBy("_step").collect()]
    assert len(steps) == 5

    def open_dying():
        import uuid

        def speak(text, *rest):
            if len(os.listdir(calls)) >= 30:
                os._exit(1)  # the worker dies, and so do its retries
            open(f"{calls}/{uuid.uuid4().hex}", "w").close()
            return np.zeros(len(text)), 24000

        return speak

    with pytest.raises(Exception):
        build_in_steps(spark, corpus, open_dying, split)
    kept = {(r.step, r.n_rows) for r in step_commits(spark, split).collect()}
    assert 0 < len(kept) < 5 and read_bucketed(spark, f"{split}/clips").count() == sum(n for _, n in kept)
    assert rows(build_in_steps(spark, corpus, open_easy, split)) == [(54, 6, 60)]
    report = step_commits(spark, split).groupBy("step").agg(F.sum("ok").alias("ok"), F.count("*").alias("times"))
    assert report.agg(F.sum("ok")).first()[0] == 54 and report.count() == 5
    built = read_bucketed(spark, f"{split}/clips")
    assert built.where("cloned_audio_fr <> ''").groupBy("_key").count().where("count > 1").count() == 0
    assert rows(build_in_steps(spark, corpus, open_easy, split)) == [(54, 6, 60)]
    assert spark.read.json(f"{split}/metadata.json").where(F.col("error") == ERROR_NO_TEXT).count() == 6


def test_newest_finished_attempt_of_present_keys(spark, tmp_path):
    corpus, split = str(tmp_path / "corpus"), str(tmp_path / "split")
    store_utterances(_utterances(spark), corpus, step_rows=100, buckets=2)
    assert rows(build_in_steps(spark, corpus, open_strict, split)) == [(48, 12, 60)]
    assert rows(build_in_steps(spark, corpus, open_easy, split)) == [(54, 6, 60)]
    store_utterances(_utterances(spark, 7), corpus, step_rows=100, buckets=2)  # fewer rows from now on
    assert rows(build_in_steps(spark, corpus, open_easy, split)) == [(6, 1, 7)]
    sizes = current_clips(read_bucketed(spark, corpus), read_bucketed(spark, f"{split}/clips")).select("_key", F.size("clip.array"))
    assert rows(sizes) == sorted([(f"dev:{i}", {3: None, 4: 3}.get(i, 7)) for i in range(7)], key=repr)


def test_failed_publishing_is_a_row(spark, tmp_path):
    corpus, split = str(tmp_path / "corpus"), str(tmp_path / "split")
    store_utterances(_utterances(spark, 20), corpus, step_rows=10, buckets=1)

    def publish(step):
        if step == 0:
            raise OSError("no route")

    assert rows(build_in_steps(spark, corpus, open_easy, split, publish)) == [(18, 2, 20)]
    log = spark.read.option("recursiveFileLookup", True).json(f"{split}/publish_log")
    assert rows(log, "step", "report") == [(0, "OSError: no route"), (1, "published")]


def test_keys_are_needed(spark, tmp_path):
    with pytest.raises(ValueError, match="no _key"):
        store_utterances(_utterances(spark, 3).withColumn("_key", F.lit(None).cast("string")), str(tmp_path / "a"))
    with pytest.raises(ValueError, match="more than once"):
        store_utterances(_utterances(spark, 3).withColumn("_key", F.lit("same")), str(tmp_path / "b"))
    store_utterances(_utterances(spark, 0), str(tmp_path / "c"))
    assert rows(build_in_steps(spark, str(tmp_path / "c"), open_easy, str(tmp_path / "d"))) == []
    with pytest.raises(FileNotFoundError):
        build_in_steps(spark, str(tmp_path / "none"), open_easy, str(tmp_path / "d"))
