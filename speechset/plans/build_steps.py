"""Clips of a split in committed steps, over utterances and clips that are stored in buckets of the same key.

A stop costs at most the step it falls into. Steps, resume and the last attempt of each key are joins and groups of bucketed
tables, so neither audio nor key lists are shuffled, however many keys are done or left.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.constants import CLIP_COLUMNS
from speechset.functions.text import has_text
from speechset.operators.reports import run_summary
from speechset.operators.resume import pending_rows
from speechset.plans.build_clips import synthesize_clips
from speechset.session import materialize, small_table
from speechset.sinks.bucketed import append_bucketed, create_bucketed, read_bucketed, read_layout, store_bucketed
from speechset.sinks.metadata import write_metadata_csv, write_metadata_json

# Rows of a step; steps grow when there would be more than MAX_STEPS of them.
STEP_ROWS = 10_000
MAX_STEPS = 1_000

_COMMIT = "run string, step int, n_rows bigint, ok bigint, errors bigint"


def step_of(key: Column, steps: int) -> Column:
    """The step of a key: the same in every run, and in even shares."""
    return (F.conv(F.substr(F.md5(key), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % steps).cast("int")


def store_utterances(utterances: DataFrame, folder: str, step_rows: int = STEP_ROWS, buckets: int | None = None) -> DataFrame:
    """Store a split's utterances once, in steps and buckets of ``_key``, for ``build_in_steps``. Every row needs a key,
    and no key may stand twice: a key is what a run goes on by."""
    rows, filled = utterances.agg(F.count(F.lit(1)), F.count("_key")).first()
    if filled < rows:
        raise ValueError(f"{rows - filled} utterances have no _key")
    steps = min(MAX_STEPS, max(1, -(-rows // step_rows)))
    with_step = utterances.withColumn("_step", step_of(F.col("_key"), steps))
    stored = store_bucketed(with_step, folder, "_key", buckets, ["_step"])
    repeated = stored.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)), F.min("_key")).first()
    if repeated[0]:
        raise ValueError(f"{repeated[0]} keys stand more than once, such as {repeated[1]}")
    return stored


def _clips(spark: SparkSession, folder: str) -> DataFrame | None:
    return read_bucketed(spark, f"{folder}/clips")


def _finished(clips: DataFrame) -> DataFrame:
    return clips.where(has_text(F.col("cloned_audio_fr"))).select("_key", "_step").hint("shuffle_hash")


def pending_by_step(utterances: DataFrame, clips: DataFrame | None) -> DataFrame:
    """``_step, n``: utterances without a finished clip. Without a shuffle but that of the counts."""
    keys = utterances.select("_key", "_step")
    left = keys if clips is None else pending_rows(keys, _finished(clips).select("_key"))
    return left.groupBy("_step").agg(F.count(F.lit(1)).alias("n"))


def step_work(utterances: DataFrame, clips: DataFrame | None, step: int) -> DataFrame:
    """The utterances of a step that are left to do, read from the step's own files; audio stays where it is."""
    own = utterances.where(F.col("_step") == step)
    return own if clips is None else pending_rows(own, _finished(clips).where(F.col("_step") == step).select("_key"))


def last_attempts(utterances: DataFrame, clips: DataFrame) -> DataFrame:
    """The clip record of each utterance's key, without audio: a finished attempt before a failed one, then the newest."""
    records = clips.select(*CLIP_COLUMNS, "run").join(utterances.select("_key").hint("shuffle_hash"), "_key", "left_semi")
    order = F.struct(has_text(F.col("cloned_audio_fr")), "run")
    last = records.groupBy("_key").agg(F.max_by(F.struct(*CLIP_COLUMNS), order).alias("_last"))
    return last.select("_last.*")


def current_clips(utterances: DataFrame, clips: DataFrame) -> DataFrame:
    """The same attempts with their clips: the winning runs are found without audio and met by key where they lie."""
    order = F.struct(has_text(F.col("cloned_audio_fr")).alias("ok"), "run")
    best = clips.groupBy("_key").agg(F.max(order)["run"].alias("_run"))
    wanted = best.join(utterances.select("_key").hint("shuffle_hash"), "_key", "left_semi").hint("shuffle_hash")
    # Written so that it cannot become a second join key, which the buckets would not serve.
    return clips.join(wanted, "_key").where(F.greatest("run", "_run") == F.least("run", "_run")).drop("_run")


def build_in_steps(
    spark: SparkSession,
    corpus: str,
    open_model: Callable[[], Callable],
    folder: str,
    publish: Callable[[int], None] | None = None,
) -> DataFrame:
    """Build the clips of the utterances that ``store_utterances`` left in ``corpus``, a step at a time; may be called again
    any time, and builds only what is not finished. Returns ``ok, errors, total``.

    Each step is one write that Spark commits, with a row in ``folder/commits`` after it. What is finished is read from the
    clips themselves, so a stop between the two loses nothing. ``publish`` is called with the number of each committed step; if
    it fails, the failure is a row in ``folder/publish_log`` and the run goes on.
    """
    utterances = read_bucketed(spark, corpus)
    if utterances is None:
        raise FileNotFoundError(f"no stored utterances in {corpus}")
    run = f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    clips = _clips(spark, folder)
    left = [r["_step"] for r in pending_by_step(utterances, clips).orderBy("_step").collect()]  # at most MAX_STEPS
    for step in left:
        todo = step_work(utterances, clips, step)
        made = synthesize_clips(todo, open_model).withColumns({"run": F.lit(run), "_step": F.lit(step)})
        if clips is None:
            create_bucketed(spark, f"{folder}/clips", made.schema, "_key", read_layout(spark, corpus).buckets, ["run", "_step"])
        append_bucketed(made, f"{folder}/clips")
        clips = _clips(spark, folder)
        _commit(clips, folder, run, step)
        if publish is not None:
            _try_publish(spark, folder, run, step, publish)
    if clips is None:
        return run_summary(small_table(spark, [], "split string, cloned_audio_fr string, error string")).drop("split")
    metadata = materialize(last_attempts(utterances, clips), "metadata")
    order_by = ["original_split", "original_index"]
    write_metadata_csv(metadata, f"{folder}/metadata.csv", order_by)
    write_metadata_json(metadata, f"{folder}/metadata.json", order_by)
    return run_summary(metadata.withColumn("split", F.lit(""))).drop("split")


def _commit(clips: DataFrame, folder: str, run: str, step: int) -> None:
    own = run_summary(clips.where((F.col("run") == run) & (F.col("_step") == step)), "run")
    row = own.select("run", F.lit(step).alias("step"), F.col("total").alias("n_rows"), "ok", "errors")
    row.write.mode("overwrite").json(f"{folder}/commits/{run}/{step}")


def _try_publish(spark: SparkSession, folder: str, run: str, step: int, publish: Callable[[int], None]) -> None:
    report = "published"
    try:
        publish(step)
    except Exception as failure:
        report = f"{type(failure).__name__}: {failure}"
    row = small_table(spark, [(run, step, report)], "run string, step int, report string")
    row.write.mode("overwrite").json(f"{folder}/publish_log/{run}/{step}")


def step_commits(spark: SparkSession, folder: str) -> DataFrame:
    """``run, step, n_rows, ok, errors`` of every committed step."""
    return spark.read.schema(_COMMIT).option("recursiveFileLookup", True).json(f"{folder}/commits")
