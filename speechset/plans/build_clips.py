"""One cloned clip per utterance: resume, check, synthesise, record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.constants import CLIP_COLUMNS, ERROR_NO_AUDIO, ERROR_NO_TEXT
from speechset.functions.audio import AUDIO_TYPE, audio_value, has_samples
from speechset.functions.naming import cloned_clip_name, source_clip_name
from speechset.operators.jobs import spread, synthesize
from speechset.operators.reports import run_summary
from speechset.operators.resume import completed_rows, pending_rows, wanted_rows
from speechset.operators.shape import clip_record
from speechset.operators.validity import mark_errors
from speechset.plans.stored_job import keep_warnings
from speechset.session import materialize, new_folder, small_table
from speechset.sinks.audio_files import require_written, write_audio_files
from speechset.sinks.metadata import write_metadata
from speechset.sources.files import list_files, present_files
from speechset.sources.metadata import read_prior_metadata

SOURCE_FOLDER = "original_audio_en"
CLONED_FOLDER = "cloned_audio_fr"


@dataclass(frozen=True)
class BuiltClips:
    metadata: DataFrame
    clips: DataFrame


def synthesize_clips(utterances: DataFrame, open_model: Callable[[], Callable], text: str = "text_fr") -> DataFrame:
    """Check every utterance and run the model on the usable ones: the clip record plus ``clip``.

    The model function takes (text, samples, rate) and returns (samples, rate). Good and bad rows go
    through in one pass. A row whose model call fails keeps its source path.
    """
    checked = mark_errors(utterances, "audio", text).withColumns(
        {"_array": F.col("audio")["array"], "_rate": F.col("audio")["sampling_rate"]}
    )
    done = synthesize(checked.drop("audio"), open_model, [text, "_array", "_rate"], drop=["_array", "_rate"])
    clip = audio_value(F.col("out_array"), F.col("out_rate"))
    key = F.col("_key")
    usable = ~F.col("error").isin(ERROR_NO_AUDIO, ERROR_NO_TEXT)
    paths = done.withColumns(
        {
            "audio_en": F.when(usable, F.concat(F.lit(f"{SOURCE_FOLDER}/"), source_clip_name(key))).otherwise(""),
            "cloned_audio_fr": F.when(
                has_samples(clip), F.concat(F.lit(f"{CLONED_FOLDER}/"), cloned_clip_name(key))
            ).otherwise(""),
            "clip": clip,
        }
    )
    return clip_record(paths, extra=["clip"])


def build_clips(
    utterances: DataFrame,
    open_model: Callable[[], Callable],
    prior: DataFrame | None = None,
    files: DataFrame | None = None,
    folder: str | None = None,
    single_files: bool = False,
    prior_order: str | None = None,
    tasks: int | None = None,
) -> BuiltClips:
    """Build the clips that an earlier run has not finished, and the metadata of both runs. The result
    has the keys of ``utterances``: finished rows that the input no longer has stay out.

    ``utterances`` has ``_key``, the speaker columns, texts and ``audio``. Each clip is synthesised
    once: the result is written as a run of its own below ``folder``, where earlier runs stay, before
    anything else reads it. ``prior_order`` numbers the attempts in ``prior``. ``single_files``
    adds one WAV file per source and per cloned clip. ``tasks`` spreads the work list when the scan's
    partitions hold too many clips each.
    """
    spark = utterances.sparkSession
    folder = folder or new_folder(spark, "clips")
    todo = utterances
    done = None
    if prior is not None:
        done = wanted_rows(completed_rows(prior, files, order=prior_order), utterances)
        todo = _pending(utterances, done)
    # Run names ascend with time, so that the newest attempt can be told from older ones.
    run = f"{folder}/clips/run=r{time.time_ns():020d}-{uuid.uuid4().hex}"
    synthesize_clips(spread(todo, tasks, "_key"), open_model).write.option("compression", "zstd").parquet(run)
    clips = spark.read.parquet(run)
    if single_files:
        write_clip_files(todo, clips, folder)
    new = clips.select(*CLIP_COLUMNS)
    # ``new`` holds no finished key: a union is the merge.
    metadata = clip_record(done).unionByName(new) if done is not None else new
    return BuiltClips(metadata, clips)


def _pending(utterances: DataFrame, done: DataFrame) -> DataFrame:
    """The utterances left to do. Keys are resolved without the audio, and the rows then meet the shorter of
    the two key lists: Spark broadcasts it while it is small, so that audio stays where it is both after
    a run that did little and after one that did nearly all."""
    finished = materialize(done.select("_key"), "finished")
    left = materialize(pending_rows(utterances.select("_key"), finished), "pending")
    if left.count() < finished.count():
        return utterances.join(left, "_key", "left_semi")
    return pending_rows(utterances, finished)


def stored_clips(spark: SparkSession, folder: str) -> DataFrame | None:
    """The clips of all runs in ``folder``, or None before the first one."""
    try:
        return spark.read.parquet(f"{folder}/clips")
    except PySparkException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def finished_clips(spark: SparkSession, folder: str) -> DataFrame | None:
    """One row per finished key with its clip: of several runs the newest. Only keys that were built more
    than once are looked up; the clips themselves stay where they are while these are few."""
    stored = stored_clips(spark, folder)
    if stored is None:
        return None
    done = stored.where(F.col("cloned_audio_fr") != "")
    again = done.groupBy(F.col("_key").alias("_again")).agg(F.count(F.lit(1)).alias("_times"), F.max("run").alias("_newest"))
    kept = done.join(again.where("_times > 1").drop("_times"), F.col("_key") == F.col("_again"), "left")
    return kept.where("_newest IS NULL OR _newest = run").drop("_again", "_newest", "run")


def last_records(spark: SparkSession, folder: str) -> DataFrame | None:
    """The clip records of the last build of a split, one per key of its input, failed ones too; None before the first."""
    try:
        stored = spark.read.parquet(f"{folder}/records")
    except PySparkException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = stored.agg(F.max("build")).first()[0]
    return stored.where(F.col("build") == newest).drop("build")


def existing_clips(spark: SparkSession, folder: str, single_files: bool = False) -> DataFrame:
    """Paths of the cloned clips that exist in ``folder``: in the tables of its runs, and with ``single_files`` as files too. Each
    path is asked for; no folder is listed, unless there are files without any run."""
    clips = stored_clips(spark, folder)
    paths = clips.where("cloned_audio_fr <> ''").select("cloned_audio_fr") if clips is not None else None
    if single_files and paths is not None:
        found = present_files(paths.select(F.col("cloned_audio_fr").alias("path")).distinct(), folder)
        # Stored: what exists now is asked for once, before new files are written.
        paths = materialize(found.select(F.col("path").alias("cloned_audio_fr")), "present")
    elif single_files:
        try:
            found = list_files(spark, folder, "*.wav", [CLONED_FOLDER])
            paths = found.select(F.col("path").alias("cloned_audio_fr"))
        except PySparkException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
    return paths if paths is not None else small_table(spark, [], "cloned_audio_fr string")


def build_split(
    utterances: DataFrame,
    open_model: Callable[[], Callable],
    folder: str,
    single_files: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Build one split in ``folder``, going on where the last run stopped; may be called again any time.

    What is finished is read from the committed clips of all runs, the newest attempt of a key first;
    ``metadata.csv`` and ``metadata.json`` are exports in dataset order, and losing them costs nothing.
    (A folder without committed clips is resumed from its ``metadata.csv``.) With ``single_files`` a clip
    whose file is gone is built again. Returns ``ok, errors, total`` of the given utterances.
    """
    spark = utterances.sparkSession
    stored = stored_clips(spark, folder)
    files = existing_clips(spark, folder, single_files) if single_files or stored is None else None
    if stored is not None:
        prior, order = stored.drop("clip"), "run"
    else:
        messages: list[str] = []
        prior, order = read_prior_metadata(spark, f"{folder}/metadata.csv", CLIP_COLUMNS, messages.append), None
        if messages:
            keep_warnings(spark, folder, "resume", messages)
    built = build_clips(utterances, open_model, prior, files, folder, single_files, order, tasks)
    # Stored with the split, newest last: what the last build's input has, whatever older runs left.
    build = f"{folder}/records/build=r{time.time_ns():020d}-{uuid.uuid4().hex}"
    write_metadata(built.metadata, folder, "metadata", ["original_split", "original_index"], build)
    metadata = spark.read.parquet(build)
    return run_summary(metadata.withColumn("split", F.lit(""))).drop("split")


def write_clip_files(utterances: DataFrame, clips: DataFrame, folder: str) -> None:
    """Write source and cloned clips as files; source audio is taken from the utterances' own rows."""
    key = F.col("_key")
    sources = utterances.where(has_samples(F.col("audio"))).join(
        clips.where(F.col("audio_en") != "").select("_key"), "_key", "left_semi"
    )
    source_paths = F.concat(F.lit(f"{SOURCE_FOLDER}/"), source_clip_name(key))
    jobs = sources.select(source_paths.alias("path"), F.col("audio").cast(AUDIO_TYPE).alias("audio")).unionByName(
        clips.where(F.col("cloned_audio_fr") != "").select(F.col("cloned_audio_fr").alias("path"), F.col("clip").alias("audio"))
    )
    require_written(write_audio_files(jobs, folder))
