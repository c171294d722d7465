"""Jobs whose results stay in a folder: a second action, or a run after a stop, makes only what is not there."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.session import small_table
from speechset.sinks.metadata import write_metadata


def stored_results(spark: SparkSession, folder: str) -> DataFrame | None:
    """The rows of all runs in ``folder``, each with its ``run``; None before the first one."""
    try:
        return spark.read.parquet(f"{folder}/results")
    except PySparkException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _finished(spark: SparkSession, folder: str) -> DataFrame | None:
    stored = stored_results(spark, folder)
    return None if stored is None else stored.where(F.col("error") == "")


def input_digest(*columns: Column) -> Column:
    """What a result was made from: with another input it is made anew."""
    return F.md5(F.to_json(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)])))


def left_to_do(work: DataFrame, key: Sequence[str], folder: str) -> DataFrame:
    """The rows of ``work`` (with ``key`` and ``input_id``) that no run in ``folder`` has finished from the same input."""
    done = _finished(work.sparkSession, folder)
    return work if done is None else work.join(done.select(*key, "input_id"), [*key, "input_id"], "left_anti")


def keep_results(made: DataFrame, folder: str) -> None:
    """Store results as a run of their own; ``made`` has ``input_id`` and ``error``."""
    # Run names ascend with time, so that the newest attempt can be told from older ones.
    made.write.option("compression", "zstd").parquet(f"{folder}/results/run=r{time.time_ns():020d}-{uuid.uuid4().hex}")


def results_of(work: DataFrame, key: Sequence[str], folder: str) -> DataFrame:
    """One stored row for each row of ``work``: a finished attempt from the same input before a failed one, then the newest. The attempt is
    chosen without the rows' other columns, such as clips."""
    stored = stored_results(work.sparkSession, folder)
    attempt = F.struct((F.col("error") == "").alias("ok"), "run")
    wanted = stored.select(*key, "input_id", "error", "run").join(work.select(*key, "input_id"), [*key, "input_id"], "left_semi")
    best = wanted.groupBy(*key, "input_id").agg(F.max(attempt)["run"].alias("run"))
    return stored.join(best, [*key, "input_id", "run"], "left_semi").drop("run", "input_id")


def run_stored(work: DataFrame, key: Sequence[str], make: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """Results of all rows of ``work``, made by ``make`` only where ``folder`` has none that is finished."""
    todo = left_to_do(work, key, folder)
    keep_results(make(todo), folder)
    return results_of(work, key, folder)


def export_metadata(rows: DataFrame, folder: str, name: str, order_by: Sequence[str]) -> None:
    """``<name>.csv`` and ``<name>.json`` of a job, without audio."""
    write_metadata(rows, folder, name, order_by)


def keep_warnings(spark: SparkSession, folder: str, job: str, messages: Sequence[str]) -> DataFrame:
    """``job, message`` rows of the last action's warnings in ``folder/warnings``."""
    rows = small_table(spark, [(job, m) for m in messages], "job string, message string")
    rows.coalesce(1).write.mode("overwrite").json(f"{folder}/warnings/{job}")
    return rows
