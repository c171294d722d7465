"""Restartable batches: what is done, what is left, and merging the two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.functions.text import has_text


def completed_rows(
    prior: DataFrame, files: DataFrame | None, key: str = "_key", path: str = "cloned_audio_fr", order: str | None = None
) -> DataFrame:
    """Rows of an earlier run whose path is set and whose file exists; one per key, the last one.

    ``files`` lists existing relative paths in ``path``; None means the paths can be trusted.
    Rows are tested before they are reduced, so a later failed attempt never hides a finished one.
    """
    done = prior.where(has_text(F.col(path)))
    if files is not None:
        done = done.join(files.select(path), path, "left_semi")
    if order is None:
        # No order between attempts: the largest row, so that the choice does not depend on chance.
        one = done.groupBy(key).agg(F.max(F.struct(*prior.columns)).alias("_last"))
        return one.select("_last.*")
    last = done.groupBy(key).agg(F.max_by(F.struct(*prior.columns), order).alias("_last"))
    return last.select("_last.*")


def pending_rows(df: DataFrame, completed: DataFrame, key: str = "_key") -> DataFrame:
    return df.join(completed.select(key), key, "left_anti")


def merge_runs(completed: DataFrame, new: DataFrame, key: str = "_key") -> DataFrame:
    """Completed rows as they were, and the new rows of all other keys. The result follows its two
    sides: to leave out what is no longer wanted, ask ``wanted_rows`` for the completed side first."""
    fresh = new.join(completed.select(key), key, "left_anti")
    return completed.unionByName(fresh, allowMissingColumns=True)


def wanted_rows(completed: DataFrame, df: DataFrame, key: str = "_key") -> DataFrame:
    """The completed rows whose key the present input still has."""
    return completed.join(df.select(key), key, "left_semi")


def resume_progress(df: DataFrame, completed: DataFrame, key: str = "_key") -> DataFrame:
    """``completed, total, pending`` over the input rows."""
    flags = df.select(key).join(completed.select(F.col(key).alias("_done")), F.col(key) == F.col("_done"), "left")
    return flags.agg(
        F.count_if(F.col("_done").isNotNull()).alias("completed"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_done").isNull()).alias("pending"),
    )
