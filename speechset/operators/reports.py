"""Counts and checks over a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.functions.text import has_text
from speechset.session import small_table


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split, and the total as the row whose split is null."""
    return df.rollup(split).agg(F.count(F.lit(1)).alias("n"))


def run_summary(df: DataFrame, split: str = "split", path: str = "cloned_audio_fr", error: str = "error") -> DataFrame:
    """``ok, errors, total`` per split."""
    return df.groupBy(split).agg(
        F.count_if(has_text(F.col(path))).alias("ok"),
        F.count_if(has_text(F.col(error))).alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )


def distinct_values(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The distinct values, one per row: they stay distributed however many there are."""
    return df.select(*by, column).distinct()


def distinct_set(df: DataFrame, column: str, by: Sequence[str], out: str) -> DataFrame:
    """The distinct values of each group as one sorted array. For short vocabularies such as languages:
    duplicates are removed on the map side, so an array is as long as the vocabulary."""
    return df.groupBy(*by).agg(F.sort_array(F.collect_set(column)).alias(out))


def planned_work(df: DataFrame, n_languages: int) -> DataFrame:
    return df.agg((F.count(F.lit(1)) * F.lit(n_languages)).cast("bigint").alias("clips"))


def verify_split(
    df: DataFrame,
    expected_test: Sequence[str] | DataFrame,
    speaker: str = "speaker_id",
    split: str = "split",
) -> DataFrame:
    """One row: speakers found in more than one split, whether all expected speakers are in test and
    nowhere else, and row counts. Rows are first reduced to one per speaker, on the map side."""
    if isinstance(expected_test, DataFrame):
        expected = expected_test.select(F.col(speaker).alias("_expected"))
    else:
        expected = small_table(df.sparkSession, [(s,) for s in expected_test], "_expected string")
    per_speaker = df.groupBy(speaker).agg(
        F.count_if(F.col(split) == "test").alias("_test"),
        F.count_if(F.col(split) == "train").alias("_train"),
        F.count(F.lit(1)).alias("_all"),
    )
    checked = per_speaker.join(expected, per_speaker[speaker].eqNullSafe(expected["_expected"]), "full_outer")
    wanted = F.col("_expected").isNotNull()
    only_test = (F.coalesce("_test", F.lit(0)) > 0) & (F.coalesce("_train", F.lit(0)) == 0)
    return checked.agg(
        F.count_if((F.col("_test") > 0) & (F.col("_train") > 0)).alias("shared_speakers"),
        F.coalesce(F.bool_and(F.when(wanted, only_test)), F.lit(True)).alias("expected_only_in_test"),
        F.coalesce(F.sum("_test"), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum("_train"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("_all") == F.sum(F.col("_test") + F.col("_train")), F.lit(True)).alias("complete"),
    )
